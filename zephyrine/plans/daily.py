"""The daily job: gates, summaries, training, promotion, catalog."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from zephyrine.functions.moments import Moment
from zephyrine.operators import catalog, features, quality, summaries
from zephyrine.plans import training
from zephyrine.session import cut_lineage
from zephyrine.sources import declared
from zephyrine.sources.model_store import ModelStore
from zephyrine.sources.tables import TableStore


class QualityGateFailed(ValueError):
    pass


@dataclass
class DailyResult:
    record_count: int = 0
    null_rate: float = 0.0
    waiting_for: list[str] = field(default_factory=list)
    training: dict[str, object] = field(default_factory=dict)
    deployed: bool = False


def run_gates(
    store: TableStore,
    as_of: Moment,
    last_run: Moment | None,
    minimum: int = 500,
    max_age_minutes: float = 15,
) -> list[str]:
    """Names of the conditions that are not met yet."""
    fresh = quality.count_new_records(store.read("measurements"), last_run, minimum).first()
    beats = quality.heartbeat(store.read("heartbeat_deltas"))
    alive = quality.freshness_gate(beats, as_of, max_age_minutes).first()
    return [
        name for name, row in (("new_data", fresh), ("streaming", alive)) if not row["passed"]
    ]


def validate_day(store: TableStore, day: Moment, limit: float = 0.3) -> dict:
    """Write the day's metric row, then fail when too many values are missing."""
    gate = cut_lineage(quality.quality_gate(store.read("measurements"), day, limit))
    store.insert_ignore("quality_metrics", quality.gate_metric_row(gate, day))
    row = gate.first().asDict()
    if not row["passed"]:
        raise QualityGateFailed(f"null rate {row['null_rate']:.2%} above {limit:.0%}")
    return row


def summarise_day(store: TableStore, day: Moment) -> None:
    rows = summaries.daily_summary_of(store.read("measurements"), store.read("anomalies"), day)
    store.upsert_replace("daily_summaries", rows)


def run_catalog(
    spark: SparkSession, store: TableStore, as_of: Moment, root: str, sensors: DataFrame
) -> None:
    """Sources, tables, lineage, columns and quality metrics in one go."""
    tables = {name: store.read(name) for name in ("measurements", "aggregates", "anomalies", "daily_summaries")}
    tables["sensors"] = sensors
    tables["etl_heartbeat"] = quality.heartbeat(store.read("heartbeat_deltas"))
    kept = declared.CatalogStore(spark, f"{root}/catalog")
    kept.upsert("data_sources", declared.declared_sources(spark))
    kept.upsert("tables", declared.declared_tables(spark))
    kept.upsert("lineage_edges", declared.declared_lineage(spark))
    kept.upsert("columns", catalog.describe_columns(tables))
    store.insert_ignore("quality_metrics", quality.profile_tables(tables, as_of))


def run_daily(
    spark: SparkSession,
    store: TableStore,
    models: ModelStore,
    sensors: DataFrame,
    day: Moment,
    as_of: Moment,
    last_run: Moment | None = None,
    days: int = 30,
    rounds: int = 200,
    check_gates: bool = True,
) -> DailyResult:
    """Everything one day needs; ``day`` is the only notion of "today"."""
    result = DailyResult()
    if check_gates:
        result.waiting_for = run_gates(store, as_of, last_run)
        if result.waiting_for:
            return result
    result.record_count = quality.count_for_day(store.read("measurements"), day).first()[0]
    result.null_rate = validate_day(store, day)["null_rate"]
    summarise_day(store, day)

    # Both supervised trainings use the matrix; it is computed and stored once.
    measurements = store.read("measurements")
    matrix = cut_lineage(features.build_feature_matrix(measurements, sensors, as_of, days))
    result.training = {
        "classification": training.train_best_classifier(matrix, models),
        "forecasting": training.train_best_forecasters(matrix, models, rounds),
        "clustering": training.train_best_clustering(measurements, as_of, models),
    }
    actions = [r["action"] for r in models.promote().select("action").collect()]
    result.deployed = any(a in ("promoted_first", "promoted_challenger") for a in actions)
    run_catalog(spark, store, as_of, store.root, sensors)
    return result
