"""Model runs: best run, newest version per stage, champion against challenger."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STAGES = ("Staging", "Production")


@dataclass(frozen=True)
class Contest:
    """How the models under one registry name are compared."""

    registry_name: str
    metric: str
    higher_is_better: bool = True


CONTESTS = (
    Contest("anomaly-classifier", "f1"),
    Contest("pollution-forecaster-pm2_5", "rmse", higher_is_better=False),
    Contest("pollution-forecaster-no2", "rmse", higher_is_better=False),
    Contest("sensor-clustering", "silhouette_sq"),
)


def metric_of(metric: str | Column) -> Column:
    name = F.lit(metric) if isinstance(metric, str) else metric
    return F.try_element_at(F.col("metrics"), name)


def best_run(
    runs: DataFrame,
    metric: str,
    higher_is_better: bool = True,
    group: tuple[str, ...] = ("registry_name",),
) -> DataFrame:
    """Best run per group; among equals the first one logged.  Runs without the metric lose."""
    score = metric_of(metric)
    order = score.desc_nulls_last() if higher_is_better else score.asc_nulls_last()
    ranked = Window.partitionBy(*group).orderBy(order, F.col("run_order").asc())
    return (
        runs.withColumn("_rank", F.row_number().over(ranked))
        .filter((F.col("_rank") == 1) & score.isNotNull())
        .drop("_rank")
    )


def model_registry(runs: DataFrame, stages: tuple[str, ...] = STAGES) -> DataFrame:
    """Newest version per registry name and stage."""
    newest = Window.partitionBy("registry_name", "stage").orderBy(F.col("version").desc())
    return (
        runs.filter(F.col("stage").isin(*stages))
        .withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def compare_stages(
    runs: DataFrame,
    metric: str | Column,
    higher_is_better: bool | Column = True,
) -> DataFrame:
    """Staging against Production per registry name.

    ``action`` is none / promoted_first / promoted_challenger / retained_champion;
    ``improvement`` is set for a winning challenger.  ``metric`` and ``higher_is_better`` may be
    columns over ``registry_name``.
    """
    newest = model_registry(runs).withColumn("_value", metric_of(metric))

    def side(stage: str) -> list[Column]:
        here = F.col("stage") == stage
        return [
            F.max(F.when(here, F.col("version"))).alias(f"{stage.lower()}_version"),
            F.max(F.when(here, F.col("_value"))).alias(f"{stage.lower()}_metric"),
        ]

    # One row per stage is left, so pivoting by aggregate replaces a full outer join.
    both = newest.groupBy("registry_name").agg(*side("Staging"), *side("Production"))
    names = runs.select("registry_name").distinct()
    up = F.lit(higher_is_better) if isinstance(higher_is_better, bool) else higher_is_better
    challenger, champion = F.col("staging_metric"), F.col("production_metric")
    gain = F.when(up, challenger - champion).otherwise(champion - challenger)
    action = (
        F.when(challenger.isNull(), "none")
        .when(champion.isNull(), "promoted_first")
        .when(gain > 0, "promoted_challenger")
        .otherwise("retained_champion")
    )
    return (
        names.join(both, "registry_name", "left")
        .withColumn("action", action)
        .withColumn("improvement", F.when(F.col("action") == "promoted_challenger", gain))
    )


def contest_columns(contests: tuple[Contest, ...] = CONTESTS) -> tuple[Column, Column]:
    """(metric name, higher is better) as columns over ``registry_name``."""
    metric, up = None, None
    for c in contests:
        here = F.col("registry_name") == c.registry_name
        metric = F.when(here, c.metric) if metric is None else metric.when(here, c.metric)
        up = F.when(here, c.higher_is_better) if up is None else up.when(here, c.higher_is_better)
    return metric, F.coalesce(up, F.lit(True))


def promote(runs: DataFrame, decisions: DataFrame) -> DataFrame:
    """Runs with their stage after the decisions: the winner moves up, the loser is archived."""
    verdict = decisions.select(
        "registry_name", "action", "staging_version", "production_version"
    )
    wins = F.col("action").isin("promoted_first", "promoted_challenger")
    is_challenger = (F.col("stage") == "Staging") & (F.col("version") == F.col("staging_version"))
    is_champion = (F.col("stage") == "Production") & (
        F.col("version") == F.col("production_version")
    )
    stage = (
        F.when(is_challenger & wins, "Production")
        .when(is_challenger & (F.col("action") == "retained_champion"), "Archived")
        .when(is_champion & (F.col("action") == "promoted_challenger"), "Archived")
        .otherwise(F.col("stage"))
    )
    return (
        runs.join(verdict, "registry_name", "left")
        .withColumn("stage", stage)
        .drop("action", "staging_version", "production_version")
    )
