"""Quality gates, table profiles, heartbeats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zephyrine.functions import moments
from zephyrine.functions.moments import Moment
from zephyrine.functions.stats import null_rate, rounded


def count_new_records(
    measurements: DataFrame, last_run: Moment | None, minimum: int = 500
) -> DataFrame:
    """Rows ingested after the last run and whether they suffice; a first run always passes."""
    fresh = measurements
    if last_run is not None:
        fresh = measurements.filter(F.col("created_at") > moments.instant(last_run))
    enough = F.lit(True) if last_run is None else F.count("*") >= minimum
    return fresh.agg(F.count("*").alias("new_records"), enough.alias("passed"))


def count_for_day(measurements: DataFrame, day: Moment) -> DataFrame:
    return moments.within_day(measurements, "timestamp", day).agg(
        F.count("*").alias("record_count")
    )


def _gate_columns(limit: float) -> list:
    rate = null_rate("pm2_5")
    return [
        F.count("*").alias("total"),
        F.count_if(F.col("pm2_5").isNull()).alias("null_pm25"),
        F.count_if((F.col("pm2_5") < 0) | (F.col("pm10") < 0)).alias("negative_values"),
        rate.alias("null_rate"),
        (rate <= limit).alias("passed"),
    ]


def quality_gate(measurements: DataFrame, day: Moment, limit: float = 0.3) -> DataFrame:
    """One row for the day; an empty day has null rate 0 and passes."""
    return moments.within_day(measurements, "timestamp", day).agg(*_gate_columns(limit))


def quality_gate_by_day(measurements: DataFrame, limit: float = 0.3) -> DataFrame:
    return measurements.groupBy(F.to_date("timestamp").alias("pipeline_date")).agg(
        *_gate_columns(limit)
    )


def gate_metric_row(gate: DataFrame, day: Moment, table: str = "measurements") -> DataFrame:
    """The gate's result as a quality-metrics row."""
    return gate.select(
        F.lit(table).alias("table_name"),
        moments.day_of(day).alias("pipeline_date"),
        F.col("total").alias("row_count"),
        F.round("null_rate", 4).alias("null_rate"),
        F.lit(0).alias("freshness_minutes"),
        F.lit(False).alias("schema_drift"),
    )


def profile_table(
    df: DataFrame,
    name: str,
    as_of: Moment,
    freshness_column: str = "created_at",
    null_column: str | None = None,
    digits: int | None = 4,
) -> DataFrame:
    """Row count, null rate of one column, and minutes since the newest row.

    The age is null for an empty table and for one without the freshness column.
    """
    rate = rounded(null_rate(null_column), digits) if null_column else F.lit(0.0)
    age = F.lit(None).cast("int")
    if freshness_column in df.columns:
        age = moments.minutes_between(as_of, F.max(freshness_column)).cast("int")
    return df.agg(
        F.count("*").alias("row_count"),
        rate.alias("null_rate"),
        age.alias("freshness_minutes"),
    ).select(
        F.lit(name).alias("table_name"),
        moments.day_of(as_of).alias("pipeline_date"),
        "row_count",
        "null_rate",
        "freshness_minutes",
        F.lit(False).alias("schema_drift"),
    )


# Column that tells how fresh a table is, and the one whose nulls are counted.
FRESHNESS_COLUMNS = {"etl_heartbeat": "updated_at"}
NULL_COLUMNS = {"measurements": "pm2_5"}


def profile_tables(
    tables: dict[str, DataFrame], as_of: Moment, digits: int | None = 4
) -> DataFrame:
    result = None
    for name, df in tables.items():
        row = profile_table(
            df,
            name,
            as_of,
            FRESHNESS_COLUMNS.get(name, "created_at"),
            NULL_COLUMNS.get(name),
            digits,
        )
        result = row if result is None else result.unionByName(row)
    return result


def heartbeat(deltas: DataFrame) -> DataFrame:
    """Per-batch rows -> one row per day; a replayed batch overwrote its row, so sums hold."""
    return deltas.groupBy("pipeline_date").agg(
        F.max("last_batch_ts").alias("last_batch_ts"),
        F.sum("records_processed").alias("records_processed"),
        F.max_by("status", "last_batch_ts").alias("status"),
        F.max("last_batch_ts").alias("updated_at"),
    )


def heartbeat_delta(batch: DataFrame, time: str = "created_at") -> DataFrame:
    """What one batch of readings adds to the heartbeat of each ingest day."""
    return batch.groupBy(F.to_date(time).alias("pipeline_date")).agg(
        F.max(time).alias("last_batch_ts"),
        F.count("*").alias("records_processed"),
        F.lit("running").alias("status"),
    )


def freshness_gate(beats: DataFrame, as_of: Moment, max_age_minutes: float = 15) -> DataFrame:
    """One row: does the day of ``as_of`` have a running heartbeat that is young enough?"""
    age = moments.minutes_between(as_of, F.max("last_batch_ts"))
    state = F.max_by("status", "last_batch_ts")
    passed = (age <= max_age_minutes) & (state == "running")
    return beats.filter(F.col("pipeline_date") == moments.day_of(as_of)).agg(
        age.alias("age_minutes"), F.coalesce(passed, F.lit(False)).alias("passed")
    )


def etl_health(beats: DataFrame, as_of: Moment, newest: int = 30) -> DataFrame:
    """The newest heartbeats with their age."""
    return top_n_recent(
        beats.select(
            "pipeline_date",
            "last_batch_ts",
            "records_processed",
            "status",
            moments.minutes_between(as_of, "last_batch_ts").alias("minutes_since_last_batch"),
        ),
        "pipeline_date",
        newest,
    )


def top_n_recent(df: DataFrame, by: str, n: int) -> DataFrame:
    return df.orderBy(F.col(by).desc()).limit(n)


def recent_quality(
    metrics: DataFrame, as_of: Moment, days: int = 7, table_name: str | None = None
) -> DataFrame:
    recent = metrics.filter(F.col("pipeline_date") >= F.date_sub(moments.day_of(as_of), days))
    return optional_filter(recent, {"table_name": table_name})


def optional_filter(df: DataFrame, equals: dict[str, object]) -> DataFrame:
    """Equality filters for the arguments that were given."""
    for name, value in equals.items():
        if value is not None:
            df = df.filter(F.col(name) == F.lit(value))
    return df
