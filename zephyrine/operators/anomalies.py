"""Rule-based anomaly events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zephyrine.functions.rules import event_severity
from zephyrine.schemas import THRESHOLDS


def detect_threshold_anomalies(
    flat: DataFrame,
    thresholds: dict = THRESHOLDS,
    keep: tuple[str, ...] = ("sensor_id", "timestamp"),
) -> DataFrame:
    """One row per pollutant at or above its warning limit; narrow, no shuffle.

    Runs the same on a stream.  ``keep`` names the input columns carried into each event.
    """
    used = {p: t for p, t in thresholds.items() if p in flat.columns}
    cells = ", ".join(
        f"'{p}', `{p}`, {float(warn)}D, {float(crit)}D" for p, (warn, crit) in used.items()
    )
    # `value` may also be the name of a kept column, hence the private names.
    long = flat.select(
        *keep,
        F.expr(f"stack({len(used)}, {cells}) as (pollutant, _value, _warning, _critical)"),
    )
    severity = event_severity(F.col("_value"), F.col("_warning"), F.col("_critical"))
    return (
        long.withColumn("severity", severity)
        .filter(F.col("severity").isNotNull())
        .select(
            *keep,
            F.lit("rule_based").alias("anomaly_type"),
            "severity",
            "pollutant",
            F.col("_value").alias("value"),
            F.when(F.col("severity") == "critical", F.col("_critical"))
            .otherwise(F.col("_warning"))
            .alias("threshold"),
        )
    )


def threshold_table(spark: SparkSession, thresholds: dict = THRESHOLDS) -> DataFrame:
    """The limits as a relation (pollutant, warning, critical)."""
    rows = [(p, float(w), float(c)) for p, (w, c) in thresholds.items()]
    return spark.createDataFrame(rows, "pollutant string, warning double, critical double")


def anomaly_messages(anomalies: DataFrame, key: str = "sensor_id") -> DataFrame:
    """Key/value form for a message sink: the sensor as key, the event as JSON."""
    return anomalies.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*anomalies.columns)).alias("value"),
    )
