"""Joins.  Facts are reduced before they meet the other side wherever the result allows it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zephyrine.functions import moments
from zephyrine.functions.moments import Moment


def enrich_with_sensor(
    facts: DataFrame, sensors: DataFrame, columns: tuple[str, ...] = ("city", "zone")
) -> DataFrame:
    """Inner join with the registry; facts of unknown sensors fall out."""
    return facts.join(sensors.select("sensor_id", *columns), "sensor_id")


def left_join_recent(
    sensors: DataFrame, measurements: DataFrame, as_of: Moment, lookback: str = "1 hour"
) -> DataFrame:
    """Every sensor with its readings of the last ``lookback``; silent sensors keep one row.

    Written as an inner join plus the silent sensors: in an outer join with the readings on the
    optional side, a hot sensor's readings could not be split over tasks.
    """
    recent = moments.recent(measurements, "timestamp", as_of, lookback)
    heard = recent.join(sensors, "sensor_id")
    silent = sensors.join(recent.select("sensor_id").distinct(), "sensor_id", "left_anti")
    return heard.unionByName(silent, allowMissingColumns=True)


def left_join_by_day(measurements: DataFrame, summaries: DataFrame) -> DataFrame:
    """Each reading with the summary of its sensor and day, if there is one."""
    daily = summaries.withColumnRenamed("summary_date", "day")
    return measurements.withColumn("day", F.to_date("timestamp")).join(
        daily, ["sensor_id", "day"], "left"
    )


def left_join_counts(
    base: DataFrame, counted: DataFrame, key: tuple[str, ...], count: str
) -> DataFrame:
    """Join two aggregates; a key without a partner counts 0."""
    return base.join(counted, list(key), "left").withColumn(
        count, F.coalesce(F.col(count), F.lit(0).cast("bigint"))
    )


def count_per_key(
    base: DataFrame, events: DataFrame, key: tuple[str, ...], count: str
) -> DataFrame:
    """Number of events for each row of ``base``: counted per key first, then joined."""
    counted = events.groupBy(*key).agg(F.count("*").alias(count))
    return left_join_counts(base, counted, key, count)


def full_outer_histograms(left: DataFrame, right: DataFrame, bucket: str = "bucket") -> DataFrame:
    """Align two histograms on their bucket; absent counts become 0."""
    joined = left.join(right, bucket, "full")
    counts = [c for c in joined.columns if c != bucket]
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast("bigint")) for c in counts})


def split_known_sensors(
    readings: DataFrame, sensors: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(readings of registered sensors, readings of unknown ones)."""
    ids = sensors.select("sensor_id").distinct()
    return (
        readings.join(ids, "sensor_id", "left_semi"),
        readings.join(ids, "sensor_id", "left_anti"),
    )


# fixed values: city and zone of sensors known from backfilled readings only
BACKFILL_PLACE = ("OpenAQ", "unknown")


def insert_missing_sensors(
    readings: DataFrame,
    sensors: DataFrame,
    city: str = BACKFILL_PLACE[0],
    zone: str = BACKFILL_PLACE[1],
) -> DataFrame:
    """Registry rows for sensor ids that occur in ``readings`` but not in ``sensors``."""
    unseen = (
        readings.select("sensor_id").distinct().join(sensors, "sensor_id", "left_anti")
    )
    return unseen.select(
        "sensor_id",
        F.lit(0.0).alias("lat"),
        F.lit(0.0).alias("lon"),
        F.lit(city).alias("city"),
        F.lit(zone).alias("zone"),
    )
