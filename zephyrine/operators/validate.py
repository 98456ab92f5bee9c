"""From raw messages to clean flat readings; the same code serves batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zephyrine.schemas import BATTERY_RANGE, MEASURED, READING, VALUE_RANGES

CORRUPT = "_corrupt"


def parse_payload(messages: DataFrame, value: str = "value") -> DataFrame:
    """JSON text -> reading columns next to the raw text.

    A text that is no JSON, or one with a wrongly typed field, keeps its raw form in
    ``_corrupt`` and is rejected as a whole later on.  Messages without a value are skipped.
    """
    schema = T.StructType([*READING.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    text = messages.filter(F.col(value).isNotNull()).withColumn(
        value, F.col(value).cast("string")
    )
    # ``inline`` is evaluated once per row; a plain struct column would be inlined by the
    # optimizer, and the text parsed anew for every field and filter that uses it.
    return text.select("*", F.inline(F.array(F.from_json(value, schema, options))))


def missing_reason() -> Column:
    """Name of the first required part a reading lacks, else null."""
    place = [F.col(f"location.{f}").isNull() for f in ("lat", "lon", "city", "zone")]
    return (
        F.when(F.col("sensor_id").isNull(), "missing_sensor_id")
        .when(F.col("timestamp").isNull(), "missing_timestamp")
        .when(F.col("location").isNull() | place[0] | place[1] | place[2] | place[3],
              "missing_location")
        .when(F.col("measurements").isNull(), "missing_measurements")
    )


def battery_reason(column: str = "battery_level", bounds=BATTERY_RANGE) -> Column:
    """A null level is allowed; one outside the bounds rejects the whole reading."""
    return F.when(~F.col(column).between(*bounds), "battery_out_of_range")


def with_reject_reason(parsed: DataFrame) -> DataFrame:
    """Add ``reason``: null for a valid reading."""
    malformed = F.when(F.col(CORRUPT).isNotNull(), "malformed_json")
    reason = F.coalesce(malformed, missing_reason(), battery_reason())
    return parsed.withColumn("reason", reason)


def validate_required(readings: DataFrame) -> DataFrame:
    return readings.filter(missing_reason().isNull())


def validate_battery(readings: DataFrame, column: str = "battery_level") -> DataFrame:
    return readings.filter(battery_reason(column).isNull())


def split_judged(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid readings, rejected messages with their reason) of messages that have their ``reason``."""
    valid = judged.filter(F.col("reason").isNull()).drop("reason", CORRUPT)
    rejected = judged.filter(F.col("reason").isNotNull())
    return valid, rejected


def split_valid(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid readings, rejected messages with their reason)."""
    return split_judged(with_reject_reason(parsed))


def first_of_valid(judged: DataFrame, key: tuple[str, str], arrival: tuple[str, ...]) -> DataFrame:
    """All rejected messages, and of the valid readings the first of each ``key`` (sensor, time).

    Both come from one pass over the messages: a rejected one gets a key of its own, which no valid reading has, as
    its time is null.
    """
    sensor, time = key
    lost = F.col("reason").isNotNull()
    own = F.monotonically_increasing_id().cast("string")
    keyed = judged.withColumns(
        {sensor: F.when(lost, own).otherwise(F.col(sensor)), time: F.when(~lost, F.col(time))}
    )
    return first_writer_wins(keyed, key, arrival)


def sanitize_ranges(flat: DataFrame, ranges: dict = VALUE_RANGES) -> DataFrame:
    """Out-of-range or NaN values become null; the row stays."""
    cleaned = {}
    for name, (low, high) in ranges.items():
        if name not in flat.columns:
            continue
        value = F.col(name)
        keep = ~F.isnan(value)
        if low is not None:
            keep = keep & (value >= F.lit(low))
        if high is not None:
            keep = keep & (value <= F.lit(high))
        cleaned[name] = F.when(keep, value)
    return flat.withColumns(cleaned)


def default_fields(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Nulls (and columns that are missing altogether) take the given defaults."""
    filled = {}
    for name, default in defaults.items():
        value = default if isinstance(default, Column) else F.lit(default)
        filled[name] = F.coalesce(F.col(name), value) if name in df.columns else value
    return df.withColumns(filled)


def flatten_reading(readings: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Nested reading -> one flat row; ``keep`` names further columns to carry along."""
    return readings.select(
        "sensor_id",
        "timestamp",
        *(F.col(f"measurements.{c}").alias(c) for c in MEASURED),
        "battery_level",
        *keep,
    )


def quarantine(rejected: DataFrame, value: str = "value") -> DataFrame:
    """Rejected messages as they are kept: the reason and the raw text."""
    return rejected.select("reason", F.col(value).alias("raw_payload"))


def first_writer_wins(
    df: DataFrame, key: tuple[str, ...], arrival: tuple[str, ...] = ("created_at",)
) -> DataFrame:
    """One row per key, the earliest by arrival order.

    The rank filter runs on the map side first, so a key with countless copies sends one row
    per input partition over the network.
    """
    order = Window.partitionBy(*key).orderBy(*(F.col(c).asc() for c in arrival))
    return (
        df.withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def dedup_stream(stream: DataFrame, delay: str, time: str = "timestamp",
                 key: tuple[str, ...] = ("sensor_id", "timestamp")) -> DataFrame:
    """Repeated keys within the watermark are dropped; state is bounded by ``delay``."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(key))
