"""Feature matrix, labels, split and scaling."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zephyrine.functions import moments
from zephyrine.functions.moments import Moment
from zephyrine.functions.rules import critical_label
from zephyrine.operators.joins import enrich_with_sensor
from zephyrine.operators.rolling import (
    delta_columns,
    forecast_target,
    over_slices,
    rolling_columns,
)
from zephyrine.operators.summaries import with_zone_code
from zephyrine.schemas import MEASURED, POLLUTANTS, ROLLING_WIDTHS
from zephyrine.session import cut_lineage

# fixed values: the inputs of the two models, in the order of their contract
CLASSIFIER_FEATURES = (
    *POLLUTANTS,
    "pm2_5_mean_5",
    "pm2_5_std_5",
    "pm2_5_delta",
    "pm10_mean_5",
    "no2_mean_5",
    "hour",
    "day_of_week",
    "is_weekend",
    "zone_enc",
)
FORECAST_FEATURES = (
    *POLLUTANTS,
    "pm2_5_mean_5",
    "pm2_5_std_5",
    "pm2_5_delta",
    "pm2_5_mean_15",
    "pm2_5_std_15",
    "hour",
    "day_of_week",
    "is_weekend",
    "zone_enc",
    "temperature",
    "humidity",
)


def scan_measurements_window(
    measurements: DataFrame, sensors: DataFrame, as_of: Moment, days: int = 30
) -> DataFrame:
    """Readings of the last days with city and zone; unordered, the windows sort for themselves."""
    recent = moments.recent(measurements, "timestamp", as_of, f"{days} days")
    return enrich_with_sensor(recent.select("sensor_id", "timestamp", *MEASURED), sensors)


def calendar_features(df: DataFrame, time: str = "timestamp") -> DataFrame:
    """Hour, weekday (Monday = 0), weekend flag, month; all in UTC."""
    weekday = F.weekday(time)
    return df.withColumns(
        {
            "hour": F.hour(time),
            "day_of_week": weekday,
            "is_weekend": (weekday >= 5).cast("int"),
            "month": F.month(time),
        }
    )


def build_feature_matrix(
    measurements: DataFrame,
    sensors: DataFrame,
    as_of: Moment,
    days: int = 30,
    widths=ROLLING_WIDTHS,
    slice_width: str = "1 hour",
) -> DataFrame:
    """Rolling, delta, calendar and zone features; rows with a missing pollutant are dropped last.

    All window columns share one layout, so the readings are shuffled once however many
    features there are.
    """
    rows = scan_measurements_window(measurements, sensors, as_of, days)
    windowed = over_slices(
        rows,
        [delta_columns(POLLUTANTS), *rolling_columns(POLLUTANTS, widths)],
        before=max(widths) - 1,
        slice_width=slice_width,
    )
    return with_zone_code(calendar_features(windowed)).na.drop(subset=list(POLLUTANTS))


def generate_labels(df: DataFrame, label: str = "label") -> DataFrame:
    return df.withColumn(label, critical_label(df.columns))


def select_available(df: DataFrame, wanted: tuple[str, ...], keep: tuple[str, ...] = ()) -> DataFrame:
    """The wanted columns that exist, plus ``keep``."""
    present = [c for c in wanted if c in df.columns]
    return df.select(*keep, *(c for c in present if c not in keep))


def drop_label_columns(
    df: DataFrame, labels: tuple[str, ...] = ("sensor_id", "timestamp", "city", "zone", "target")
) -> DataFrame:
    return df.drop(*labels)


def fill_null_zero(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return df.na.fill(0, subset=[c for c in columns if c in df.columns])


def drop_null_rows(df: DataFrame, columns: tuple[str, ...] = POLLUTANTS) -> DataFrame:
    return df.na.drop(subset=list(columns))


def build_forecast_dataset(
    matrix: DataFrame, target: str = "pm2_5", horizon: int = 1, **layout
) -> DataFrame:
    """Feature rows with the value ``horizon`` kept rows later as ``target``."""
    return forecast_target(matrix, target, horizon, **layout)


# --- split -----------------------------------------------------------------------------

_RANKED_ROWS = 1 << 14
_DIGITS = 3  # hash digits by which a cell is split into smaller ones
_HASH_DIGITS = 32


def key_hash(key: tuple[str | Column, ...]) -> Column:
    parts = [F.col(c) if isinstance(c, str) else c for c in key]
    return F.md5(F.concat_ws("|", *(p.cast("string") for p in parts)))


def _small(table: DataFrame, rows: int = 1 << 20) -> DataFrame:
    """A table of one row per class, broadcast if it is counted small."""
    return F.broadcast(table) if table.count() <= rows else table


def _narrowed(hashed: DataFrame, cells: DataFrame, digits: int) -> DataFrame:
    """Each class's cell split by more hash digits: the part that its cut falls in."""
    within = hashed.join(_small(cells), F.col("class").eqNullSafe(F.col("of")))
    within = within.filter(F.col("hash").startswith(F.col("prefix")))
    counted = within.groupBy("of", "place", F.substring("hash", 1, digits).alias("prefix")).agg(
        F.count("*").alias("n")
    )
    upto = F.sum("n").over(Window.partitionBy("of").orderBy("prefix"))
    return (
        counted.withColumn("before", upto - F.col("n"))
        .filter((F.col("before") < F.col("place")) & (F.col("before") + F.col("n") >= F.col("place")))
        .select("of", "prefix", (F.col("place") - F.col("before")).alias("place"), "n")
    )


def split_train_test(
    df: DataFrame,
    key: tuple[str | Column, ...],
    fraction: float = 0.2,
    stratify: str | None = None,
) -> DataFrame:
    """Add ``is_test``: exactly ``ceil(fraction * n)`` rows of each class.

    The test rows of a class are those with the smallest key hashes, so the split does not
    depend on partitioning.  Ranking a whole class would sort it in one task; instead the cell
    of hashes that the cut falls in is narrowed by counts, a few digits at a time, until it is
    small enough to rank.  The split itself compares each row with its class's cut, a table of
    one row per class.
    """
    label = F.col(stratify) if stratify else F.lit(0)
    hashed = cut_lineage(df.select(label.alias("class"), key_hash(key).alias("hash")))
    cells = hashed.groupBy(F.col("class").alias("of")).agg(
        F.lit("").alias("prefix"), F.ceil(F.count("*") * F.lit(fraction)).alias("place"), F.count("*").alias("n")
    )
    cells, digits = cut_lineage(cells.filter("place > 0")), 0
    while digits < _HASH_DIGITS and (cells.agg(F.max("n")).first()[0] or 0) > _RANKED_ROWS:
        digits += _DIGITS
        cells = cut_lineage(_narrowed(hashed, cells, digits))
    within = hashed.join(_small(cells), F.col("class").eqNullSafe(F.col("of")))
    limits = cut_lineage(
        within.filter(F.col("hash").startswith(F.col("prefix")))
        .withColumn("rank", F.row_number().over(Window.partitionBy("of").orderBy("hash")))
        .filter(F.col("rank") == F.col("place"))
        .select(F.col("of").alias("_class"), F.col("hash").alias("_limit"))
    )
    is_test = F.coalesce(key_hash(key) <= F.col("_limit"), F.lit(False))
    return (
        df.join(_small(limits), label.eqNullSafe(F.col("_class")), "left")
        .withColumn("is_test", is_test)
        .drop("_class", "_limit")
    )


# --- scaling ---------------------------------------------------------------------------


def fit_scaler(df: DataFrame, columns: tuple[str, ...]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column, from one aggregate; a constant scales by 1."""
    wanted = []
    for c in columns:
        value = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        wanted += [F.avg(value).alias(f"{c}_m"), F.stddev_pop(value).alias(f"{c}_s")]
    row = df.agg(*wanted).first()
    fitted = {}
    for c in columns:
        mean, deviation = row[f"{c}_m"], row[f"{c}_s"]
        usable = deviation is not None and deviation > 0 and math.isfinite(deviation)
        fitted[c] = (mean or 0.0, deviation if usable else 1.0)
    return fitted


def scaled(column: str, fit: tuple[float, float]) -> Column:
    value = F.coalesce(F.col(column).cast("double"), F.lit(0.0))
    return (value - F.lit(fit[0])) / F.lit(fit[1])


def scale_features(
    df: DataFrame, columns: tuple[str, ...], fitted: dict[str, tuple[float, float]] | None = None
) -> DataFrame:
    """Columns replaced by their z-score."""
    fitted = fitted or fit_scaler(df, columns)
    return df.withColumns({c: scaled(c, fitted[c]) for c in columns})
