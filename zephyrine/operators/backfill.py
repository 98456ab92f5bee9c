"""Backfill of historical pages: long form in, measurements out."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zephyrine.schemas import BACKFILL_PAGE, PARAMETER_COLUMNS


def explode_pages(pages: DataFrame) -> DataFrame:
    """Result pages (source, page, results[]) -> one row per value, numbered in page order."""
    return pages.select(
        "source", "page", F.posexplode("results").alias("position", "item")
    ).select(
        "source",
        (F.shiftleft(F.col("page").cast("bigint"), 32) + F.col("position")).alias("seq"),
        F.col("item.date.utc").alias("utc"),
        F.col("item.parameter").alias("parameter"),
        F.col("item.value").alias("value"),
    )


def parse_pages(pages: DataFrame, text: str = "value") -> DataFrame:
    """JSON page text -> the ``results`` array."""
    return pages.withColumn("results", F.from_json(text, BACKFILL_PAGE)["results"]).drop(text)


def rename_pollutant_codes(long: DataFrame, parameter: str = "parameter") -> DataFrame:
    """External code -> column name; unknown codes become null."""
    pairs = list(chain.from_iterable(PARAMETER_COLUMNS.items()))
    names = F.create_map(*(F.lit(x) for x in pairs))
    return long.withColumn(parameter, F.try_element_at(names, F.col(parameter)))


def pivot_readings(
    long: DataFrame,
    key: tuple[str, ...] = ("sensor_id", "timestamp"),
    parameter: str = "parameter",
    value: str = "value",
    seq: str = "seq",
) -> DataFrame:
    """Long -> wide; the last value by ``seq`` wins.

    Filtered aggregates instead of ``pivot``: one shuffle and no list of values to look up.  A
    key that only has unknown parameters still yields a row of nulls.
    """
    columns = sorted(set(PARAMETER_COLUMNS.values()), key=list(PARAMETER_COLUMNS.values()).index)
    last = [
        F.max_by(value, F.when(F.col(parameter) == c, F.col(seq))).alias(c) for c in columns
    ]
    return long.groupBy(*key).agg(*last)


def backfill_day(
    pages: DataFrame, prefix: str = "OAQ_", key: tuple[str, ...] = ("sensor_id", "timestamp")
) -> DataFrame:
    """All pages of all sources and days -> wide rows ready for an insert.

    Rows without a time are dropped; values are taken as they come.
    """
    long = rename_pollutant_codes(explode_pages(pages)).filter(
        F.coalesce(F.col("utc"), F.lit("")) != ""
    )
    keyed = long.select(
        F.concat(F.lit(prefix), F.col("source").cast("string")).alias("sensor_id"),
        F.to_timestamp("utc").alias("timestamp"),
        "parameter",
        "value",
        "seq",
    )
    return pivot_readings(keyed, key)
