"""Collects the queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _plain_dates(df: DataFrame) -> DataFrame:
    """Dates as text, which compares the same in every client."""
    dates = {f.name: F.col(f.name).cast("string") for f in df.schema if f.dataType == T.DateType()}
    return df.withColumns(dates) if dates else df


def query(sql: str | None = None, name: str | None = None):
    """Register ``fn(world) -> DataFrame`` under its own name (without a ``_query`` suffix)."""

    def register(fn):
        from workload.projection import World

        key = name or fn.__name__.removesuffix("_query")
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _plain_dates(fn(World(spark, sf_dir)))

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round columns whose last bits depend on the order of addition."""
    return df.withColumns({c: F.round(c, digits) for c in columns})
