"""Landed result pages of an external measurement service."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from zephyrine.schemas import BACKFILL_PAGE

PAGE_FILE = T.StructType(
    [
        T.StructField("source", T.LongType()),
        T.StructField("page", T.LongType()),
        *BACKFILL_PAGE.fields,
    ]
)


def scan_backfill_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per page: source, page number, results."""
    return spark.read.schema(PAGE_FILE).json(path)
