"""Operators on catalog tables: sources, tables, columns, lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zephyrine.operators.quality import optional_filter
from zephyrine.schemas import CATALOG_COLUMNS

def describe_columns(tables: dict[str, DataFrame]) -> DataFrame:
    """Column snapshot of live tables, from their schemas alone."""
    spark = next(iter(tables.values())).sparkSession
    rows = [
        (name, f.name, f.dataType.simpleString(), f.nullable)
        for name, df in tables.items()
        for f in df.schema.fields
    ]
    return spark.createDataFrame(rows, CATALOG_COLUMNS)


def schema_drift(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Columns added, removed or retyped between two snapshots, and a flag per table row."""
    before = previous.select("table_name", "column_name", F.col("data_type").alias("previous_type"))
    now = current.select("table_name", "column_name", F.col("data_type").alias("current_type"))
    change = (
        F.when(F.col("previous_type").isNull(), "added")
        .when(F.col("current_type").isNull(), "removed")
        .when(F.col("previous_type") != F.col("current_type"), "retyped")
        .otherwise("same")
    )
    return before.join(now, ["table_name", "column_name"], "full").withColumn("change", change)


def drifted_tables(drift: DataFrame) -> DataFrame:
    return drift.groupBy("table_name").agg(
        F.bool_or(F.col("change") != "same").alias("schema_drift")
    )


def list_sources(sources: DataFrame) -> DataFrame:
    return sources.select("name", "source_type", "description").orderBy("name")


def list_tables(tables: DataFrame, source_name: str | None = None) -> DataFrame:
    return (
        optional_filter(tables, {"source_name": source_name})
        .select("source_name", "table_name", "schema_name", "description")
        .orderBy("table_name")
    )


def list_lineage(edges: DataFrame) -> DataFrame:
    return edges.orderBy("edge_order").select("source_name", "target_name", "transformation")
