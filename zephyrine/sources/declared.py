"""The catalog: what the readers and writers declare, and its tables.

Tables and their edges come from the layouts of the stored tables, sources from the modules that
read and write them.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zephyrine import schemas
from zephyrine.sources import messages, model_store, pages, tables

STORE = ("store", "parquet", tables.__doc__.splitlines()[0])
MODULES = ((messages, "stream"), (pages, "files"), (model_store, "models"))


def declared_sources(spark: SparkSession) -> DataFrame:
    others = [(m.__name__.rsplit(".", 1)[-1], kind, m.__doc__.splitlines()[0]) for m, kind in MODULES]
    return spark.createDataFrame([STORE, *others], schemas.DATA_SOURCES)


def declared_tables(spark: SparkSession, layouts: dict[str, tables.Layout] = tables.LAYOUTS) -> DataFrame:
    rows = [(STORE[0], name, "default", layout.about) for name, layout in layouts.items()]
    return spark.createDataFrame(rows, schemas.CATALOG_TABLES)


def declared_lineage(spark: SparkSession, layouts: dict[str, tables.Layout] = tables.LAYOUTS) -> DataFrame:
    """An edge per feed of a table, and those of the models, in the order of declaration."""
    edges = [(origin, name, step) for name, layout in layouts.items() for origin, step in layout.fed_by]
    edges += [(origin, "model_store", step) for origin, step in model_store.FED_BY]
    return spark.createDataFrame([(n, *e) for n, e in enumerate(edges, 1)], schemas.LINEAGE_EDGES)


# Catalog tables and the columns that name a row of them.
CATALOG = {
    "data_sources": (schemas.DATA_SOURCES, ("name",)),
    "tables": (schemas.CATALOG_TABLES, ("source_name", "table_name")),
    "columns": (schemas.CATALOG_COLUMNS, ("table_name", "column_name")),
    "lineage_edges": (schemas.LINEAGE_EDGES, ("source_name", "target_name", "transformation")),
}


class CatalogStore:
    """Catalog tables as appended versions of rows; a read takes each key's newest version.

    Nothing is overwritten, so rows registered by others stay, and a failed write leaves the
    table as it was.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def read(self, name: str) -> DataFrame:
        schema, key = CATALOG[name]
        stored = T.StructType([*schema.fields, T.StructField("version", T.LongType())])
        try:
            rows = self.spark.read.schema(stored).parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], stored)
        newest = Window.partitionBy(*key).orderBy(F.desc("version"))
        return rows.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")

    def upsert(self, name: str, rows: DataFrame) -> None:
        """Add the rows that differ from what is there; an unchanged catalog writes nothing."""
        there = self.read(name)
        names = CATALOG[name][0].names
        same = [rows[c].eqNullSafe(there[c]) for c in names]
        changed = rows.select(*names).join(there.select(*names), same, "left_anti")
        if not changed.isEmpty():
            version = (there.agg(F.max("version")).first()[0] or 0) + 1
            changed.withColumn("version", F.lit(version).cast("long")).coalesce(1).write.mode("append").parquet(
                f"{self.root}/{name}"
            )
