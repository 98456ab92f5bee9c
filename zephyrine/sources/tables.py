"""Parquet tables with date partitions, and idempotent writers on top of them.

Plain Parquet has no MERGE.  Writers therefore touch only the date partitions a batch falls
into: existing keys are read from those partitions alone, and replaced partitions are written
with dynamic overwrite, which stages its files and swaps them in on commit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zephyrine import schemas
from zephyrine.functions.moments import DAY_OF
from zephyrine.operators.upsert import new_rows, upsert_replace
from zephyrine.session import cut_lineage


@dataclass(frozen=True)
class Layout:
    """How a table is stored, and what the catalog tells about it."""

    schema: T.StructType
    key: tuple[str, ...]
    partition: str
    derive: str | None = None  # timestamp column the partition date comes from
    about: str = ""
    fed_by: tuple[tuple[str, str], ...] = ()  # (where rows come from, the step that writes them)

    @property
    def stored(self) -> T.StructType:
        """As Spark reads it: the partition column comes last."""
        fields = [f for f in self.schema.fields if f.name != self.partition]
        kind = T.LongType() if self.partition == BATCH_RANGE else T.DateType()
        return T.StructType([*fields, T.StructField(self.partition, kind)])


#: Partition of tables without a date: this many batches share a folder.
BATCH_RANGE, BATCHES_PER_RANGE = "batch_range", 1000

_ARCHIVE = T.StructType(
    [
        T.StructField("sensor_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("value", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
_QUARANTINE = T.StructType(
    [
        T.StructField("reason", T.StringType()),
        T.StructField("raw_payload", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

LAYOUTS = {
    "measurements": Layout(
        schemas.MEASUREMENTS, schemas.MEASUREMENT_KEY, "date", "timestamp",
        about="clean readings of registered sensors",
        fed_by=(("messages", "ingest_batch"), ("pages", "backfill_day")),
    ),
    "anomalies": Layout(
        schemas.ANOMALIES, schemas.ANOMALY_KEY, "date", "timestamp",
        about="limits that readings crossed",
        fed_by=(("messages", "detect_threshold_anomalies"),),
    ),
    "aggregates": Layout(
        schemas.AGGREGATES, schemas.AGGREGATE_KEY, "date", "window_start",
        about="statistics of closed windows",
        fed_by=(("measurements", "rolling_stats"),),
    ),
    "daily_summaries": Layout(
        schemas.DAILY_SUMMARIES, schemas.SUMMARY_KEY, "summary_date",
        about="a sensor's day",
        fed_by=(("measurements", "daily_summary"), ("anomalies", "daily_summary")),
    ),
    "quality_metrics": Layout(
        schemas.QUALITY_METRICS, ("table_name", "pipeline_date"), "pipeline_date",
        about="row counts, null rates and ages",
        fed_by=(("measurements", "quality_gate"),),
    ),
    "heartbeat_deltas": Layout(
        schemas.HEARTBEAT_DELTAS, ("pipeline_date", "batch_id"), "pipeline_date",
        about="what each batch added",
        fed_by=(("messages", "heartbeat_delta"),),
    ),
    "raw_archive": Layout(
        _ARCHIVE, schemas.MEASUREMENT_KEY, "date", "timestamp",
        about="accepted messages as they came",
        fed_by=(("messages", "ingest_batch"),),
    ),
    "quarantine": Layout(
        _QUARANTINE, (), BATCH_RANGE,
        about="messages that were turned away",
        fed_by=(("messages", "quarantine"),),
    ),
}


#: Length of the stretches of time in which a batch looks for keys it may repeat, and how many it names at most.
SLOT_SECONDS = 900
MOST_STRETCHES = 32


def stretches(slots: list[int], most: int = MOST_STRETCHES) -> list[tuple[int, int]]:
    """The slots as (first, last) stretches; the smallest gaps are closed until ``most`` are left."""
    found: list[list[int]] = []
    for slot in sorted(set(slots)):
        if found and slot == found[-1][1] + 1:
            found[-1][1] = slot
        else:
            found.append([slot, slot])
    gaps = sorted(b[0] - a[1] for a, b in zip(found, found[1:], strict=False))
    closed = gaps[len(found) - most - 1] if len(found) > most else 0
    kept = found[:1]
    for stretch in found[1:]:
        if stretch[0] - kept[-1][1] <= closed:
            kept[-1][1] = stretch[1]
        else:
            kept.append(stretch)
    return [(a, b) for a, b in kept]


@dataclass(frozen=True)
class Times:
    """Where a batch lies in time: partition dates, and (first, last) slots of ``SLOT_SECONDS``."""

    days: list
    stretches: list[tuple[int, int]]


class TableStore:
    def __init__(self, spark: SparkSession, root: str, layouts: dict[str, Layout] = LAYOUTS):
        self.spark, self.root, self.layouts = spark, root.rstrip("/"), layouts

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        """The table, empty when nothing was written yet."""
        layout = self.layouts[name]
        schema = schema or layout.stored
        try:
            found = self.spark.read.schema(schema).parquet(self.path(name))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            found = self.spark.createDataFrame([], schema).limit(0)  # known to be empty when a join with it is planned
        if layout.derive and layout.partition in schema.names:
            # Filters on the timestamp find the date partition by this mark.
            return found.withMetadata(layout.partition, {DAY_OF: layout.derive})
        return found

    def stored(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` with the columns of the stored table, the partition's included."""
        layout = self.layouts[name]
        if layout.derive:
            df = df.withColumn(layout.partition, F.to_date(layout.derive))
        if layout.partition == BATCH_RANGE:
            df = df.withColumn(BATCH_RANGE, F.floor(F.col("batch_id") / BATCHES_PER_RANGE))
        if "created_at" in layout.stored.names and "created_at" not in df.columns:
            df = df.withColumn("created_at", F.current_timestamp())
        for f in layout.stored.fields:
            if f.name not in df.columns:
                df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
        return df.select(*(F.col(f.name).cast(f.dataType) for f in layout.stored.fields))

    def _touched(self, name: str, df: DataFrame) -> list:
        """Partition values of a batch: as many as it has days."""
        column = self.layouts[name].partition
        return [r[0] for r in df.select(column).distinct().collect()]

    def _existing(self, name: str, values: list) -> DataFrame:
        return self.read(name).filter(F.col(self.layouts[name].partition).isin(values))

    def times_of(self, name: str, batch: DataFrame) -> Times:
        """The partition dates of a batch, and the stretches of time it touches."""
        layout = self.layouts[name]
        slot = F.floor(F.unix_seconds(layout.derive) / SLOT_SECONDS).cast("long")
        touched = batch.select(F.col(layout.partition).alias("day"), slot.alias("slot")).distinct().collect()
        days = list({r["day"] for r in touched})
        return Times(days, stretches([r["slot"] for r in touched if r["slot"] is not None]))

    def rows_at(self, name: str, times: Times) -> DataFrame:
        """Stored rows in the given stretches of time."""
        time = F.col(self.layouts[name].derive)
        here = F.lit(False)
        for first, last in times.stretches:
            begin, end = (F.timestamp_seconds(F.lit(k * SLOT_SECONDS)) for k in (first, last + 1))
            here |= (time >= begin) & (time < end)
        return self._existing(name, times.days).filter(here)

    def rows_beside(self, name: str, batch: DataFrame) -> DataFrame:
        """Stored rows that can share a key with ``batch``: those in the stretches of time it touches.

        Keys hold the time that partitions the table.  Stored files come from batches of neighbouring times, so
        their statistics let a reader skip all but the few around the batch's own times, however long the day is.
        A late row adds a stretch of its own.
        """
        layout = self.layouts[name]
        if not layout.derive or layout.derive not in layout.key:
            return self._existing(name, self._touched(name, batch))
        return self.rows_at(name, self.times_of(name, batch))

    def _write(self, name: str, df: DataFrame, mode: str) -> None:
        """Rebalanced by partition value: few files per day, and a day that holds most of the
        batch is split over several tasks."""
        column = self.layouts[name].partition
        (
            df.hint("rebalance", F.col(column))
            .write.mode(mode)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(column)
            .parquet(self.path(name))
        )

    def append(self, name: str, df: DataFrame) -> None:
        self._write(name, self.stored(name, df), "append")

    def insert_ignore(
        self, name: str, df: DataFrame, arrival: tuple[str, ...] | None = None, times: Times | None = None
    ) -> None:
        """Existing keys win; writing the same batch twice adds nothing.

        ``times`` hold all times of ``df`` and may hold more; with them the rows are read once and need not be stored
        in between.
        """
        key = self.layouts[name].key
        if times is not None:
            if times.days:
                rows = self.stored(name, df)
                self._write(name, new_rows(rows, self.rows_at(name, times), key, arrival), "append")
            return
        rows = cut_lineage(self.stored(name, df))  # computed once, read twice
        if not rows.isEmpty():
            existing = self.rows_beside(name, rows)
            self._write(name, new_rows(rows, existing, key, arrival), "append")

    def upsert_replace(self, name: str, df: DataFrame) -> None:
        """Incoming keys win; other rows of the touched partitions are kept."""
        rows = cut_lineage(self.stored(name, df))  # computed once, read twice
        values = self._touched(name, rows)
        if values:
            merged = upsert_replace(self._existing(name, values), rows, self.layouts[name].key)
            self._write(name, merged.select(*rows.columns), "overwrite")

    def replace_partitions(self, name: str, df: DataFrame) -> None:
        """The partitions present in ``df`` are replaced as a whole."""
        self._write(name, self.stored(name, df), "overwrite")

    def insert_batch(self, name: str, df: DataFrame, batch_id: int) -> None:
        """Rows of a batch, unless the table has rows of that batch already."""
        rows = self.stored(name, df.withColumn("batch_id", F.lit(batch_id).cast("long")))
        here = F.col("batch_id") == batch_id
        if self.layouts[name].partition == BATCH_RANGE:
            here &= F.col(BATCH_RANGE) == batch_id // BATCHES_PER_RANGE
        if self.read(name).filter(here).isEmpty():
            self._write(name, rows, "append")

    def compact(self, name: str, values: list) -> None:
        """Rewrite whole partitions, of closed days for instance, as few large files in the order of time."""
        column, time = self.layouts[name].partition, self.layouts[name].derive
        rows = self._existing(name, values)
        if time:
            rows = rows.repartitionByRange(column, time).sortWithinPartitions(column, time)
            writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(column).parquet(self.path(name))
        else:
            self._write(name, rows, "overwrite")
