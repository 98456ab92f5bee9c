"""Window statistics and anomaly events as streaming queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from zephyrine.operators.rolling import MOMENTS, merge_moments, micros, partial_moments, rolling_stats
from zephyrine.schemas import WINDOW_TYPES
from zephyrine.session import cut_lineage
from zephyrine.sources.tables import BATCH_RANGE, BATCHES_PER_RANGE, Layout, TableStore


def start_rolling_stats(
    readings: DataFrame,
    store: TableStore,
    window_type: str,
    checkpoint: str,
    watermark: str = "10 minutes",
    duration: str | None = None,
    slide: str | None = None,
    digits: int | None = 4,
    once: bool = False,
) -> StreamingQuery:
    """Closed windows into ``aggregates``.

    A window is written once, when the watermark passes its end.  Readings later than that are
    missing here but present in ``measurements``; the progress metric
    ``numRowsDroppedByWatermark`` tells that some were dropped.  ``start_lasting_stats`` keeps them.
    """
    stats = rolling_stats(readings, window_type, duration, slide, digits, watermark)

    def process(batch: DataFrame, batch_id: int) -> None:
        store.insert_ignore("aggregates", batch)

    writer = (
        stats.writeStream.outputMode("append")
        .foreachBatch(process)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def _column(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind)


_KEY = ("sensor_id", "window_start", "window_type", "batch_id")
_TABLES = {
    "window_moments": Layout(
        T.StructType(
            [
                _column("sensor_id", T.StringType()),
                _column("window_start", T.TimestampType()),
                _column("window_end", T.TimestampType()),
                _column("window_type", T.StringType()),
                _column("record_count", T.LongType()),
                *(_column(c, T.DoubleType()) for c in MOMENTS),
                _column("batch_id", T.LongType()),
            ]
        ),
        _KEY, "date", "window_start",
    ),
    "window_progress": Layout(
        T.StructType(
            [
                _column("window_type", T.StringType()),
                _column("batch_id", T.LongType()),
                _column("newest", T.TimestampType()),
            ]
        ),
        ("window_type", "batch_id"), BATCH_RANGE,
    ),
}


def start_lasting_stats(
    readings: DataFrame,
    store: TableStore,
    window_type: str,
    checkpoint: str,
    wait: str = "10 minutes",
    duration: str | None = None,
    digits: int | None = 4,
    once: bool = False,
) -> StreamingQuery:
    """Closed windows into ``aggregates``, with all rows, however late.

    Every batch leaves its moments per sensor and window (count, sum, squared deviations, extremes) in
    ``window_moments``.  A window closes once a reading newer than its end by ``wait`` has been seen; it is then put
    together from its moments.  A row that comes later adds its moments, and the window is put together anew and
    replaces its row.  A batch reads the moments of the windows it closes or touches only.  Run again, a batch finds
    its moments there and changes nothing.  The moments are kept, as any window may still get a row.
    """
    duration = duration or WINDOW_TYPES[window_type]
    kept = TableStore(store.spark, store.root, _TABLES)
    length, delay = (dt.timedelta(microseconds=micros(x)) for x in (duration, wait))

    def seen_before(batch_id: int) -> dt.datetime | None:
        here = batch_id // BATCHES_PER_RANGE
        rows = kept.read("window_progress").filter(
            F.col(BATCH_RANGE).isin(here, here - 1)
            & (F.col("window_type") == window_type)
            & (F.col("batch_id") < batch_id)
        )
        return rows.agg(F.max("newest")).first()[0]

    def process(batch: DataFrame, batch_id: int) -> None:
        parts = partial_moments(batch, window_type, duration).withColumn("batch_id", F.lit(batch_id).cast("long"))
        parts = cut_lineage(parts)
        before = seen_before(batch_id)
        newest = parts.agg(F.max("newest")).first()[0]
        if newest is None and before is None:
            return
        newest = max(x for x in (newest, before) if x is not None)
        kept.insert_ignore("window_moments", parts.drop("newest"))
        progress = store.spark.createDataFrame(
            [(window_type, batch_id, newest)], "window_type string, batch_id long, newest timestamp"
        )
        kept.insert_ignore("window_progress", progress)

        mark = newest - delay
        closed = F.col("window_end") <= F.lit(mark)
        late = parts.filter(closed).select(*_KEY[:2]).distinct()
        own = (F.col("window_type") == window_type) & (F.col("batch_id") <= batch_id)
        there = kept.read("window_moments").filter(own)
        beside = kept.rows_beside("window_moments", kept.stored("window_moments", parts.filter(closed))).filter(own)
        touched = beside.join(late, list(_KEY[:2]), "left_semi")
        if before is None:
            closing = there.filter(closed)
        else:
            last = before - delay
            recent = (F.col("date") >= F.to_date(F.lit(last - length))) & (F.col("date") <= F.to_date(F.lit(mark)))
            closing = there.filter(recent & closed & (F.col("window_end") > F.lit(last)))
        moments = closing.unionByName(touched).dropDuplicates(list(_KEY))
        store.upsert_replace("aggregates", merge_moments(moments, digits))

    writer = readings.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def run_to_table(
    result: DataFrame, path: str, checkpoint: str, mode: str = "append"
) -> DataFrame:
    """Drain a streaming result into a Parquet folder and read it back.

    ``complete`` results replace the folder at every batch, ``append`` results use the file
    sink.
    """
    if mode == "complete":

        def replace(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)

        writer = result.writeStream.outputMode("complete").foreachBatch(replace)
    else:
        writer = result.writeStream.outputMode(mode).format("parquet").option("path", path)
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return result.sparkSession.read.schema(result.schema).parquet(path)
