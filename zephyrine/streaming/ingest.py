"""Raw messages -> measurements, raw archive, anomalies, heartbeat, quarantine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from zephyrine.operators.anomalies import detect_threshold_anomalies
from zephyrine.operators.joins import split_known_sensors
from zephyrine.operators.quality import heartbeat_delta
from zephyrine.operators.validate import (
    first_of_valid,
    flatten_reading,
    parse_payload,
    quarantine,
    sanitize_ranges,
    split_judged,
    split_valid,
    with_reject_reason,
)
from zephyrine.schemas import MEASUREMENT_KEY
from zephyrine.sources.tables import TableStore


def ingest_batch(
    messages: DataFrame,
    batch_id: int,
    store: TableStore,
    sensors: DataFrame,
    strict_registry: bool = False,
    publish: Callable[[DataFrame, int], None] | None = None,
) -> None:
    """Write one batch of messages to all tables; running it again changes nothing.

    The archive decides what is a repeat: keys accepted by earlier batches are skipped, those of
    this batch are not, so a batch that failed half-way is completed by its rerun.  Readings of
    unknown sensors never reach ``measurements``; unless ``strict_registry`` is set, they are
    still archived and checked for anomalies.

    The messages are parsed once.  All tables look for repeats in the same stretches of time, those of the batch.
    """
    stamp = F.current_timestamp() if "created_at" not in messages.columns else F.col("created_at")
    parsed = parse_payload(messages).withColumn("created_at", stamp)
    judged = first_of_valid(with_reject_reason(parsed), MEASUREMENT_KEY, ("created_at", "value")).persist(
        StorageLevel.MEMORY_AND_DISK
    )
    try:
        valid, rejected = split_judged(judged)
        unique = valid.withColumn("date", F.to_date("timestamp"))
        times = store.times_of("raw_archive", unique)
        earlier = store.rows_at("raw_archive", times).filter(F.col("batch_id") < batch_id)
        accepted = unique.join(earlier.select(*MEASUREMENT_KEY), list(MEASUREMENT_KEY), "left_anti")
        known, unknown = split_known_sensors(accepted, sensors)
        batch = F.lit(batch_id).cast("bigint")

        flat = sanitize_ranges(flatten_reading(known, keep=("created_at",)))
        store.insert_ignore("measurements", flat, arrival=("created_at",), times=times)

        watched = known if strict_registry else accepted
        clean = sanitize_ranges(
            flatten_reading(watched, keep=("created_at", "location", "value"))
        ).withColumnRenamed("value", "raw_payload")
        events = detect_threshold_anomalies(
            clean, keep=("sensor_id", "timestamp", "location", "raw_payload", "created_at")
        )
        store.insert_ignore("anomalies", events.drop("location"), arrival=("created_at",), times=times)
        if publish is not None:
            publish(events.drop("raw_payload", "created_at"), batch_id)

        beats = heartbeat_delta(accepted).withColumn("batch_id", batch)
        store.upsert_replace("heartbeat_deltas", beats)

        lost = unknown.select(
            F.lit("unknown_sensor").alias("reason"), F.col("value").alias("raw_payload")
        )
        store.insert_batch("quarantine", quarantine(rejected).unionByName(lost), batch_id)

        # Last, so that later batches treat these keys as repeats only once all is written.
        archived = watched.select("sensor_id", "timestamp", "value").withColumn("batch_id", batch)
        store.insert_ignore("raw_archive", archived, times=times)
    finally:
        judged.unpersist()


def start_ingest(
    messages: DataFrame,
    store: TableStore,
    sensors: DataFrame,
    checkpoint: str,
    strict_registry: bool = False,
    publish: Callable[[DataFrame, int], None] | None = None,
    once: bool = False,
) -> StreamingQuery:
    """One query feeding all row-wise sinks; progress is kept in ``checkpoint``."""

    def process(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(batch, batch_id, store, sensors, strict_registry, publish)

    writer = messages.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def clean_stream(messages: DataFrame) -> DataFrame:
    """Valid readings of a message stream, flat and sanitised, for the window queries."""
    valid, _ = split_valid(parse_payload(messages))
    return sanitize_ranges(flatten_reading(valid))
