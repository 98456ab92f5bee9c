"""The stream operators, run as streaming queries over the event files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from workload.aggregates import ANOMALY_SQL, ROLLING_SQL
from workload.projection import EVENTS, World, with_tables
from workload.registry import query, rounded
from zephyrine.operators import anomalies, rolling, validate
from zephyrine.session import scratch_path
from zephyrine.sources import segments
from zephyrine.streaming.scoring import stream_features as features_in_order
from zephyrine.streaming.windows import run_to_table


def arriving_stream(w: World, slices: int = 5) -> DataFrame:
    """The events landed in slices of their arrival, up to three days late, as a stream of readings, a slice per batch.

    The last file holds one reading of an unknown sensor far ahead, which lets the watermark pass all others.
    """
    place = scratch_path(w.spark, "arriving")
    arrival = F.unix_micros("ts") + F.pmod(F.xxhash64("event_id"), F.lit(3 * 86_400_000_000))
    placed = w.events.withColumn("arrival", arrival)
    first, last = placed.agg(F.min("arrival"), F.max("arrival")).first()
    number = F.floor((F.col("arrival") - first) * slices / (last - first + 1))
    files = w.spark.sparkContext.defaultParallelism
    for k in range(slices):
        part = placed.filter(number == k).drop("arrival")
        part.repartition(files, "event_id", "ts").write.mode("append").parquet(place)
    ahead = "-1L event_id, timestamp'2100-01-01' ts, -1L user_id, 'click' event_type, 0D value, '{\"k\": 0}' props"
    w.spark.sql(f"select {ahead}").write.mode("append").parquet(place)
    landed = w.spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files).parquet(place)
    stream = w.project(landed.withWatermark("ts", "12 days"))
    return stream.join(w.sensors.select("sensor_id", "zone"), "sensor_id")


def _drain(w: World, result: DataFrame, name: str, mode: str = "append") -> DataFrame:
    place = scratch_path(w.spark, name)
    return run_to_table(result, f"{place}/out", f"{place}/checkpoint", mode)


@query(with_tables("m") + 'select sensor_id, "timestamp", event_id from m')
def stream_dedup(w: World) -> DataFrame:
    twice = w.event_stream.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    unique = validate.dedup_stream(twice, "1 day")
    return _drain(w, unique.select("sensor_id", "timestamp", "event_id"), "dedup")


@query(ANOMALY_SQL)
def stream_anomalies(w: World) -> DataFrame:
    return _drain(w, anomalies.detect_threshold_anomalies(w.event_stream), "anomalies")


@query(ROLLING_SQL)
def stream_rolling_stats(w: World) -> DataFrame:
    stats = rolling.rolling_stats(w.event_stream, "1day", "1 day")
    made = _drain(w, stats, "rolling", "complete")
    return rounded(made, 6, "pm2_5_std", "pm10_std", "no2_std")


def _framed(column: str, width: int, how: str) -> str:
    frame = f"over (partition by sensor_id order by \"timestamp\" rows between {width - 1} preceding and current row)"
    value = f"avg({column}) {frame}" if how == "mean" else f"coalesce(stddev_samp({column}) {frame}, 0)"
    return f"round({value}, 6) as {column}_{how}_{width}"


_IN_ORDER = [("pm2_5", 5, "mean"), ("pm2_5", 5, "std"), ("pm2_5", 15, "mean"), ("pm2_5", 15, "std"),
             ("pm10", 5, "mean"), ("no2", 5, "mean")]


@query(
    with_tables("m", "s")
    + f"""select sensor_id, "timestamp", {", ".join(_framed(*f) for f in _IN_ORDER)},
    coalesce(pm2_5 - lag(pm2_5) over (partition by sensor_id order by "timestamp"), 0) as pm2_5_delta
    from m join s using (sensor_id)"""
)
def stream_features(w: World) -> DataFrame:
    """Rolling features of the landed stream equal those of the whole table, whatever the order of arrival."""
    made = _drain(w, features_in_order(arriving_stream(w), watermark=None, bucket_seconds=3600), "features")
    names = [f"{c}_{how}_{width}" for c, width, how in _IN_ORDER]
    return rounded(made.select("sensor_id", "timestamp", *names, "pm2_5_delta"), 6, *names)


_MICROS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


@query(ANOMALY_SQL)
def segment_round_trip(w: World) -> DataFrame:
    """Readings through a topic, half before a stop and half after it, their anomalies through another topic.

    The second run goes on at the first one's offsets; each anomaly is in the outgoing topic once.
    """
    place = scratch_path(w.spark, "topics")
    readings = w.measurements.select(F.col("sensor_id").alias("key"), F.to_json(F.struct("*"), _MICROS).alias("value"))
    kind = w.measurements.schema
    out = T.StructType.fromDDL("sensor_id string, timestamp timestamp, anomaly_type string, severity string, "
                               "pollutant string, value double, threshold double")  # fmt: skip
    half = F.pmod(F.xxhash64("key", "value"), F.lit(2))
    for k in range(2):
        segments.append_segments(readings.filter(half == k), f"{place}/raw")
        stream = segments.read_segment_stream(w.spark, f"{place}/raw", group="detector")
        flat = stream.select(F.from_json("value", kind, _MICROS).alias("r")).select("r.*")
        found = anomalies.detect_threshold_anomalies(flat).select(*out.names)
        messages = found.select(F.col("sensor_id").alias("key"), F.to_json(F.struct("*"), _MICROS).alias("value"))
        segments.start_segment_sink(messages, f"{place}/anomalies", f"{place}/checkpoint", once=True).awaitTermination()
    kept = segments.read_segments(w.spark, f"{place}/anomalies")
    return kept.select(F.from_json("value", out, _MICROS).alias("r")).select("r.*")
