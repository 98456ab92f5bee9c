import datetime as dt
import json
import os

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import rows
from zephyrine.operators import quality
from zephyrine.operators.features import FORECAST_FEATURES
from zephyrine.operators.rolling import (
    delta_features,
    merge_moments,
    partial_moments,
    rolling_features,
    rolling_stats,
)
from zephyrine.operators.validate import dedup_stream
from zephyrine.schemas import MEASURED, POLLUTANTS
from zephyrine.sources.messages import read_landed_stream, write_anomaly_files
from zephyrine.sources import tables
from zephyrine.sources.tables import TableStore
from zephyrine.streaming.ingest import clean_stream, ingest_batch, start_ingest
from zephyrine.streaming.scoring import _InTimeOrder, stream_features
from zephyrine.streaming.windows import run_to_table, start_lasting_stats, start_rolling_stats

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def message(sensor="a", seconds=0, pm2_5=10.0, **values):
    return json.dumps(
        {
            "sensor_id": sensor,
            "timestamp": (START + dt.timedelta(seconds=seconds)).isoformat(),
            "location": {"lat": 1, "lon": 2, "city": "x", "zone": "traffic"},
            "measurements": {"pm2_5": pm2_5, **values},
            "battery_level": 50,
        }
    )


def land(folder, number, lines):
    with open(f"{folder}/{number:03d}.txt", "w") as out:
        out.write("\n".join(lines) + "\n")
    os.utime(out.name, (1.7e9 + number, 1.7e9 + number))  # the source reads the oldest first


def sensors(spark):
    return spark.createDataFrame([("a",), ("b",)], "sensor_id string")


def test_ingest_from_files(spark, folder):
    os.mkdir(f"{folder}/in")
    land(f"{folder}/in", 0, [message("a", 0, 80.0), message("a", 0, 1.0), "{broken", message("z", 5, 30.0)])
    land(f"{folder}/in", 1, [message("a", 0, 80.0), message("b", 9, -5.0), message("b", 10, 26.0, co=11.0)])
    store = TableStore(spark, f"{folder}/tables")
    published = []

    def publish(events, batch_id):
        published.append((batch_id, events.count()))

    for _ in range(2):  # the second start finds everything committed
        stream = read_landed_stream(spark, f"{folder}/in", files_per_batch=1)
        start_ingest(
            stream, store, sensors(spark), f"{folder}/checkpoint", publish=publish, once=True
        ).awaitTermination()
    kept = store.read("measurements")
    assert kept.count() == 3
    assert rows(kept.filter("sensor_id = 'b'"), "pm2_5") == [(26.0,), (None,)]
    assert rows(store.read("quarantine"), "reason") == [("malformed_json",), ("unknown_sensor",)]
    found = store.read("anomalies")
    # A reading of an unknown sensor is not stored, but its anomalies are.
    assert ("z", "pm2_5", "warning") in rows(found, "sensor_id", "pollutant", "severity")
    assert rows(found.filter("sensor_id = 'b'"), "pollutant", "severity") == [
        ("co", "critical"),
        ("pm2_5", "warning"),
    ]
    assert found.filter("raw_payload is null").count() == 0
    beats = quality.heartbeat(store.read("heartbeat_deltas"))
    assert beats.agg(F.sum("records_processed")).first()[0] == 4
    assert sorted(b for b, _ in published) == [0, 1]


def batch(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_a_rerun_batch_adds_nothing(spark, folder):
    store = TableStore(spark, folder)
    first = batch(spark, message("a", 0, 80.0), message("a", 1, 20.0))
    for _ in range(2):
        ingest_batch(first, 0, store, sensors(spark))
    ingest_batch(batch(spark, message("a", 0, 99.0), message("b", 0, 90.0)), 1, store, sensors(spark))
    assert rows(store.read("measurements"), "sensor_id", "pm2_5") == [
        ("a", 20.0), ("a", 80.0), ("b", 90.0),
    ]
    assert rows(store.read("anomalies"), "sensor_id", "value") == [("a", 80.0), ("b", 90.0)]
    assert store.read("raw_archive").count() == 3
    beats = quality.heartbeat(store.read("heartbeat_deltas"))
    assert beats.agg(F.sum("records_processed")).first()[0] == 3


def test_a_batch_is_read_once_and_its_rows_are_not_stored_between(spark, folder, monkeypatch):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        read.add(1)
        return text

    texts = [message("a", 0, 80.0), message("a", 0, 81.0), message("b", 1, 1.0), "{", "{", '{"sensor_id": "a"}']
    messages = batch(spark, *texts).withColumn("value", counted.asNondeterministic()("value"))
    stored = []
    kept = tables.cut_lineage
    monkeypatch.setattr(tables, "cut_lineage", lambda df: stored.append(df.columns) or kept(df))
    store = TableStore(spark, folder)
    ingest_batch(messages, 0, store, sensors(spark))
    assert read.value == len(texts)
    assert len(stored) == 1 and "records_processed" in stored[0]
    assert rows(store.read("quarantine"), "reason") == [
        ("malformed_json",), ("malformed_json",), ("missing_timestamp",),
    ]
    assert rows(store.read("measurements"), "sensor_id", "pm2_5") == [("a", 80.0), ("b", 1.0)]
    assert store.read("raw_archive").count() == 2


def test_strict_registry(spark, folder):
    store = TableStore(spark, folder)
    ingest_batch(batch(spark, message("z", 0, 80.0)), 0, store, sensors(spark), strict_registry=True)
    assert store.read("measurements").count() == store.read("anomalies").count() == 0
    assert store.read("raw_archive").count() == 0
    assert rows(store.read("quarantine"), "reason") == [("unknown_sensor",)]


def test_closed_windows_and_late_rows(spark, folder):
    os.mkdir(f"{folder}/in")
    land(f"{folder}/in", 0, [message("a", 0, 1.0), message("a", 30, 3.0)])
    land(f"{folder}/in", 1, [message("a", 100, 9.0), message("a", 50, 5.0)])  # in time
    land(f"{folder}/in", 2, [message("a", 400, 1.0)])  # closes the first windows
    land(f"{folder}/in", 3, [message("a", 410, 1.0)])
    land(f"{folder}/in", 4, [message("a", 10, 99.0), message("a", 420, 1.0)])  # too late
    store = TableStore(spark, f"{folder}/tables")
    stream = clean_stream(read_landed_stream(spark, f"{folder}/in", files_per_batch=1))
    query = start_rolling_stats(
        stream, store, "1min", f"{folder}/checkpoint", watermark="2 minutes", once=True
    )
    query.awaitTermination()
    found = store.read("aggregates")
    assert rows(found, "pm2_5_mean", "pm2_5_std", "record_count") == [
        (3.0, 2.0, 3),
        (9.0, 0.0, 1),
    ]


def test_late_rows_reach_their_closed_windows(spark, folder):
    os.mkdir(f"{folder}/in")
    land(f"{folder}/in", 0, [message("a", 0, 1.0), message("a", 30, 3.0, pm10=2.0)])
    land(f"{folder}/in", 1, [message("a", 400, 1.0)])  # closes the first window
    land(f"{folder}/in", 2, [message("a", 10, 99.0), message("a", 20, None), message("b", 5, 4.0)])  # late
    land(f"{folder}/in", 3, [message("b", 1000, 1.0)])
    store = TableStore(spark, f"{folder}/tables")
    stream = clean_stream(read_landed_stream(spark, f"{folder}/in", files_per_batch=1))
    start_lasting_stats(
        stream, store, "1min", f"{folder}/checkpoint", wait="2 minutes", once=True
    ).awaitTermination()
    columns = ("sensor_id", "pm2_5_mean", "pm2_5_std", "pm2_5_max", "pm10_mean", "record_count")
    whole = rolling_stats(clean_stream(spark.read.text(f"{folder}/in")), "1min", digits=4)
    closed = whole.filter(f"unix_seconds(window_end) <= {int(START.timestamp()) + 880}")
    found = rows(store.read("aggregates"), *columns)
    assert found == rows(closed, *columns)
    assert ("a", 34.3333, 56.0119, 99.0, 2.0, 4) in found


def test_moments_merge_to_the_statistics_of_all_rows(spark):
    table = readings(spark).withColumn("pm10", F.when(F.rand(3) > 0.3, F.col("pm10")))
    halves = [table.filter(F.pmod(F.xxhash64("timestamp"), F.lit(3)) == k) for k in range(3)]
    parts = [partial_moments(h, "5min", "5 minutes").drop("newest") for h in halves]
    merged = merge_moments(parts[0].unionByName(parts[1]).unionByName(parts[2]), 6)
    whole = rolling_stats(table, "5min", digits=6)
    assert rows(merged, *whole.columns) == rows(whole, *whole.columns)


def test_dedup_in_the_stream(spark, folder):
    os.mkdir(f"{folder}/in")
    land(f"{folder}/in", 0, [message("a", 0), message("a", 0), message("b", 0)])
    land(f"{folder}/in", 1, [message("a", 0), message("a", 1)])
    stream = clean_stream(read_landed_stream(spark, f"{folder}/in", files_per_batch=1))
    unique = dedup_stream(stream, "1 hour").select("sensor_id", "timestamp")
    done = run_to_table(unique, f"{folder}/out", f"{folder}/checkpoint")
    assert rows(done, "sensor_id") == [("a",), ("a",), ("b",)]


def test_anomaly_messages_as_files(spark, folder):
    from zephyrine.operators.anomalies import detect_threshold_anomalies

    os.mkdir(f"{folder}/in")
    land(f"{folder}/in", 0, [message("a", 0, 80.0), message("b", 0, 1.0)])
    events = detect_threshold_anomalies(clean_stream(read_landed_stream(spark, f"{folder}/in")))
    write_anomaly_files(events, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    written = spark.read.schema("key string, value string").json(f"{folder}/out").collect()
    assert [r["key"] for r in written] == ["a"]
    assert json.loads(written[0]["value"])["severity"] == "critical"


SCORED = ("pm2_5_mean_5", "pm2_5_std_5", "pm2_5_mean_15", "pm2_5_std_15", "pm2_5_delta", "pm10_mean_5", "no2_mean_5")


def readings(spark, n=60, sensors=("a", "b", "c")):
    """Readings 20 s apart with nulls, and one of a sensor that is far ahead and closes all others."""
    data = []
    for s, sensor in enumerate(sensors):
        for i in range(n):
            at = START.replace(tzinfo=None) + dt.timedelta(seconds=20 * i + s)
            value = None if i % 11 == 4 else float((i * 7 + s) % 23) / 4
            data.append((sensor, at, value, *[float(i % 5)] * 7))
    data.append(("end", START.replace(tzinfo=None) + dt.timedelta(days=9), *[0.0] * 8))
    schema = "sensor_id string, timestamp timestamp, " + ", ".join(f"{c} double" for c in MEASURED)
    return spark.createDataFrame(data, schema).withColumn("zone", F.lit("industrial"))


def streamed(spark, table, folder, arrival, files, watermark):
    """``stream_features`` over the rows in ``files`` batches, in the order of ``arrival`` (seconds)."""
    ahead = F.col("sensor_id") == "end"
    order = F.row_number().over(Window.orderBy(ahead, arrival))
    placed = table.withColumn("part", F.floor(order * files / (table.count() + 1)).cast("int")).cache()
    for part in range(files):
        placed.filter(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    done = run_to_table(stream_features(stream, watermark, 30), f"{folder}/out", f"{folder}/checkpoint")
    return done.toPandas().sort_values(["sensor_id", "timestamp"], ignore_index=True)


@pytest.mark.parametrize(("files", "spread"), [(1, 0), (7, 0), (7, 300), (20, 300)])
def test_streamed_features_equal_batch_features_in_any_order_of_arrival(spark, folder, files, spread):
    table = readings(spark)
    jitter = F.pmod(F.xxhash64("sensor_id", "timestamp"), F.lit(spread)) if spread else F.lit(0)
    arrival = F.col("timestamp").cast("long") + jitter
    done = streamed(spark, table, folder, arrival, files, "10 minutes")
    whole = delta_features(rolling_features(table, POLLUTANTS, (5, 15)), POLLUTANTS).filter("sensor_id <> 'end'")
    batched = whole.toPandas().sort_values(["sensor_id", "timestamp"], ignore_index=True)
    assert set(FORECAST_FEATURES) <= set(done.columns) and len(done) == 180
    assert list(done["timestamp"]) == list(batched["timestamp"])
    for c in (*SCORED, "pm2_5"):
        pd.testing.assert_series_equal(done[c], batched[c], check_names=False, atol=1e-9)
    assert set(done["zone_enc"]) == {2}


def test_rows_behind_the_watermark_are_left_out_of_later_frames(spark, folder):
    table = readings(spark, 30, ("a",))
    late = F.col("timestamp") == F.lit(START.replace(tzinfo=None) + dt.timedelta(seconds=40))
    arrival = F.col("timestamp").cast("long") + F.when(late, 10_000).otherwise(0)
    done = streamed(spark, table, folder, arrival, 10, "1 minute")
    assert len(done) == 29 and done["pm2_5_mean_5"].iloc[2] == (0 + 7 + 21) / 4 / 3


def test_a_stopped_stream_goes_on_with_its_state(spark, folder):
    table = readings(spark).withColumn("part", F.pmod(F.unix_seconds("timestamp"), F.lit(2)))
    for part in (0, 1):
        table.filter(F.col("part") == part).drop("part").write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(table.drop("part").schema).parquet(f"{folder}/in")
        run_to_table(stream_features(stream, "20 days"), f"{folder}/out", f"{folder}/checkpoint")
    spark.createDataFrame(table.filter("sensor_id = 'end'").drop("part").collect(), table.drop("part").schema) \
        .withColumn("timestamp", F.expr("timestamp + interval 30 days")).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(table.drop("part").schema).parquet(f"{folder}/in")
    done = run_to_table(stream_features(stream, "20 days"), f"{folder}/out", f"{folder}/checkpoint")
    batched = delta_features(rolling_features(table, POLLUTANTS, (5, 15)), POLLUTANTS)
    columns = ("sensor_id", "timestamp", "pm2_5_mean_15", "pm2_5_delta")
    assert rows(done.filter("sensor_id <> 'end'"), *columns) == rows(batched.filter("sensor_id <> 'end'"), *columns)


class _Held:
    """The states and timers of one key in a dict, with a count of the calls."""

    def __init__(self):
        self.calls, self.values, self.timers, self.past_value = 0, {}, set(), None

    def getMapState(self, *_):  # noqa: N802
        return self

    def getValueState(self, *_):  # noqa: N802
        return self

    def _counted(self, value=None):
        self.calls += 1
        return value

    def getValue(self, key):  # noqa: N802
        return self._counted(self.values.get(key))

    def updateValue(self, key, value):  # noqa: N802
        self._counted(self.values.update({key: value}))

    def removeKey(self, key):  # noqa: N802
        self._counted(self.values.pop(key))

    def keys(self):
        return self._counted(list(self.values))

    def listTimers(self):  # noqa: N802
        return self._counted(sorted(self.timers))

    def registerTimer(self, at):  # noqa: N802
        self._counted(self.timers.add(at))

    def exists(self):
        return self._counted(self.past_value is not None)

    def get(self):
        return self._counted(self.past_value)

    def update(self, value):
        self.past_value = self._counted(value)


class _Moment:
    def __init__(self, at):
        self.getExpiryTimeInMs = self.getCurrentWatermarkInMs = lambda: at


def test_state_calls_do_not_grow_with_sensors(spark):
    def drained(sensors):
        at = [k * 400_000 for k in range(20) for _ in range(sensors)]
        ids = [None if s == 0 else f"s{s:04d}" for _ in range(20) for s in range(sensors)]
        frame = pd.DataFrame({"sensor_id": ids, "at": at, "zone": None, **{c: 1.0 * pd.Series(at) for c in MEASURED}})
        held, work, found = _Held(), _InTimeOrder(1000), []
        work.init(held)
        for part in (frame[frame["at"] % 800_000 == 0], frame[frame["at"] % 800_000 > 0]):
            assert list(work.handleInputRows((0,), iter([part.iloc[:7], part.iloc[7:]]), None)) == []
        for watermark in (3_001, 100_000):
            for timer in sorted(t for t in held.timers if t < watermark):
                held.timers.remove(timer)
                found += work.handleExpiredTimer((0,), _Moment(watermark), _Moment(timer))
        assert not held.values and not held.timers
        made = pd.concat(found, ignore_index=True).sort_values("at", kind="stable")
        for sensor in ("s0001", None):
            own = made[made["sensor_id"].isna() if sensor is None else made["sensor_id"] == sensor]
            assert len(own) == 20 and own["pm2_5_mean_15"].iloc[-1] == 12 * 400_000
            assert list(own["pm2_5_delta"]) == [0.0] + 19 * [400_000.0]
        return held.calls

    assert drained(300) == drained(2) < 120
