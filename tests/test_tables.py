import datetime as dt
import os

from pyspark.sql import functions as F

from tests.conftest import rows
from zephyrine import session
from zephyrine.functions import moments
from zephyrine.operators import filters, quality, summaries, upsert
from zephyrine.sources.tables import TableStore, stretches

DAY = dt.datetime(2024, 1, 5)


def readings(spark, data):
    return spark.createDataFrame(
        data, "sensor_id string, timestamp timestamp, pm2_5 double, created_at timestamp"
    )


def test_insert_ignore_keeps_the_first_and_survives_replay(spark, folder):
    store = TableStore(spark, folder)
    assert store.read("measurements").count() == 0
    batch = readings(
        spark,
        [("a", DAY, 2.0, DAY + dt.timedelta(hours=1)), ("a", DAY, 1.0, DAY), ("b", DAY, 3.0, DAY)],
    )
    for _ in range(2):
        store.insert_ignore("measurements", batch, arrival=("created_at",))
    later = readings(spark, [("a", DAY, 9.0, DAY), ("c", DAY + dt.timedelta(days=1), 4.0, DAY)])
    store.insert_ignore("measurements", later, arrival=("created_at",))
    assert rows(store.read("measurements"), "sensor_id", "pm2_5", "date") == [
        ("a", 1.0, DAY.date()),
        ("b", 3.0, DAY.date()),
        ("c", 4.0, DAY.date() + dt.timedelta(days=1)),
    ]


def test_upsert_replaces_only_touched_keys_and_partitions(spark, folder):
    store = TableStore(spark, folder)
    schema = "sensor_id string, summary_date date, pm2_5_avg double, record_count long"
    one, two = DAY.date(), DAY.date() + dt.timedelta(days=1)
    first = [("a", one, 1.0, 1), ("b", one, 2.0, 1), ("a", two, 3.0, 1)]
    store.upsert_replace("daily_summaries", spark.createDataFrame(first, schema))
    change = spark.createDataFrame([("a", one, 10.0, 5), ("c", one, 7.0, 2)], schema)
    for _ in range(2):
        store.upsert_replace("daily_summaries", change)
    found = store.read("daily_summaries")
    assert rows(found, "sensor_id", "summary_date", "pm2_5_avg", "record_count") == [
        ("a", one, 10.0, 5),
        ("a", two, 3.0, 1),
        ("b", one, 2.0, 1),  # vanished from the rerun, still there
        ("c", one, 7.0, 2),
    ]


def test_heartbeat_does_not_count_a_replayed_batch_twice(spark, folder):
    store = TableStore(spark, folder)
    schema = "pipeline_date date, last_batch_ts timestamp, records_processed long, status string, batch_id long"
    for batch_id, count in ((0, 5), (1, 7), (1, 7)):
        at = DAY + dt.timedelta(minutes=batch_id)
        delta = spark.createDataFrame([(DAY.date(), at, count, "running", batch_id)], schema)
        store.upsert_replace("heartbeat_deltas", delta)
    beats = quality.heartbeat(store.read("heartbeat_deltas"))
    assert rows(beats, "records_processed", "last_batch_ts") == [(12, DAY + dt.timedelta(minutes=1))]


def test_repeats_are_sought_in_the_touched_days_only(spark, folder):
    store = TableStore(spark, folder)
    for batch_id, shift in ((0, 0), (1, 1)):
        at = DAY + dt.timedelta(days=shift)
        rows_ = spark.createDataFrame(
            [("a", at, "{}", batch_id)], "sensor_id string, timestamp timestamp, value string, batch_id long"
        )
        store.insert_ignore("raw_archive", rows_)
    earlier = store.read("raw_archive").filter(F.col("date").isin([DAY.date()]) & (F.col("batch_id") < 1))
    scan = earlier._jdf.queryExecution().executedPlan().toString()
    pruned = scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "date" in pruned
    assert earlier.count() == 1


def test_time_filters_prune_the_stored_days(spark, folder):
    store = TableStore(spark, folder)
    data = [("a", DAY + dt.timedelta(days=n), 1.0) for n in range(5)]
    store.insert_ignore("measurements", spark.createDataFrame(data, "sensor_id string, timestamp timestamp, pm2_5 double"))
    stored = store.read("measurements")
    newest = DAY + dt.timedelta(days=4)
    for found, count in (
        (moments.within_day(stored, "timestamp", DAY), 1),
        (moments.recent(stored, "timestamp", newest, "2 days"), 3),
        (filters.filter_since(stored, newest, "1 day"), 2),
        (filters.filter_on_date(stored, DAY), 1),
        (quality.count_for_day(stored, DAY), 1),
        (summaries.sensor_profile(stored, newest, "1 day"), 1),
    ):
        scan = found._jdf.queryExecution().executedPlan().toString()
        assert "date" in scan.split("PartitionFilters: [")[1].split("]")[0]
        assert len(found.inputFiles()) >= 1 and found.count() == count


def test_a_write_computes_its_rows_once(spark, folder):
    store = TableStore(spark, folder)
    seen = spark.sparkContext.accumulator(0)

    def marked(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    schema = "sensor_id string, timestamp timestamp, pm2_5 double"
    data = [("a", DAY + dt.timedelta(hours=n), 1.0) for n in range(50)]
    df = spark.createDataFrame(data, schema).mapInPandas(marked, schema)
    store.insert_ignore("measurements", df)
    assert seen.value == 50


def test_batches_share_folders(spark, folder):
    store = TableStore(spark, folder)
    lost = spark.createDataFrame([("r", "x")], "reason string, raw_payload string")
    for batch_id in (0, 1, 1, 2, 1000):
        store.insert_batch("quarantine", lost, batch_id)
    assert store.read("quarantine").count() == 4
    folders = [f for f in os.listdir(f"{folder}/quarantine") if f.startswith("batch_range=")]
    assert sorted(folders) == ["batch_range=0", "batch_range=1"]
    store.compact("quarantine", [0])
    assert len(os.listdir(f"{folder}/quarantine/batch_range=0")) <= 4
    assert store.read("quarantine").count() == 4


def test_upsert_add(spark):
    schema = "d string, n long, at int"
    there = spark.createDataFrame([("x", 5, 1)], schema)
    delta = spark.createDataFrame([("x", 2, 3), ("y", 1, 1)], schema)
    assert rows(upsert.upsert_add(there, delta, ("d",), ("n",), ("at",))) == [
        ("x", 7, 3),
        ("y", 1, 1),
    ]


def test_scratch_folders_can_be_removed(spark):
    place = session.scratch_path(spark, "test")
    spark.range(3).write.parquet(f"{place}/rows")
    assert os.path.isdir(place.removeprefix("file:"))
    assert session.clean_scratch(spark) >= 1 and not os.path.isdir(place.removeprefix("file:"))


def scanned_rows(df):
    """Rows that the scan of a plan without shuffles has given out."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_a_batch_reads_the_keys_around_its_times_only(spark, folder):
    store = TableStore(spark, folder)
    seen = []
    for hour in range(8):
        times = f"timestamp'2024-01-01 {hour:02d}:00:00' + make_dt_interval(0, 0, 0, id div 20)"
        batch = spark.range(2000).selectExpr("concat('s', id % 20) sensor_id", f"{times} timestamp", "1D pm2_5")
        store.insert_ignore("measurements", batch)
        again = store.stored("measurements", batch)
        seen.append(scanned_rows(store.rows_beside("measurements", again).select("sensor_id", "timestamp")))
        store.insert_ignore("measurements", batch)  # a replay adds nothing
    assert seen == [2000] * 8  # does not grow with the day
    assert store.read("measurements").count() == 16_000
    late = spark.sql("select 's1' sensor_id, timestamp'2024-01-01 03:00:07' timestamp, 9D pm2_5 "
                     "union all select 'new', timestamp'2024-01-01 09:30:00', 9D")
    assert scanned_rows(store.rows_beside("measurements", store.stored("measurements", late))) == 2000
    store.insert_ignore("measurements", late)
    assert store.read("measurements").filter("pm2_5 = 9").count() == 1
    store.compact("measurements", [dt.date(2024, 1, 1)])
    store.insert_ignore("measurements", late)
    assert store.read("measurements").count() == 16_001


def test_stretches_close_the_smallest_gaps():
    assert stretches([5, 3, 4, 9, 20, 21], 3) == [(3, 5), (9, 9), (20, 21)]
    assert stretches([5, 3, 4, 9, 20, 21], 2) == [(3, 9), (20, 21)]
    assert stretches(list(range(0, 100, 2)), 4) == [(0, 98)]
    assert stretches([]) == []
