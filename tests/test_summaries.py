import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from zephyrine import schemas
from zephyrine.operators import backfill, catalog, joins, quality, summaries
from zephyrine.sources import declared
from zephyrine.sources.pages import scan_backfill_pages
from zephyrine.sources.registry_seed import SEED, load_sensor_registry, seed_sensors
from zephyrine.sources.tables import LAYOUTS

AS_OF = dt.datetime(2024, 1, 31)


def ago(**span):
    return AS_OF - dt.timedelta(**span)


def test_drift_buckets_and_the_shared_instant(spark):
    cut = ago(days=30)
    data = [
        (ago(days=40), 10.0),  # only in history, bucket 1
        (ago(days=40), 50.0),
        (ago(days=5), 50.0),
        (ago(days=5), -3.0),  # below the range, only recent
        (ago(days=5), 150.0),  # at the upper end: overflow bucket
        (cut, 70.0),  # belongs to both sides
        (ago(days=90), 70.0),  # before the history
        (ago(days=5), None),
    ]
    df = spark.createDataFrame(data, "timestamp timestamp, pm2_5 double")
    drift = summaries.feature_drift(df, AS_OF)
    found = {r["bucket"]: r for r in drift.collect()}
    counts = {b: (r["hist_count"], r["recent_count"]) for b, r in found.items()}
    assert counts == {0: (0, 1), 1: (1, 0), 4: (1, 1), 5: (1, 1), 11: (0, 1)}
    term = (1 / 4 - 1 / 3) * math.log((1 / 4) / (1 / 3))
    assert found[4]["psi_contribution"] == pytest.approx(term)
    assert found[0]["psi_contribution"] == found[1]["psi_contribution"] == 0.0
    assert summaries.drift_total(drift).first()["psi"] == pytest.approx(2 * term)


def test_activity(spark):
    sensors = spark.createDataFrame(
        [(s, "c", "z", "active") for s in "abcde"],
        "sensor_id string, city string, zone string, status string",
    )
    data = [
        ("a", ago(minutes=4)),
        ("b", ago(minutes=5)),
        ("c", ago(minutes=59)),
        ("c", ago(minutes=60)),
        ("d", ago(minutes=61)),
    ]
    facts = spark.createDataFrame(data, "sensor_id string, timestamp timestamp")
    found = summaries.sensor_activity(sensors, facts, AS_OF)
    assert rows(found, "sensor_id", "readings_last_hour", "reporting_status") == [
        ("a", 1, "active"),
        ("b", 1, "active"),
        ("c", 2, "delayed"),
        ("d", 0, "offline"),
        ("e", 0, "offline"),
    ]


def measured(spark, values):
    data = [("s", dt.datetime(2024, 1, 5, 1), v, 1.0) for v in values]
    return spark.createDataFrame(
        data, "sensor_id string, timestamp timestamp, pm2_5 double, pm10 double"
    )


@pytest.mark.parametrize(
    ("nulls", "total", "passed"), [(0, 0, True), (30, 100, True), (31, 100, False)]
)
def test_quality_gate(spark, nulls, total, passed):
    df = measured(spark, [None] * nulls + [1.0] * (total - nulls))
    row = quality.quality_gate(df, "2024-01-05").first()
    assert (row["total"], row["null_pm25"], row["passed"]) == (total, nulls, passed)
    assert row["null_rate"] == (nulls / total if total else 0.0)


def test_freshness_column_per_table(spark):
    fresh = spark.createDataFrame([(ago(minutes=9, seconds=30),)], "created_at timestamp")
    beats = spark.createDataFrame([(ago(minutes=90),)], "updated_at timestamp")
    empty = spark.createDataFrame([], "created_at timestamp")
    tables = {"sensors": fresh, "etl_heartbeat": beats, "anomalies": empty}
    found = quality.profile_tables(tables, AS_OF)
    assert rows(found, "table_name", "row_count", "freshness_minutes") == [
        ("anomalies", 0, None),
        ("etl_heartbeat", 1, 90),
        ("sensors", 1, 9),
    ]


@pytest.mark.parametrize(
    ("age", "state", "passed"),
    [(15, "running", True), (16, "running", False), (1, "stopped", False)],
)
def test_freshness_gate(spark, age, state, passed):
    as_of = dt.datetime(2024, 1, 30, 12)
    data = [(as_of.date(), as_of - dt.timedelta(minutes=age), state)]
    beats = spark.createDataFrame(data, "pipeline_date date, last_batch_ts timestamp, status string")
    assert quality.freshness_gate(beats, as_of).first()["passed"] is passed
    tomorrow = as_of + dt.timedelta(days=1)
    assert quality.freshness_gate(beats, tomorrow).first()["passed"] is False


def test_new_records(spark):
    df = spark.createDataFrame([(ago(hours=h),) for h in range(5)], "created_at timestamp")
    assert tuple(quality.count_new_records(df, ago(hours=3), 3).first()) == (3, True)
    assert tuple(quality.count_new_records(df, ago(hours=2), 3).first()) == (2, False)
    assert tuple(quality.count_new_records(df, None, 10**6).first()) == (5, True)


def test_filters_reach_the_scan(spark, folder):
    measured(spark, [1.0, None]).write.mode("overwrite").parquet(f"{folder}/m")
    df = spark.read.parquet(f"{folder}/m")
    counted = quality.count_for_day(df, "2024-01-05")
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(timestamp,2024-01-05" in plan
    assert "LessThan(timestamp,2024-01-06" in plan
    assert "ReadSchema: struct<timestamp:timestamp>" in plan


def test_residuals_equal_the_row_join(spark):
    day = dt.datetime(2024, 1, 5)
    data = [
        ("a", day, 1.0), ("a", day + dt.timedelta(hours=1), 3.0),
        ("b", day, 10.0), ("b", day + dt.timedelta(hours=2), None), ("c", day, 6.0),
    ]
    m = spark.createDataFrame(data, "sensor_id string, timestamp timestamp, pm2_5 double")
    s = spark.createDataFrame(
        [("a", day.date(), 5.0), ("b", day.date(), 11.0)],
        "sensor_id string, summary_date date, pm2_5_avg double",
    )
    row = summaries.residuals_daily(m, s, AS_OF).first()
    joined = joins.left_join_by_day(m, s).agg(F.avg("pm2_5"), F.avg("pm2_5_avg")).first()
    assert (row["actual_avg_pm25"], row["summary_avg_pm25"]) == tuple(joined) == (5.0, 8.0)


def test_pivot(spark):
    data = [
        ("s", "t1", "pm2_5", 1.0, 1), ("s", "t1", "pm2_5", 2.0, 2), ("s", "t1", "no2", 5.0, 3),
        ("s", "t2", None, 9.0, 4), ("s", "t3", "co", 1.0, 5), ("s", "t3", "co", None, 6),
    ]
    long = spark.createDataFrame(
        data, "sensor_id string, timestamp string, parameter string, value double, seq long"
    )
    wide = backfill.pivot_readings(long)
    assert rows(wide, "timestamp", "pm2_5", "no2", "co") == [
        ("t1", 2.0, 5.0, None),
        ("t2", None, None, None),
        ("t3", None, None, None),
    ]


def test_landed_pages(spark, folder):
    item = '{"date": {"utc": "%s"}, "parameter": "%s", "value": %s}'
    first = ", ".join(
        [item % ("2024-01-01T00:00:00Z", "pm25", 1.0), item % ("", "pm25", 4.0)]
    )
    second = ", ".join(
        [item % ("2024-01-01T00:00:00Z", "pm25", 2.0), item % ("2024-01-01T01:00:00Z", "wind", 7.0)]
    )
    with open(f"{folder}/pages.json", "w") as out:
        out.write(f'{{"source": 7, "page": 2, "results": [{second}]}}\n')
        out.write(f'{{"source": 7, "page": 1, "results": [{first}]}}\n')
        out.write('{"source": 8, "page": 1, "results": []}\n')
    wide = backfill.backfill_day(scan_backfill_pages(spark, folder))
    assert rows(wide, "sensor_id", "timestamp", "pm2_5") == [
        ("OAQ_7", dt.datetime(2024, 1, 1, 0), 2.0),
        ("OAQ_7", dt.datetime(2024, 1, 1, 1), None),
    ]


def test_registry_seed(spark):
    seed = seed_sensors(spark)
    assert seed.count() == len(SEED) == 50
    there = seed.filter("sensor_id = 'CAP_001'").withColumn("city", F.lit("Elsewhere"))
    loaded = load_sensor_registry(there, seed)
    assert loaded.count() == 50
    assert rows(loaded.filter("sensor_id = 'CAP_001'"), "city") == [("Elsewhere",)]


def test_catalog_keeps_rows_of_others(spark, folder):
    kept = declared.CatalogStore(spark, folder)
    kept.upsert("data_sources", spark.createDataFrame([("mine", "api", "x"), ("store", "y", "old")], schemas.DATA_SOURCES))
    for _ in range(2):
        kept.upsert("data_sources", declared.declared_sources(spark))
    found = {r["name"]: (r["source_type"], r["version"]) for r in kept.read("data_sources").collect()}
    assert found["mine"] == ("api", 1) and found["store"] == ("parquet", 2)


def test_catalog(spark):
    sources = catalog.list_sources(declared.declared_sources(spark))
    names = [r["name"] for r in sources.collect()]
    assert names == sorted(names) and "store" in names
    tables = declared.declared_tables(spark)
    assert rows(catalog.list_tables(tables, "store"), "table_name") == sorted((n,) for n in LAYOUTS)
    assert catalog.list_tables(tables, "nothing").count() == 0
    edges = rows(catalog.list_lineage(declared.declared_lineage(spark)), "source_name", "target_name")
    assert ("measurements", "daily_summaries") in edges and ("measurements", "model_store") in edges
    old = {"t": spark.createDataFrame([], "a int, b int"), "u": spark.createDataFrame([], "x int")}
    new = {
        "t": spark.createDataFrame([], "a int, b string, c int"),
        "u": spark.createDataFrame([], "x int"),
    }
    drift = catalog.schema_drift(catalog.describe_columns(old), catalog.describe_columns(new))
    assert rows(drift, "table_name", "column_name", "change") == [
        ("t", "a", "same"), ("t", "b", "retyped"), ("t", "c", "added"), ("u", "x", "same"),
    ]
    assert rows(catalog.drifted_tables(drift)) == [("t", True), ("u", False)]


def test_daily_rows_merge_within_the_bound_of_their_sketches(spark):
    rows_ = spark.range(60_000).selectExpr(
        "concat('s', xxhash64(id) % 9000) sensor_id", "id % 7 + 0.5D pm2_5",
        "timestamp'2024-01-01' + make_dt_interval(cast(id % 30 as int)) created_at",
    )
    days = summaries.volume_rows(rows_, "2024-01-31")
    merged = summaries.volume_between(days, "2024-01-02", "2024-01-20").first()
    kept = rows_.filter("created_at >= '2024-01-02' and created_at < '2024-01-21'")
    exact = kept.selectExpr("count(*) n", "avg(pm2_5) a", "max(pm2_5) m", "count(distinct sensor_id) d").first()
    assert (merged["total_records"], merged["max_pm25"]) == (exact["n"], exact["m"])
    assert abs(merged["avg_pm25"] - exact["a"]) < 1e-9
    assert abs(merged["active_sensors"] / exact["d"] - 1) < 0.03
    assert summaries.volume_between(days, "2030-01-01", "2030-01-02").first()["active_sensors"] == 0
