import datetime as dt
import json

from pyspark.sql import functions as F

from tests.conftest import rows
from zephyrine.operators.features import select_available
from zephyrine.operators.joins import insert_missing_sensors, split_known_sensors
from zephyrine.operators.validate import (
    default_fields,
    first_writer_wins,
    flatten_reading,
    parse_payload,
    sanitize_ranges,
    split_valid,
    validate_battery,
    with_reject_reason,
)
from zephyrine.schemas import MEASURED


def message(**changes):
    body = {
        "sensor_id": "a",
        "timestamp": "2024-01-01T00:00:00Z",
        "location": {"lat": 1, "lon": 2, "city": "x", "zone": "traffic"},
        "measurements": {"pm2_5": 1.5},
        "battery_level": 50,
    }
    body.update(changes)
    return {k: v for k, v in body.items() if v != "absent"}


def judged(spark, *bodies):
    texts = [(i, b if isinstance(b, str) or b is None else json.dumps(b)) for i, b in enumerate(bodies)]
    df = spark.createDataFrame(texts, "i int, value string")
    return {r["i"]: r for r in with_reject_reason(parse_payload(df)).collect()}


def test_reasons(spark):
    found = judged(
        spark,
        message(),
        '{"sensor_id": "a", ',
        message(sensor_id="absent"),
        message(timestamp="absent"),
        message(timestamp="yesterday"),
        message(location="absent"),
        message(location={"lat": 1, "lon": 2, "city": "x"}),
        message(measurements="absent"),
        message(measurements={"pm2_5": "high"}),
        message(battery_level=101),
        message(battery_level=-1),
        message(battery_level=0),
        message(battery_level=100),
        message(battery_level=None),
        None,
        message(measurements={}),
    )
    assert {i: r["reason"] for i, r in found.items()} == {
        0: None,
        1: "malformed_json",
        2: "missing_sensor_id",
        3: "missing_timestamp",
        4: "malformed_json",
        5: "missing_location",
        6: "missing_location",
        7: "missing_measurements",
        8: "malformed_json",
        9: "battery_out_of_range",
        10: "battery_out_of_range",
        11: None,
        12: None,
        13: None,
        15: None,
    }


def test_offset_timestamps_are_instants(spark):
    found = judged(
        spark,
        message(timestamp="2024-01-01T02:00:00+02:00"),
        message(timestamp="2024-01-01T00:00:00Z"),
    )
    assert found[0]["timestamp"] == found[1]["timestamp"]


def test_split_keeps_the_raw_text_of_rejects(spark):
    df = spark.createDataFrame([("{broken",), (json.dumps(message()),)], "value string")
    valid, rejected = split_valid(parse_payload(df))
    assert rows(rejected, "reason", "value") == [("malformed_json", "{broken")]
    flat = flatten_reading(valid)
    assert flat.columns == ["sensor_id", "timestamp", *MEASURED, "battery_level"]
    assert flat.first()["pm2_5"] == 1.5


def test_ranges(spark):
    data = [
        (-0.01, -50.01, -0.01),
        (0.0, -50.0, 0.0),
        (1.0, 60.0, 100.0),
        (float("nan"), 60.01, 100.01),
    ]
    df = spark.createDataFrame(data, "pm2_5 double, temperature double, humidity double")
    assert [tuple(r) for r in sanitize_ranges(df).collect()] == [
        (None, None, None),
        (0.0, -50.0, 0.0),
        (1.0, 60.0, 100.0),
        (None, None, None),
    ]


def test_battery(spark):
    df = spark.createDataFrame([(b,) for b in (-1, 0, 100, 101, None)], "battery_level int")
    assert rows(validate_battery(df)) == [(0,), (100,), (None,)]


def test_defaults_fill_nulls_and_missing_columns(spark):
    df = spark.createDataFrame([("x", None), (None, 1)], "city string, n int")
    made = default_fields(df, {"city": "unknown", "status": "active"})
    assert rows(made, "city", "n", "status") == [("unknown", 1, "active"), ("x", None, "active")]


def test_first_writer_wins(spark):
    data = [("a", 2, "late"), ("a", 1, "early"), ("b", 5, "only")]
    df = spark.createDataFrame(data, "k string, created_at int, v string")
    assert rows(first_writer_wins(df, ("k",)), "k", "v") == [("a", "early"), ("b", "only")]


def test_first_writer_filters_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("created_at"))
    plan = first_writer_wins(df, ("k",))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # one on each side of the exchange


def test_unknown_sensors(spark):
    day = dt.datetime(2024, 1, 1)
    facts = spark.createDataFrame([("a", day), ("z", day), ("z", day)], "sensor_id string, t timestamp")
    sensors = spark.createDataFrame([("a", "x")], "sensor_id string, city string")
    known, unknown = split_known_sensors(facts, sensors)
    assert rows(known, "sensor_id") == [("a",)]
    assert rows(unknown, "sensor_id") == [("z",), ("z",)]
    assert rows(insert_missing_sensors(facts, sensors)) == [("z", 0.0, 0.0, "OpenAQ", "unknown")]


def test_select_available(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert select_available(df, ("c", "q", "b"), keep=("a",)).columns == ["a", "c", "b"]
