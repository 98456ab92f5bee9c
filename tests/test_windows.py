import datetime as dt
import random

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from zephyrine.operators import rolling
from zephyrine.schemas import POLLUTANTS

START = dt.datetime(2024, 1, 1)


def series(spark, data, columns=("pm2_5",)):
    schema = "sensor_id string, timestamp timestamp, " + ", ".join(f"{c} double" for c in columns)
    return spark.createDataFrame(data, schema)


def random_rows(seed, sensors=("hot", "a", "b"), sizes=(400, 3, 70)):
    rng = random.Random(seed)
    made = []
    for name, size in zip(sensors, sizes, strict=True):
        at = START
        for _ in range(size):
            at += dt.timedelta(seconds=rng.choice([1, 5, 30, 600, 7000]))
            made.append((name, at, None if rng.random() < 0.1 else round(rng.uniform(0, 99), 2)))
    rng.shuffle(made)
    return made


def frame(data):
    pdf = pd.DataFrame(data, columns=["sensor_id", "timestamp", "pm2_5"])
    pdf["pm2_5"] = pdf["pm2_5"].astype(float)
    return pdf.sort_values(["sensor_id", "timestamp"], ignore_index=True)


@pytest.mark.parametrize("width", ["1 minute", "1 hour", "1 day", "400 days"])
def test_rolling_equals_pandas_for_every_slice_width(spark, width):
    data = random_rows(1)
    made = rolling.rolling_features(series(spark, data), ("pm2_5",), slice_width=width).toPandas()
    made = made.sort_values(["sensor_id", "timestamp"], ignore_index=True)
    expected = frame(data)
    grouped = expected.groupby("sensor_id")["pm2_5"]
    assert len(made) == len(expected)
    for n in (5, 15, 60):
        mean = grouped.transform(lambda x, n=n: x.rolling(n, min_periods=1).mean())
        std = grouped.transform(lambda x, n=n: x.rolling(n, min_periods=1).std().fillna(0))
        pd.testing.assert_series_equal(made[f"pm2_5_mean_{n}"], mean, check_names=False, atol=1e-6)
        pd.testing.assert_series_equal(made[f"pm2_5_std_{n}"], std, check_names=False, atol=1e-5)


@pytest.mark.parametrize("width", ["1 minute", "1 hour", "400 days"])
def test_delta_and_target(spark, width):
    data = random_rows(2)
    expected = frame(data)
    grouped = expected.groupby("sensor_id")["pm2_5"]
    deltas = rolling.delta_features(series(spark, data), ("pm2_5",), slice_width=width).toPandas()
    deltas = deltas.sort_values(["sensor_id", "timestamp"], ignore_index=True)
    pd.testing.assert_series_equal(
        deltas["pm2_5_delta"], grouped.diff().fillna(0), check_names=False
    )
    ahead = rolling.forecast_target(series(spark, data), "pm2_5", 3, slice_width=width).toPandas()
    ahead = ahead.sort_values(["sensor_id", "timestamp"], ignore_index=True)
    wanted = expected.assign(target=grouped.shift(-3)).dropna(subset=["target"])
    assert ahead["target"].tolist() == wanted["target"].tolist()


@settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    gaps=st.lists(st.integers(1, 5000), min_size=1, max_size=60),
    before=st.integers(0, 6),
    after=st.integers(0, 6),
)
def test_slices_never_change_a_framed_sum(spark, gaps, before, after):
    at, data = START, []
    for i, gap in enumerate(gaps):
        at += dt.timedelta(seconds=gap)
        data.append(("s", at, float(i)))
    made = rolling.over_slices(
        series(spark, data),
        {"total": lambda w: F.sum("pm2_5").over(w.rowsBetween(-before, after))},
        before=before,
        after=after,
        slice_width="1 hour",
    )
    found = {r["timestamp"]: r["total"] for r in made.collect()}
    for i, (_, t, _) in enumerate(data):
        assert found[t] == sum(range(max(0, i - before), min(len(data), i + after + 1)))


def test_slices_share_one_shuffle_of_the_rows(spark):
    made = rolling.rolling_features(series(spark, random_rows(3)), ("pm2_5",))
    made.collect()
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan


@pytest.mark.parametrize(
    ("values", "expected"),
    [
        ([0.0, 0.0, 5.0], 0.0),
        ([5.0], 0.0),
        ([0.0], 0.0),
        ([None], 0.0),
        ([1.0, 2.0], 0.7071),
        ([None, 1.0, 2.0], 0.7071),
    ],
)
def test_deviation_needs_two_values_other_than_zero(spark, values, expected):
    data = [("s", START + dt.timedelta(seconds=i), v) for i, v in enumerate(values)]
    wide = series(spark, data).select("*", *(F.lit(1.0).alias(p) for p in POLLUTANTS[1:]))
    row = rolling.rolling_stats(wide, "1min", digits=4).first()
    assert row["pm2_5_std"] == expected
    assert row["record_count"] == len(values)
    assert row["window_end"] - row["window_start"] == dt.timedelta(minutes=1)


def test_sliding_windows_and_both_durations(spark):
    data = [("s", START + dt.timedelta(seconds=90), 1.0)]
    wide = series(spark, data).select("*", *(F.lit(1.0).alias(p) for p in POLLUTANTS[1:]))
    slid = rolling.rolling_stats(wide, "5min", slide="1 minute")
    assert slid.count() == 5
    both = rolling.all_rolling_stats(wide)
    assert rows(both, "window_type") == [("1min",), ("5min",)]


def test_latest_decides_ties(spark):
    data = [("a", START, 1.0), ("a", START, 2.0), ("b", START, 3.0)]
    newest = rolling.latest_per_key(series(spark, data), order=("timestamp", "pm2_5"))
    assert rows(newest, "sensor_id", "pm2_5") == [("a", 2.0), ("b", 3.0)]


def test_quality_trend(spark):
    data = [("t", "2024-01-01", 5), ("t", "2024-01-02", 8), ("u", "2024-01-02", 1)]
    df = spark.createDataFrame(data, "table_name string, pipeline_date string, row_count long")
    assert rows(rolling.quality_trend(df), "table_name", "prev_row_count", "row_count_delta") == [
        ("t", 5, 3),
        ("t", None, None),
        ("u", None, None),
    ]


def test_a_task_takes_a_small_share_of_a_shuffle(spark):
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    try:
        dealt = spark.range(4_000_000).select(F.xxhash64("id").alias("h")).repartition("h")
        assert dealt.select(F.spark_partition_id().alias("p")).distinct().count() >= 3
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.parallelismFirst")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
