import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from zephyrine.functions.rules import critical_label, level, status, zone_code
from zephyrine.functions.stats import percent_of, rounded
from zephyrine.operators.anomalies import anomaly_messages, detect_threshold_anomalies
from zephyrine.operators.validate import sanitize_ranges
from zephyrine.schemas import POLLUTANTS, THRESHOLDS

SCHEMA = "sensor_id string, " + ", ".join(f"{p} double" for p in POLLUTANTS)


def expected_events(row):
    found = []
    for p, value in zip(POLLUTANTS, row[1:], strict=True):
        warning, critical = THRESHOLDS[p]
        if value is None or math.isnan(value) or value < warning:
            continue
        high = value >= critical
        found.append(
            (row[0], p, "critical" if high else "warning", value, critical if high else warning)
        )
    return found


def found_events(spark, data):
    clean = sanitize_ranges(spark.createDataFrame(data, SCHEMA))
    events = detect_threshold_anomalies(clean, keep=("sensor_id",))
    return rows(events, "sensor_id", "pollutant", "severity", "value", "threshold")


def test_limits_are_included_and_nan_is_ignored(spark):
    data = []
    for i, p in enumerate(POLLUTANTS):
        for limit in THRESHOLDS[p]:
            for value in (limit - 0.01, limit, limit + 0.01, None, float("nan")):
                row = [None] * len(POLLUTANTS)
                row[i] = value
                data.append((f"s{len(data)}", *row))
    expected = [e for row in data for e in expected_events(row)]
    assert found_events(spark, data) == sorted(expected, key=lambda r: tuple(map(repr, r)))


value = st.one_of(st.none(), st.floats(0, 400), st.sampled_from([25.0, 75.0, 150.0, 4.0, 10.0]))


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(data=st.lists(st.tuples(*[value] * 6), min_size=1, max_size=30))
def test_events_match_brute_force(spark, data):
    numbered = [(f"s{i}", *row) for i, row in enumerate(data)]
    expected = [e for row in numbered for e in expected_events(row)]
    assert found_events(spark, numbered) == sorted(expected, key=lambda r: tuple(map(repr, r)))


@pytest.mark.parametrize(
    ("pm2_5", "label", "state", "grade"),
    [
        (12.0, 0, "good", 1),
        (12.5, 0, "good", 2),
        (25.0, 0, "good", 2),
        (25.5, 0, "warning", 2),
        (35.5, 0, "warning", 3),
        (55.5, 0, "warning", 4),
        (75.0, 0, "warning", 4),
        (75.5, 1, "critical", 5),
        (None, 0, "good", 1),
    ],
)
def test_the_other_rules_exclude_their_limits(spark, pm2_5, label, state, grade):
    row = spark.createDataFrame([("s", pm2_5, *[None] * 5)], SCHEMA).select(
        critical_label(), status(), level()
    )
    assert tuple(row.first()) == (label, state, grade)


def test_zone_codes(spark):
    names = ["urban_background", "traffic", "industrial", "residential", "moon", None]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, zone string")
    assert [r[0] for r in df.orderBy("i").select(zone_code()).collect()] == [0, 1, 2, 3, 0, 0]


def test_rounding_is_half_up_on_the_shortest_form(spark):
    df = spark.createDataFrame([(54.988749999999996, 2.675, 0.125)], "a double, b double, c double")
    made = df.select(rounded(F.col("a"), 4), rounded(F.col("b"), 2), rounded(F.col("c"), 2))
    assert tuple(made.first()) == (54.9887, 2.68, 0.13)
    assert df.select(rounded(F.col("a"), None)).first()[0] == 54.988749999999996


def test_percent_of_the_limit(spark):
    df = spark.createDataFrame([(75.0, 75.0), (1.0, 0.0)], "v double, t double")
    assert rows(df.select(percent_of(F.col("v"), F.col("t")))) == [(100.0,), (None,)]


def test_messages_carry_the_sensor_as_key(spark):
    df = spark.createDataFrame([("s", 1.0)], "sensor_id string, value double")
    assert rows(anomaly_messages(df)) == [("s", '{"sensor_id":"s","value":1.0}')]
