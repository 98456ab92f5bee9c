"""The monitoring views.

Each is a function of the tables and ``as_of``; ``register_views`` makes them available to SQL.
Ordering happens here and nowhere below.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zephyrine.functions.moments import Moment
from zephyrine.operators import quality, registry, rolling, summaries
from zephyrine.operators.filters import filter_since
from zephyrine.schemas import POLLUTANTS


@dataclass
class Tables:
    """What the views read; leave out the tables a view does not need."""

    measurements: DataFrame | None = None
    sensors: DataFrame | None = None
    anomalies: DataFrame | None = None
    daily_summaries: DataFrame | None = None
    etl_heartbeat: DataFrame | None = None
    quality_metrics: DataFrame | None = None
    model_runs: DataFrame | None = None


def order_output(df: DataFrame, *by: str) -> DataFrame:
    """``-name`` sorts descending."""
    keys = [F.col(b[1:]).desc() if b.startswith("-") else F.col(b).asc() for b in by]
    return df.orderBy(*keys)


def sensor_latest(t: Tables, as_of: Moment) -> DataFrame:
    newest = rolling.latest_per_sensor(t.measurements)
    place = t.sensors.select("sensor_id", "lat", "lon", "city", "zone")
    return order_output(newest.join(place, "sensor_id"), "sensor_id")


_AVERAGES = {p: f"avg_{p}" for p in POLLUTANTS}


def pollutant_timeseries_24h(t: Tables, as_of: Moment) -> DataFrame:
    recent = filter_since(t.measurements, as_of, "24 hours")
    series = rolling.bucket_averages(recent, _AVERAGES, count_as="record_count")
    return order_output(series, "bucket")


def sensor_pollutant_24h(t: Tables, as_of: Moment) -> DataFrame:
    recent = filter_since(t.measurements, as_of, "24 hours")
    wanted = {p: _AVERAGES[p] for p in ("pm2_5", "no2", "o3")}
    series = rolling.bucket_averages(recent, wanted, keys=("sensor_id",))
    return order_output(series, "sensor_id", "bucket")


def anomaly_feed(t: Tables, as_of: Moment) -> DataFrame:
    return order_output(summaries.anomaly_feed(t.anomalies, t.sensors, as_of), "-timestamp")


def anomaly_by_city_24h(t: Tables, as_of: Moment) -> DataFrame:
    counts = summaries.anomaly_by_city(t.anomalies, t.sensors, as_of)
    return order_output(counts, "-anomaly_count")


def zone_hourly_avg(t: Tables, as_of: Moment) -> DataFrame:
    hourly = summaries.zone_hourly_avg(t.measurements, t.sensors, as_of)
    return order_output(hourly, "zone", "hour")


def model_registry(t: Tables, as_of: Moment) -> DataFrame:
    return registry.model_registry(t.model_runs).select(
        "registry_name", "version", "stage", "run_id", "created_at"
    )


def anomaly_detection_daily(t: Tables, as_of: Moment) -> DataFrame:
    return order_output(summaries.anomaly_detection_daily(t.anomalies, as_of), "-report_date")


def feature_drift_pm25(t: Tables, as_of: Moment) -> DataFrame:
    return order_output(summaries.feature_drift(t.measurements, as_of), "bucket")


def pm25_residuals_daily(t: Tables, as_of: Moment) -> DataFrame:
    daily = summaries.residuals_daily(t.measurements, t.daily_summaries, as_of)
    return order_output(daily, "-report_date")


def model_stage_quality(t: Tables, as_of: Moment) -> DataFrame:
    recent = quality.recent_quality(t.quality_metrics, as_of, days=14)
    return order_output(recent, "table_name", "-pipeline_date")


def etl_health(t: Tables, as_of: Moment) -> DataFrame:
    return quality.etl_health(t.etl_heartbeat, as_of)


def etl_throughput_hourly(t: Tables, as_of: Moment) -> DataFrame:
    return order_output(summaries.throughput_hourly(t.measurements, as_of), "-hour")


def daily_volume(t: Tables, as_of: Moment) -> DataFrame:
    return order_output(summaries.daily_volume(t.measurements, as_of), "-report_date")


def sensor_activity(t: Tables, as_of: Moment) -> DataFrame:
    activity = summaries.sensor_activity(t.sensors, t.measurements, as_of)
    return order_output(activity, "-readings_last_hour")


def data_quality_trend(t: Tables, as_of: Moment, digits: int | None = 2) -> DataFrame:
    recent = quality.recent_quality(t.quality_metrics, as_of, days=30)
    percent = F.col("null_rate") * 100
    trend = rolling.quality_trend(recent).withColumn(
        "null_rate_pct", percent if digits is None else F.round(percent, digits)
    )
    return order_output(trend.drop("null_rate"), "table_name", "-pipeline_date")


def anomaly_rate_daily(t: Tables, as_of: Moment) -> DataFrame:
    rate = summaries.anomaly_rate_daily(t.measurements, t.anomalies, as_of)
    return order_output(rate, "-report_date")


def consumer_lag_proxy(t: Tables, as_of: Moment) -> DataFrame:
    return summaries.lag_proxy(t.measurements, as_of)


def city_daily_summary(t: Tables, as_of: Moment) -> DataFrame:
    daily = summaries.city_daily_summary(t.daily_summaries, t.sensors, as_of)
    return order_output(daily, "-summary_date", "city")


View = Callable[[Tables, Moment], DataFrame]

VIEWS: dict[str, View] = {
    "v_sensor_latest": sensor_latest,
    "v_pollutant_timeseries_24h": pollutant_timeseries_24h,
    "v_sensor_pollutant_24h": sensor_pollutant_24h,
    "v_anomaly_feed": anomaly_feed,
    "v_anomaly_by_city_24h": anomaly_by_city_24h,
    "v_zone_hourly_avg": zone_hourly_avg,
    "v_model_registry": model_registry,
    "v_anomaly_detection_daily": anomaly_detection_daily,
    "v_feature_drift_pm25": feature_drift_pm25,
    "v_pm25_residuals_daily": pm25_residuals_daily,
    "v_model_stage_comparison": model_stage_quality,
    "v_etl_pipeline_health": etl_health,
    "v_etl_throughput_hourly": etl_throughput_hourly,
    "v_daily_volume": daily_volume,
    "v_sensor_activity": sensor_activity,
    "v_data_quality_trend": data_quality_trend,
    "v_anomaly_rate_daily": anomaly_rate_daily,
    "v_kafka_lag_proxy": consumer_lag_proxy,
    "v_city_daily_summary": city_daily_summary,
}

_NEEDS = {
    "v_sensor_latest": ("measurements", "sensors"),
    "v_pollutant_timeseries_24h": ("measurements",),
    "v_sensor_pollutant_24h": ("measurements",),
    "v_anomaly_feed": ("anomalies", "sensors"),
    "v_anomaly_by_city_24h": ("anomalies", "sensors"),
    "v_zone_hourly_avg": ("measurements", "sensors"),
    "v_model_registry": ("model_runs",),
    "v_anomaly_detection_daily": ("anomalies",),
    "v_feature_drift_pm25": ("measurements",),
    "v_pm25_residuals_daily": ("measurements", "daily_summaries"),
    "v_model_stage_comparison": ("quality_metrics",),
    "v_etl_pipeline_health": ("etl_heartbeat",),
    "v_etl_throughput_hourly": ("measurements",),
    "v_daily_volume": ("measurements",),
    "v_sensor_activity": ("measurements", "sensors"),
    "v_data_quality_trend": ("quality_metrics",),
    "v_anomaly_rate_daily": ("measurements", "anomalies"),
    "v_kafka_lag_proxy": ("measurements",),
    "v_city_daily_summary": ("daily_summaries", "sensors"),
}


def register_views(tables: Tables, as_of: Moment) -> list[str]:
    """Temp views for every view whose tables are present; returns their names."""
    made = [n for n in VIEWS if all(getattr(tables, t) is not None for t in _NEEDS[n])]
    for name in made:
        VIEWS[name](tables, as_of).createOrReplaceTempView(name)
    return made
