"""Batch aggregates over measurements, anomalies and daily summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zephyrine.functions import moments
from zephyrine.functions.moments import Moment
from zephyrine.functions.rules import zone_code
from zephyrine.functions.stats import drift_term, percent_of
from zephyrine.operators.joins import (
    count_per_key,
    enrich_with_sensor,
    full_outer_histograms,
    left_join_counts,
)
from zephyrine.operators.rolling import share_of_total
from zephyrine.schemas import POLLUTANTS, SUMMARY_KEY

_SUMMARY_AVERAGES = {f"{p}_avg": p for p in POLLUTANTS}


def daily_summary(measurements: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Per sensor and day: averages, the pm2_5 peak, readings and anomalies.

    Days without readings get no row.  Both inputs may cover any number of days.
    """
    daily = (
        measurements.withColumn("summary_date", F.to_date("timestamp"))
        .groupBy(*SUMMARY_KEY)
        .agg(
            *(F.avg(p).alias(name) for name, p in _SUMMARY_AVERAGES.items()),
            F.max("pm2_5").alias("pm2_5_max"),
            F.count("*").alias("record_count"),
        )
    )
    events = anomalies.withColumn("summary_date", F.to_date("timestamp"))
    return count_per_key(daily, events, SUMMARY_KEY, "anomaly_count")


def daily_summary_of(measurements: DataFrame, anomalies: DataFrame, day: Moment) -> DataFrame:
    return daily_summary(
        moments.within_day(measurements, "timestamp", day), moments.within_day(anomalies, "timestamp", day)
    )


# fixed values: the columns of a sensor's profile
PROFILE_FEATURES = (
    "pm2_5_avg",
    "pm2_5_max",
    "pm10_avg",
    "no2_avg",
    "o3_avg",
    "co_avg",
    "so2_avg",
    "pm2_5_std",
)


def sensor_profile(measurements: DataFrame, as_of: Moment, lookback: str = "90 days") -> DataFrame:
    """One row of statistics per sensor; nulls become 0."""
    recent = moments.recent(measurements, "timestamp", as_of, lookback)
    return (
        recent.groupBy("sensor_id")
        .agg(
            *(F.avg(p).alias(name) for name, p in _SUMMARY_AVERAGES.items()),
            F.max("pm2_5").alias("pm2_5_max"),
            F.stddev_samp("pm2_5").alias("pm2_5_std"),
            F.count("*").alias("record_count"),
        )
        .na.fill(0, subset=list(PROFILE_FEATURES))
    )


def anomaly_by_city(
    anomalies: DataFrame, sensors: DataFrame, as_of: Moment, lookback: str = "24 hours"
) -> DataFrame:
    """Counted per sensor and severity first, so the join sees one row for each."""
    per_sensor = (
        moments.recent(anomalies, "timestamp", as_of, lookback)
        .groupBy("sensor_id", "severity")
        .agg(F.count("*").alias("_n"))
    )
    return (
        enrich_with_sensor(per_sensor, sensors, ("city",))
        .groupBy("city", "severity")
        .agg(F.sum("_n").alias("anomaly_count"))
    )


def zone_hourly_avg(
    measurements: DataFrame, sensors: DataFrame, as_of: Moment, lookback: str = "7 days"
) -> DataFrame:
    recent = moments.recent(measurements, "timestamp", as_of, lookback)
    return (
        enrich_with_sensor(recent, sensors, ("zone",))
        .groupBy("zone", F.date_trunc("hour", "timestamp").alias("hour"))
        .agg(
            F.avg("pm2_5").alias("avg_pm2_5"),
            F.avg("no2").alias("avg_no2"),
            F.count("*").alias("readings"),
        )
    )


def anomaly_detection_daily(
    anomalies: DataFrame, as_of: Moment, lookback: str = "30 days"
) -> DataFrame:
    def of(column: str, value: str):
        return F.count_if(F.col(column) == value)

    return (
        moments.recent(anomalies, "timestamp", as_of, lookback)
        .groupBy(F.to_date("timestamp").alias("report_date"))
        .agg(
            F.count("*").alias("total_anomalies"),
            of("severity", "critical").alias("critical_count"),
            of("severity", "warning").alias("warning_count"),
            of("anomaly_type", "rule_based").alias("rule_based_count"),
            of("anomaly_type", "ml_based").alias("ml_based_count"),
        )
    )


def histogram(
    df: DataFrame, column: str, low: float, high: float, buckets: int, count: str
) -> DataFrame:
    """Counts per equal-width bucket; 0 lies below the range and ``buckets + 1`` above it."""
    number = F.width_bucket(F.col(column), F.lit(low), F.lit(high), F.lit(buckets))
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(number.alias("bucket"))
        .agg(F.count("*").alias(count))
    )


def feature_drift(
    measurements: DataFrame,
    as_of: Moment,
    column: str = "pm2_5",
    recent: str = "30 days",
    history: str = "60 days",
    bounds: tuple[float, float, int] = (0.0, 150.0, 10),
) -> DataFrame:
    """Population stability per bucket: recent readings against the time before.

    The instant that parts the two periods belongs to both.  Buckets with an empty side
    contribute 0.
    """
    cut = moments.instant(as_of) - F.expr(f"INTERVAL {recent}")
    start = moments.instant(as_of) - F.expr(f"INTERVAL {history}")
    base = histogram(
        measurements.filter(F.col("timestamp").between(start, cut)), column, *bounds, "hist_count"
    )
    late = histogram(
        measurements.filter(F.col("timestamp") >= cut), column, *bounds, "recent_count"
    )
    shares = share_of_total(
        full_outer_histograms(base, late),
        {"hist_count": "_hist_share", "recent_count": "_recent_share"},
    )
    both = (F.col("hist_count") > 0) & (F.col("recent_count") > 0)
    # Shares are nulled before the logarithm, which ANSI mode would otherwise evaluate on 0.
    recent_share = F.when(both, F.col("_recent_share"))
    base_share = F.when(both, F.col("_hist_share"))
    term = F.coalesce(drift_term(recent_share, base_share), F.lit(0.0))
    return shares.withColumn("psi_contribution", term).drop("_hist_share", "_recent_share")


def drift_total(drift: DataFrame) -> DataFrame:
    """The index itself."""
    return drift.agg(F.sum("psi_contribution").alias("psi"))


def residuals_daily(
    measurements: DataFrame, summaries: DataFrame, as_of: Moment, lookback: str = "30 days"
) -> DataFrame:
    """Actual average against the daily summaries' average, weighted by readings.

    A row-by-row join would repeat each summary once per reading; here readings are summed per
    sensor and day first, and their number weighs the summary.
    """
    per_sensor = (
        moments.recent(measurements, "timestamp", as_of, lookback)
        .groupBy("sensor_id", F.to_date("timestamp").alias("report_date"))
        .agg(
            F.sum("pm2_5").alias("_sum"),
            F.count("pm2_5").alias("_seen"),
            F.count("*").alias("_rows"),
        )
    )
    daily = summaries.select(
        "sensor_id", F.col("summary_date").alias("report_date"), F.col("pm2_5_avg").alias("_avg")
    )
    weight = F.when(F.col("_avg").isNotNull(), F.col("_rows"))
    actual = F.sum("_sum") / F.nullif(F.sum("_seen"), F.lit(0))
    summary = F.sum(F.col("_avg") * F.col("_rows")) / F.nullif(F.sum(weight), F.lit(0))
    return (
        per_sensor.join(daily, ["sensor_id", "report_date"], "left")
        .groupBy("report_date")
        .agg(
            actual.alias("actual_avg_pm25"),
            summary.alias("summary_avg_pm25"),
            (actual - summary).alias("residual_delta"),
        )
    )


def throughput_hourly(
    measurements: DataFrame, as_of: Moment, lookback: str = "7 days"
) -> DataFrame:
    return (
        moments.recent(measurements, "created_at", as_of, lookback)
        .groupBy(F.date_trunc("hour", "created_at").alias("hour"))
        .agg(
            F.count("*").alias("records_inserted"),
            (F.count("*") / F.lit(3600.0)).alias("records_per_second"),
        )
    )


def daily_volume(
    measurements: DataFrame,
    as_of: Moment,
    lookback: str = "30 days",
    approximate: bool = False,
) -> DataFrame:
    distinct = F.approx_count_distinct if approximate else F.countDistinct
    return (
        moments.recent(measurements, "created_at", as_of, lookback)
        .groupBy(F.to_date("created_at").alias("report_date"))
        .agg(
            F.count("*").alias("total_records"),
            distinct("sensor_id").alias("active_sensors"),
            F.avg("pm2_5").alias("avg_pm25"),
            F.max("pm2_5").alias("max_pm25"),
        )
    )


def volume_rows(measurements: DataFrame, as_of: Moment, lookback: str = "30 days", bits: int = 14) -> DataFrame:
    """One mergeable row per day of ``created_at``: counts, sums, extremes and a sketch of the sensors.

    Stored once per closed day, such rows answer ``volume_between`` over any days without a scan of the readings.
    """
    return (
        moments.recent(measurements, "created_at", as_of, lookback)
        .groupBy(F.to_date("created_at").alias("report_date"))
        .agg(
            F.count("*").alias("total_records"),
            F.count("pm2_5").alias("pm25_records"),
            F.sum("pm2_5").alias("pm25_sum"),
            F.max("pm2_5").alias("max_pm25"),
            F.hll_sketch_agg("sensor_id", bits).alias("sensors"),
        )
    )


def volume_between(days: DataFrame, first: str, last: str) -> DataFrame:
    """Exact totals and about the number of sensors active on any of the days, from rows of ``volume_rows``.

    The number of sensors has a relative standard error of about ``1.04 / sqrt(2 ** bits)``, 0.8 % for 14 bits.
    """
    return days.filter(F.col("report_date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))).agg(
        F.coalesce(F.sum("total_records"), F.lit(0)).alias("total_records"),
        (F.sum("pm25_sum") / F.nullif(F.sum("pm25_records"), F.lit(0))).alias("avg_pm25"),
        F.max("max_pm25").alias("max_pm25"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sensors")), F.lit(0)).alias("active_sensors"),
    )


def sensor_activity(
    sensors: DataFrame,
    measurements: DataFrame,
    as_of: Moment,
    lookback: str = "1 hour",
    active_within: str = "5 minutes",
) -> DataFrame:
    """Readings and reporting status per registered sensor, silent ones included."""
    recent = (
        moments.recent(measurements, "timestamp", as_of, lookback)
        .groupBy("sensor_id")
        .agg(F.count("*").alias("_n"), F.max("timestamp").alias("last_seen"))
    )
    state = (
        F.when(moments.since("last_seen", as_of, active_within), "active")
        .when(moments.since("last_seen", as_of, lookback), "delayed")
        .otherwise("offline")
    )
    return sensors.join(recent, "sensor_id", "left").select(
        "sensor_id",
        "city",
        "zone",
        "status",
        F.coalesce("_n", F.lit(0).cast("bigint")).alias("readings_last_hour"),
        "last_seen",
        state.alias("reporting_status"),
    )


def anomaly_rate_daily(
    measurements: DataFrame, anomalies: DataFrame, as_of: Moment, lookback: str = "30 days"
) -> DataFrame:
    def per_day(df: DataFrame, name: str) -> DataFrame:
        return (
            moments.recent(df, "timestamp", as_of, lookback)
            .groupBy(F.to_date("timestamp").alias("report_date"))
            .agg(F.count("*").alias(name))
        )

    days = left_join_counts(
        per_day(measurements, "total_measurements"),
        per_day(anomalies, "total_anomalies"),
        ("report_date",),
        "total_anomalies",
    )
    rate = percent_of(F.col("total_anomalies"), F.col("total_measurements"))
    return days.withColumn("anomaly_rate_pct", rate)


def lag_proxy(measurements: DataFrame, as_of: Moment) -> DataFrame:
    """Seconds between ``as_of`` and the newest reading, and rows ingested in the last minute."""
    return measurements.agg(
        moments.seconds_between(as_of, F.max("timestamp")).alias("estimated_lag_seconds"),
        F.max("timestamp").alias("latest_processed_ts"),
        F.count_if(moments.since("created_at", as_of, "1 minute")).alias("records_last_minute"),
    )


def city_daily_summary(
    summaries: DataFrame, sensors: DataFrame, as_of: Moment, days: int = 30
) -> DataFrame:
    recent = summaries.filter(F.col("summary_date") >= F.date_sub(moments.day_of(as_of), days))
    return (
        enrich_with_sensor(recent, sensors, ("city",))
        .groupBy("city", "summary_date")
        .agg(
            F.count("sensor_id").alias("reporting_sensors"),
            F.avg("pm2_5_avg").alias("city_avg_pm25"),
            F.max("pm2_5_max").alias("city_max_pm25"),
            F.sum("anomaly_count").alias("total_anomalies"),
            F.sum("record_count").alias("total_records"),
        )
    )


def anomaly_feed(
    anomalies: DataFrame, sensors: DataFrame, as_of: Moment, lookback: str = "48 hours"
) -> DataFrame:
    """Recent events with their place; 100 percent means exactly at the limit."""
    recent = moments.recent(anomalies, "timestamp", as_of, lookback)
    return enrich_with_sensor(recent, sensors).select(
        "sensor_id",
        "city",
        "zone",
        "timestamp",
        "anomaly_type",
        "severity",
        "pollutant",
        "value",
        "threshold",
        percent_of(F.col("value"), F.col("threshold")).alias("pct_over_threshold"),
    )


def cluster_means(
    profiles: DataFrame, cluster: str = "cluster", features=PROFILE_FEATURES
) -> DataFrame:
    return profiles.groupBy(cluster).agg(*(F.avg(f).alias(f) for f in features))


def table_stats(df: DataFrame, time: str = "timestamp") -> DataFrame:
    return df.agg(F.count("*").alias("row_count"), F.max(time).alias("latest"))


def with_zone_code(df: DataFrame) -> DataFrame:
    return df.withColumn("zone_enc", zone_code())
