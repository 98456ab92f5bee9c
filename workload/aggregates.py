"""Queries over aggregates, windows, gates, views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workload.projection import AS_OF, DAY, LAST_RUN, World, with_tables
from workload.registry import query, rounded
from workload.tables_and_filters import since
from zephyrine.operators import (
    anomalies,
    backfill,
    features,
    filters,
    metrics,
    quality,
    registry,
    rolling,
    summaries,
    upsert,
    validate,
)
from zephyrine.plans import views
from zephyrine.schemas import POLLUTANTS, ROLLING_WIDTHS
from zephyrine.session import scratch_path

_DATE = 'cast(cast("timestamp" as date) as varchar)'


def _bucket(column: str = "pm2_5") -> str:
    return (
        f"case when {column} < 0 then 0 when {column} >= 150 then 11 "
        f"else cast(floor({column} / 15) as bigint) + 1 end"
    )


# --- gates and profiles ------------------------------------------------------------------


@query(
    with_tables("m")
    + f"""select count(*) as new_records, count(*) >= 500 as passed from m
    where created_at > timestamp '{LAST_RUN}'"""
)
def count_new_records(w: World) -> DataFrame:
    return quality.count_new_records(w.measurements, LAST_RUN, 500)


@query(
    with_tables("m")
    + f"select count(*) as record_count from m where cast(\"timestamp\" as date) = date '{DAY}'"
)
def count_for_day(w: World) -> DataFrame:
    return quality.count_for_day(w.measurements, DAY)


@query(
    with_tables("m")
    + f"""select {_DATE} as pipeline_date, count(*) as total,
    count(*) filter (where pm2_5 is null) as null_pm25,
    count(*) filter (where pm2_5 < 0 or pm10 < 0) as negative_values,
    count(*) filter (where pm2_5 is null) / count(*) as null_rate,
    count(*) filter (where pm2_5 is null) / count(*) <= 0.3 as passed from m group by 1"""
)
def quality_gate(w: World) -> DataFrame:
    return quality.quality_gate_by_day(w.measurements, 0.3)


def _profile(name: str, table: str, fresh: str, nulls: str = "0::double") -> str:
    return f"""select '{name}' as table_name, '{AS_OF[:10]}' as pipeline_date,
    count(*) as row_count, {nulls} as null_rate,
    cast(trunc((epoch_us(timestamp '{AS_OF}') - epoch_us(max({fresh}))) / 60e6) as int)
    as freshness_minutes, false as schema_drift from {table}"""


@query(
    with_tables("m", "a", "hb")
    + " union all ".join(
        [
            _profile(
                "measurements",
                "m",
                "created_at",
                "count(*) filter (where pm2_5 is null) / count(*)",
            ),
            _profile("anomalies", "a", "created_at"),
            _profile("etl_heartbeat", "hb", "last_batch_ts"),
        ]
    )
)
def profile_tables(w: World) -> DataFrame:
    tables = {
        "measurements": w.measurements,
        "anomalies": w.anomalies,
        "etl_heartbeat": w.etl_heartbeat,
    }
    return quality.profile_tables(tables, AS_OF, digits=None)


@query(
    with_tables("hb")
    + """select cast(pipeline_date as varchar) as pipeline_date, last_batch_ts,
    records_processed, status from hb"""
)
def heartbeat(w: World) -> DataFrame:
    return quality.heartbeat(w.heartbeat_deltas).drop("updated_at")


@query(
    with_tables("hb")
    + f"""select max((epoch_us(timestamp '2024-01-30 23:59:59') - epoch_us(last_batch_ts)) / 60e6)
    as age_minutes,
    coalesce(max((epoch_us(timestamp '2024-01-30 23:59:59') - epoch_us(last_batch_ts)) / 60e6) <= 15,
    false) as passed from hb where pipeline_date = date '2024-01-30'"""
)
def freshness_gate(w: World) -> DataFrame:
    return quality.freshness_gate(w.etl_heartbeat, "2024-01-30 23:59:59", 15)


# --- summaries ---------------------------------------------------------------------------


@query(
    with_tables("ds")
    + """select sensor_id, cast(summary_date as varchar) as summary_date, pm2_5_avg, pm2_5_max,
    pm10_avg, no2_avg, o3_avg, co_avg, so2_avg, anomaly_count, record_count from ds"""
)
def daily_summary(w: World) -> DataFrame:
    return w.daily_summaries


_PROFILE_SQL = f"""select sensor_id, coalesce(avg(pm2_5), 0) as pm2_5_avg,
    coalesce(max(pm2_5), 0) as pm2_5_max, coalesce(avg(pm10), 0) as pm10_avg,
    coalesce(avg(no2), 0) as no2_avg, coalesce(avg(o3), 0) as o3_avg,
    coalesce(avg(co), 0) as co_avg, coalesce(avg(so2), 0) as so2_avg,
    coalesce(round(stddev_samp(pm2_5), 6), 0) as pm2_5_std, count(*) as record_count
    from m where {since("90 days")} group by 1"""


@query(with_tables("m") + _PROFILE_SQL)
def sensor_profile(w: World) -> DataFrame:
    return rounded(summaries.sensor_profile(w.measurements, AS_OF), 6, "pm2_5_std")


@query(
    with_tables("m", "s")
    + f"""select zone, {", ".join(f"round(avg({f}), 6) as {f}" for f in summaries.PROFILE_FEATURES)}
    from ({_PROFILE_SQL}) p join s using (sensor_id) group by 1"""
)
def cluster_means(w: World) -> DataFrame:
    profiles = summaries.sensor_profile(w.measurements, AS_OF)
    zoned = profiles.join(w.sensors.select("sensor_id", "zone"), "sensor_id")
    means = summaries.cluster_means(zoned, "zone")
    return rounded(means, 6, *summaries.PROFILE_FEATURES)


@query(
    with_tables("m")
    + 'select count(*) as row_count, max("timestamp") as latest from m'
)
def table_stats(w: World) -> DataFrame:
    return summaries.table_stats(w.measurements)


# --- the views ---------------------------------------------------------------------------


def _tables(w: World, *names: str) -> views.Tables:
    return views.Tables(**{n: getattr(w, n) for n in names})


_AVGS = ", ".join(f"avg({p}) as avg_{p}" for p in POLLUTANTS)
_FIVE = "time_bucket(interval 5 minutes, \"timestamp\")"


@query(
    with_tables("m")
    + f"""select {_FIVE} as bucket, {_AVGS}, count(*) as record_count from m
    where {since("24 hours")} group by 1"""
)
def pollutant_timeseries(w: World) -> DataFrame:
    return views.pollutant_timeseries_24h(_tables(w, "measurements"), AS_OF)


@query(
    with_tables("m")
    + f"""select sensor_id, {_FIVE} as bucket, avg(pm2_5) as avg_pm2_5, avg(no2) as avg_no2,
    avg(o3) as avg_o3 from m where {since("24 hours")} group by 1, 2"""
)
def sensor_timeseries(w: World) -> DataFrame:
    return views.sensor_pollutant_24h(_tables(w, "measurements"), AS_OF)


@query(
    with_tables("a", "s")
    + f"""select city, severity, count(*) as anomaly_count from a join s using (sensor_id)
    where {since("24 hours")} group by 1, 2"""
)
def anomaly_by_city(w: World) -> DataFrame:
    return views.anomaly_by_city_24h(_tables(w, "anomalies", "sensors"), AS_OF)


@query(
    with_tables("m", "s")
    + f"""select zone, date_trunc('hour', "timestamp") as hour, avg(pm2_5) as avg_pm2_5,
    avg(no2) as avg_no2, count(*) as readings from m join s using (sensor_id)
    where {since("7 days")} group by 1, 2"""
)
def zone_hourly_avg(w: World) -> DataFrame:
    return views.zone_hourly_avg(_tables(w, "measurements", "sensors"), AS_OF)


@query(
    with_tables("a")
    + f"""select {_DATE} as report_date, count(*) as total_anomalies,
    count(*) filter (where severity = 'critical') as critical_count,
    count(*) filter (where severity = 'warning') as warning_count,
    count(*) filter (where anomaly_type = 'rule_based') as rule_based_count,
    count(*) filter (where anomaly_type = 'ml_based') as ml_based_count
    from a where {since("30 days")} group by 1"""
)
def anomaly_detection_daily(w: World) -> DataFrame:
    return views.anomaly_detection_daily(_tables(w, "anomalies"), AS_OF)


_SHARES = "(recent_count / sum(recent_count) over ())", "(hist_count / sum(hist_count) over ())"


@query(
    with_tables("m")
    + f""", h as (select {_bucket()} as bucket, count(*) as hist_count from m where pm2_5 is not null
      and "timestamp" between timestamp '2024-01-01' and timestamp '2024-01-16' group by 1),
    r as (select {_bucket()} as bucket, count(*) as recent_count from m where pm2_5 is not null
      and "timestamp" >= timestamp '2024-01-16' group by 1),
    c as (select coalesce(h.bucket, r.bucket) as bucket, coalesce(hist_count, 0) as hist_count,
      coalesce(recent_count, 0) as recent_count from h full join r on h.bucket = r.bucket),
    q as (select *, {_SHARES[0]} as rs, {_SHARES[1]} as hs from c)
    select bucket, hist_count, recent_count, case when hist_count > 0 and recent_count > 0
    then round((rs - hs) * ln(rs / hs), 9) else 0 end as psi_contribution from q"""
)
def feature_drift(w: World) -> DataFrame:
    drift = summaries.feature_drift(w.measurements, AS_OF, recent="15 days", history="30 days")
    return rounded(drift, 9, "psi_contribution")


@query(
    with_tables("m", "ds")
    + f"""select {_DATE} as report_date, avg(pm2_5) as actual_avg_pm25,
    round(avg(pm2_5_avg), 6) as summary_avg_pm25,
    round(avg(pm2_5) - avg(pm2_5_avg), 6) as residual_delta
    from m left join (select sensor_id, summary_date, pm2_5_avg from ds) d
    on m.sensor_id = d.sensor_id and cast("timestamp" as date) = summary_date
    where {since("30 days")} group by 1"""
)
def residuals_daily(w: World) -> DataFrame:
    daily = views.pm25_residuals_daily(_tables(w, "measurements", "daily_summaries"), AS_OF)
    return rounded(daily, 6, "summary_avg_pm25", "residual_delta")


@query(
    with_tables("m")
    + f"""select date_trunc('hour', created_at) as hour, count(*) as records_inserted,
    count(*) / 3600::double as records_per_second from m
    where created_at >= timestamp '{AS_OF}' - interval 7 days group by 1"""
)
def throughput_hourly(w: World) -> DataFrame:
    return views.etl_throughput_hourly(_tables(w, "measurements"), AS_OF)


@query(
    with_tables("m")
    + f"""select cast(cast(created_at as date) as varchar) as report_date,
    count(*) as total_records, count(distinct sensor_id) as active_sensors,
    avg(pm2_5) as avg_pm25, max(pm2_5) as max_pm25 from m
    where created_at >= timestamp '{AS_OF}' - interval 30 days group by 1"""
)
def daily_volume(w: World) -> DataFrame:
    return views.daily_volume(_tables(w, "measurements"), AS_OF)


@query(
    with_tables("m")
    + f"""select count(*) as total_records, round(avg(pm2_5), 6) as avg_pm25, max(pm2_5) as max_pm25,
    count(distinct sensor_id) as active_sensors from m
    where created_at >= timestamp '{AS_OF}' - interval 30 days
    and cast(created_at as date) between date '2024-01-05' and date '2024-01-25'"""
)
def volume_between(w: World) -> DataFrame:
    """Three weeks from stored rows per day; on these few sensors the sketch counts without error."""
    path = scratch_path(w.spark, "volume")
    summaries.volume_rows(w.measurements, AS_OF).write.parquet(path)
    merged = summaries.volume_between(w.spark.read.parquet(path), "2024-01-05", "2024-01-25")
    return rounded(merged, 6, "avg_pm25")


@query(
    with_tables("m", "s")
    + f"""select s.sensor_id, city, zone, status, count(event_id) as readings_last_hour,
    max("timestamp") as last_seen, case
      when max("timestamp") >= timestamp '{AS_OF}' - interval 5 minutes then 'active'
      when max("timestamp") >= timestamp '{AS_OF}' - interval 1 hour then 'delayed'
      else 'offline' end as reporting_status
    from s left join m on s.sensor_id = m.sensor_id and {since("1 hour")} group by 1, 2, 3, 4"""
)
def sensor_activity(w: World) -> DataFrame:
    return views.sensor_activity(_tables(w, "measurements", "sensors"), AS_OF)


@query(
    with_tables("m", "a")
    + f"""select cast(report_date as varchar) as report_date, total_measurements,
    coalesce(n, 0) as total_anomalies,
    coalesce(n, 0)::double / nullif(total_measurements, 0) * 100 as anomaly_rate_pct
    from (select cast("timestamp" as date) as report_date, count(*) as total_measurements from m
          where {since("30 days")} group by 1) x
    left join (select cast("timestamp" as date) as report_date, count(*) as n from a
          where {since("30 days")} group by 1) y using (report_date)"""
)
def anomaly_rate_daily(w: World) -> DataFrame:
    return views.anomaly_rate_daily(_tables(w, "measurements", "anomalies"), AS_OF)


@query(
    with_tables("m")
    + f"""select (epoch_us(timestamp '{AS_OF}') - epoch_us(max("timestamp"))) / 1e6
    as estimated_lag_seconds, max("timestamp") as latest_processed_ts,
    count(*) filter (where created_at >= timestamp '{AS_OF}' - interval 1 minute)
    as records_last_minute from m"""
)
def lag_proxy(w: World) -> DataFrame:
    return views.consumer_lag_proxy(_tables(w, "measurements"), AS_OF)


@query(
    with_tables("ds", "s")
    + f"""select city, cast(summary_date as varchar) as summary_date,
    count(ds.sensor_id) as reporting_sensors, round(avg(pm2_5_avg), 6) as city_avg_pm25,
    max(pm2_5_max) as city_max_pm25, cast(sum(anomaly_count) as bigint) as total_anomalies,
    cast(sum(record_count) as bigint) as total_records from ds join s using (sensor_id)
    where summary_date >= date '{AS_OF[:10]}' - 30 group by city, summary_date"""
)
def city_daily_summary(w: World) -> DataFrame:
    daily = views.city_daily_summary(_tables(w, "daily_summaries", "sensors"), AS_OF)
    return rounded(daily, 6, "city_avg_pm25")


@query(
    with_tables("a", "s")
    + f"""select sensor_id, city, zone, "timestamp", anomaly_type, severity, pollutant, value,
    threshold, value / nullif(threshold, 0) * 100 as pct_over_threshold
    from a join s using (sensor_id) where {since("48 hours")}"""
)
def anomaly_feed(w: World) -> DataFrame:
    return views.anomaly_feed(_tables(w, "anomalies", "sensors"), AS_OF)


@query(
    with_tables("hb")
    + f"""select cast(pipeline_date as varchar) as pipeline_date, last_batch_ts,
    records_processed, status,
    (epoch_us(timestamp '{AS_OF}') - epoch_us(last_batch_ts)) / 60e6 as minutes_since_last_batch
    from hb order by pipeline_date desc limit 30"""
)
def etl_health(w: World) -> DataFrame:
    return views.etl_health(_tables(w, "etl_heartbeat"), AS_OF)


@query(
    with_tables("qm")
    + f"""select table_name, cast(pipeline_date as varchar) as pipeline_date, row_count, null_rate,
    freshness_minutes, schema_drift from qm where pipeline_date >= date '{AS_OF[:10]}' - 14"""
)
def model_stage_quality(w: World) -> DataFrame:
    return views.model_stage_quality(_tables(w, "quality_metrics"), AS_OF)


@query(
    with_tables("qm")
    + f"""select table_name, cast(pipeline_date as varchar) as pipeline_date, row_count,
    null_rate * 100 as null_rate_pct, freshness_minutes, schema_drift,
    lag(row_count) over w as prev_row_count,
    row_count - lag(row_count) over w as row_count_delta
    from qm where pipeline_date >= date '{AS_OF[:10]}' - 30
    window w as (partition by table_name order by pipeline_date)"""
)
def quality_trend(w: World) -> DataFrame:
    return views.data_quality_trend(_tables(w, "quality_metrics"), AS_OF, digits=None)


_LEVELS = """case when pm2_5 > 75 then 5 when pm2_5 > 55 then 4 when pm2_5 > 35 then 3
    when pm2_5 > 12 then 2 else 1 end as aqi_level"""
_STATUS = """case when pm2_5 > 75 or pm10 > 150 or no2 > 200 then 'critical'
    when pm2_5 > 25 or pm10 > 50 or no2 > 100 then 'warning' else 'good' end as aqi_status"""


@query(
    with_tables("m", "s")
    + f"""select sensor_id, lat, lon, city, zone, "timestamp", pm2_5, pm10, {_STATUS}, {_LEVELS}
    from (select *, row_number() over (partition by sensor_id order by "timestamp" desc) as r
          from m) x join s using (sensor_id) where r = 1"""
)
def latest_per_sensor(w: World) -> DataFrame:
    newest = views.sensor_latest(_tables(w, "measurements", "sensors"), AS_OF)
    return newest.select(
        "sensor_id", "lat", "lon", "city", "zone", "timestamp", "pm2_5", "pm10",
        "aqi_status", "aqi_level",
    )


@query(
    with_tables("m")
    + f"""select {_bucket()} as bucket, count(*) as n,
    count(*) / sum(count(*)) over () as share from m where pm2_5 is not null group by 1"""
)
def share_of_total(w: World) -> DataFrame:
    counts = summaries.histogram(w.measurements, "pm2_5", 0.0, 150.0, 10, "n")
    return rolling.share_of_total(counts, {"n": "share"})


# --- sorts and limits --------------------------------------------------------------------


@query(
    with_tables("m")
    + 'select event_id, sensor_id, pm2_5 from m order by "timestamp" desc limit 10'
)
def top_n_recent(w: World) -> DataFrame:
    return quality.top_n_recent(w.measurements, "timestamp", 10).select(
        "event_id", "sensor_id", "pm2_5"
    )


@query(
    with_tables("m")
    + f"select event_id, {_DATE} as report_date, pm10 from m where {since('24 hours')}"
)
def order_output(w: World) -> DataFrame:
    recent = filters.filter_since(w.measurements, AS_OF, "24 hours")
    return views.order_output(recent, "-timestamp").select(
        "event_id", F.to_date("timestamp").alias("report_date"), "pm10"
    )


# --- pivot and upserts -------------------------------------------------------------------

_PIVOT = ", ".join(
    f"arg_max(value, event_id) filter (where parameter = '{p}') as {p}" for p in POLLUTANTS
)


@query(with_tables("pairs") + f'select sensor_id, "timestamp", {_PIVOT} from pairs group by 1, 2')
def pivot_readings(w: World) -> DataFrame:
    long = backfill.rename_pollutant_codes(backfill.explode_pages(backfill.parse_pages(w.pages)))
    keyed = long.select(
        F.concat(
            F.lit("CAP_"),
            F.expr("lpad(string(source + 1), greatest(3, length(string(source + 1))), '0')"),
        ).alias("sensor_id"),
        F.to_timestamp("utc").alias("timestamp"),
        "parameter",
        "value",
        "seq",
    )
    return backfill.pivot_readings(keyed)


@query(
    f"""with p as (select 'OAQ_' || user_id as sensor_id, date_trunc('hour', ts) as "timestamp",
    event_id, case event_type when 'click' then 'pm2_5' when 'view' then 'pm10'
    when 'purchase' then 'no2' when 'signup' then 'o3' end as parameter,
    floor(value * 256) / 256::double as value from events)
    select sensor_id, "timestamp", {_PIVOT} from p group by 1, 2"""
)
def backfill_day(w: World) -> DataFrame:
    return backfill.backfill_day(backfill.parse_pages(w.pages))


@query(
    with_tables("m")
    + """select sensor_id, "timestamp", case when event_type = 'click' then -1::double
    else pm2_5 end as pm2_5 from m"""
)
def insert_ignore(w: World) -> DataFrame:
    """Clicks are there already; inserting everything must leave them alone."""
    columns = ["sensor_id", "timestamp", "pm2_5"]
    there = w.measurements.filter("event_type = 'click'").withColumn("pm2_5", F.lit(-1.0))
    return upsert.insert_ignore(
        there.select(*columns), w.measurements.select(*columns), ("sensor_id", "timestamp")
    )


@query(
    with_tables("ds")
    + """select sensor_id, cast(summary_date as varchar) as summary_date, case when
    summary_date >= date '2024-01-15' then record_count else -1 end as record_count from ds"""
)
def upsert_replace(w: World) -> DataFrame:
    """All days are there with a stale count; the second half of the month is replaced."""
    columns = ["sensor_id", "summary_date", "record_count"]
    fresh = w.daily_summaries.select(*columns)
    stale = fresh.withColumn("record_count", F.lit(-1).cast("bigint"))
    late = fresh.filter("summary_date >= date '2024-01-15'")
    return upsert.upsert_replace(stale, late, ("sensor_id", "summary_date"))


@query(
    with_tables("hd")
    + """select cast(pipeline_date as varchar) as pipeline_date,
    cast(sum(records_processed) as bigint) as records_processed,
    max(last_batch_ts) as last_batch_ts from hd group by 1"""
)
def upsert_add(w: World) -> DataFrame:
    there = w.heartbeat_deltas.filter("event_type in ('click', 'view')")
    deltas = w.heartbeat_deltas.filter("event_type not in ('click', 'view')")
    return upsert.upsert_add(
        there, deltas, ("pipeline_date",), ("records_processed",), ("last_batch_ts",)
    )


# --- stream operators on tables ----------------------------------------------------------

_ANOMALY_COLUMNS = (
    'sensor_id, "timestamp", anomaly_type, severity, pollutant, value, threshold'
)
DEDUP_SQL = with_tables("m") + 'select sensor_id, "timestamp", pm2_5, event_id from m'
ANOMALY_SQL = with_tables("a") + f"select {_ANOMALY_COLUMNS} from a"


def _guarded(c: str) -> str:
    return (
        f"case when count(*) filter (where {c} <> 0) > 1 "
        f"then round(stddev_samp({c}), 6) else 0 end as {c}_std"
    )


ROLLING_SQL = (
    with_tables("m")
    + f"""select sensor_id, date_trunc('day', "timestamp") as window_start,
    date_trunc('day', "timestamp") + interval 1 day as window_end, '1day' as window_type,
    avg(pm2_5) as pm2_5_mean, {_guarded("pm2_5")}, min(pm2_5) as pm2_5_min,
    max(pm2_5) as pm2_5_max, avg(pm10) as pm10_mean, {_guarded("pm10")}, avg(no2) as no2_mean,
    {_guarded("no2")}, avg(o3) as o3_mean, avg(co) as co_mean, avg(so2) as so2_mean,
    count(*) as record_count from m group by 1, 2, 3"""
)


@query(DEDUP_SQL)
def dedup_stream(w: World) -> DataFrame:
    """Batch twin: copies that arrive later are dropped."""
    return validate.first_writer_wins(w.readings_twice, ("sensor_id", "timestamp")).select(
        "sensor_id", "timestamp", "pm2_5", "event_id"
    )


@query(ANOMALY_SQL)
def detect_threshold_anomalies(w: World) -> DataFrame:
    return anomalies.detect_threshold_anomalies(w.measurements)


@query(ROLLING_SQL)
def rolling_stats(w: World) -> DataFrame:
    stats = rolling.rolling_stats(w.measurements, "1day", "1 day")
    return rounded(stats, 6, "pm2_5_std", "pm10_std", "no2_std")


# --- row windows -------------------------------------------------------------------------


def _rolling_sql(source: str, key: str) -> str:
    cells = []
    for p in POLLUTANTS:
        for n in ROLLING_WIDTHS:
            over = (
                f'over (partition by sensor_id order by "timestamp" '
                f"rows between {n - 1} preceding and current row)"
            )
            cells.append(f"avg({p}) {over} as {p}_mean_{n}")
            cells.append(f"coalesce(round(stddev_samp({p}) {over}, 6), 0) as {p}_std_{n}")
    return f"select {key}, {', '.join(cells)} from {source}"


_MOVED = [f"{p}_{s}_{n}" for p in POLLUTANTS for n in ROLLING_WIDTHS for s in ("mean", "std")]
_DEVIATIONS = [c for c in _MOVED if "_std_" in c]


@query(with_tables("m") + _rolling_sql("m", "event_id"))
def rolling_features(w: World) -> DataFrame:
    made = rolling.rolling_features(w.measurements)
    return rounded(made, 6, *_DEVIATIONS).select("event_id", *_MOVED)


_DELTAS = ", ".join(
    f'coalesce({p} - lag({p}) over (partition by sensor_id order by "timestamp"), 0) as {p}_delta'
    for p in POLLUTANTS
)


@query(with_tables("m") + f"select event_id, {_DELTAS} from m")
def delta_features(w: World) -> DataFrame:
    made = rolling.delta_features(w.measurements)
    return made.select("event_id", *(f"{p}_delta" for p in POLLUTANTS))


@query(
    with_tables("m")
    + """select * from (select event_id,
    lead(pm2_5, 3) over (partition by sensor_id order by "timestamp") as target from m)
    where target is not null"""
)
def forecast_target(w: World) -> DataFrame:
    return rolling.forecast_target(w.measurements, "pm2_5", 3).select("event_id", "target")


_CALENDAR = """hour("timestamp") as hour, isodow("timestamp") - 1 as day_of_week,
    case when isodow("timestamp") >= 6 then 1 else 0 end as is_weekend,
    month("timestamp") as month"""
_ZONE_CODE = """case zone when 'traffic' then 1 when 'industrial' then 2
    when 'residential' then 3 else 0 end as zone_enc"""
_COMPLETE = " and ".join(f"{p} is not null" for p in POLLUTANTS)


def _o(n: int) -> str:
    return f'over (partition by sensor_id order by "timestamp" rows between {n - 1} preceding and current row)'


_SLICED = [f"""avg({p}) {_o(n)} as {p}_mean_{n}, coalesce(round(stddev_samp({p}) {_o(n)}, 6), 0) as {p}_std_{n}"""
           for p in ("pm2_5", "no2") for n in (2, 3)]


@query(with_tables("m") + f"select event_id, {', '.join(_SLICED)} from m")
def rolling_features_sliced(w: World) -> DataFrame:
    """Short frames over slices of ten days, most of whose rows are settled inside their slice."""
    made = rolling.rolling_features(w.measurements, ("pm2_5", "no2"), (2, 3), slice_width="10 days")
    names = [f"{p}_{s}_{n}" for p in ("pm2_5", "no2") for s in ("mean", "std") for n in (2, 3)]
    return rounded(made.select("event_id", *names), 6, *(c for c in names if "_std_" in c))


@query(
    with_tables("m")
    + """select * from (select event_id, lead(pm2_5, 2) over (partition by sensor_id order by "timestamp") as target
    from m) where target is not null"""
)
def forecast_target_sliced(w: World) -> DataFrame:
    made = rolling.forecast_target(w.measurements, "pm2_5", 2, slice_width="10 days")
    return made.select("event_id", "target")


@query(
    with_tables("m", "s")
    + f""", x as (select m.*, city, zone from m join s using (sensor_id) where {since("30 days")}),
    f as ({_rolling_sql("x", "*")}),
    d as (select event_id as id, {_DELTAS}, {_CALENDAR}, {_ZONE_CODE} from x)
    select sensor_id, "timestamp", {", ".join(POLLUTANTS)}, zone, {", ".join(_MOVED)},
    {", ".join(f"{p}_delta" for p in POLLUTANTS)}, hour, day_of_week, is_weekend, month, zone_enc
    from f join d on event_id = id where {_COMPLETE}"""
)
def build_feature_matrix(w: World) -> DataFrame:
    matrix = features.build_feature_matrix(w.measurements, w.sensors, AS_OF, 30)
    return rounded(matrix, 6, *_DEVIATIONS).drop("city", "temperature", "humidity")


@query(
    with_tables("m")
    + f"select event_id, {_CALENDAR} from m"
)
def calendar_features(w: World) -> DataFrame:
    return features.calendar_features(w.measurements).select(
        "event_id", "hour", "day_of_week", "is_weekend", "month"
    )


# --- registry and metrics ----------------------------------------------------------------


@query(
    with_tables("runs")
    + """select registry_name, run_id, f1 from (select *, row_number() over (
    partition by registry_name order by f1 desc, run_order) as r from runs) where r = 1"""
)
def best_run(w: World) -> DataFrame:
    best = registry.best_run(w.model_runs, "f1")
    return best.select("registry_name", "run_id", registry.metric_of("f1").alias("f1"))


@query(
    with_tables("runs")
    + """select registry_name, version, stage, run_id from (select *, row_number() over (
    partition by registry_name, stage order by version desc) as r from runs
    where stage in ('Staging', 'Production')) where r = 1"""
)
def model_registry(w: World) -> DataFrame:
    return registry.model_registry(w.model_runs).select(
        "registry_name", "version", "stage", "run_id"
    )


_STAGED = """, newest as (select * from (select *, row_number() over (
      partition by registry_name, stage order by version desc) as r from runs) where r = 1),
    c as (select n.registry_name, st.version as staging_version, st.f1 as staging_metric,
      pr.version as production_version, pr.f1 as production_metric
      from (select distinct registry_name from runs) n
      left join (select * from newest where stage = 'Staging') st using (registry_name)
      left join (select * from newest where stage = 'Production') pr using (registry_name)),
    v as (select *, case when staging_metric is null then 'none'
      when production_metric is null then 'promoted_first'
      when staging_metric > production_metric then 'promoted_challenger'
      else 'retained_champion' end as action from c)"""


@query(
    with_tables("runs")
    + _STAGED
    + """ select registry_name, staging_version, staging_metric, production_version,
    production_metric, action, case when action = 'promoted_challenger'
    then staging_metric - production_metric end as improvement from v"""
)
def compare_stages(w: World) -> DataFrame:
    return registry.compare_stages(w.model_runs, "f1")


@query(
    with_tables("runs")
    + _STAGED
    + """ select run_id, case
    when stage = 'Staging' and version = staging_version
      and action in ('promoted_first', 'promoted_challenger') then 'Production'
    when stage = 'Staging' and version = staging_version and action = 'retained_champion'
      then 'Archived'
    when stage = 'Production' and version = production_version
      and action = 'promoted_challenger' then 'Archived' else stage end as stage
    from runs join v using (registry_name)"""
)
def promote(w: World) -> DataFrame:
    decisions = registry.compare_stages(w.model_runs, "f1")
    return registry.promote(w.model_runs, decisions).select("run_id", "stage")


def _judged(w: World) -> DataFrame:
    """The live status as a prediction of the training label."""
    clean = validate.sanitize_ranges(w.measurements)
    labelled = features.generate_labels(clean)
    from zephyrine.functions.rules import status

    return labelled.withColumn("prediction", (status() == "critical").cast("int"))


_JUDGED = """, j as (select cast(coalesce(pm2_5 > 75, false) or coalesce(pm10 > 150, false)
    or coalesce(no2 > 200, false) or coalesce(o3 > 180, false) or coalesce(co > 10, false)
    or coalesce(so2 > 350, false) as int) as label, cast(coalesce(pm2_5 > 75, false)
    or coalesce(pm10 > 150, false) or coalesce(no2 > 200, false) as int) as prediction from clean)"""


@query(
    with_tables("clean")
    + _JUDGED
    + " select label, prediction, count(*) as n from j group by 1, 2"
)
def confusion_counts(w: World) -> DataFrame:
    return metrics.confusion_counts(_judged(w))


@query(
    with_tables("clean")
    + _JUDGED
    + """ select avg(cast(label = prediction as int)) as accuracy,
    2 * count(*) filter (where label = 1 and prediction = 1) / (
      2 * count(*) filter (where label = 1 and prediction = 1)
      + count(*) filter (where label <> prediction)) as f1, count(*) as test_size,
    avg(label) as anomaly_rate, avg(prediction) as predicted_rate from j"""
)
def classification_metrics(w: World) -> DataFrame:
    return metrics.classification_metrics(_judged(w))


def _persistence(w: World) -> DataFrame:
    """Forecast by repeating the value before."""
    ahead = rolling.forecast_target(w.measurements.filter("pm2_5 is not null"), "pm2_5", 1)
    return ahead.withColumn("prediction", F.col("pm2_5"))


_PERSIST = """, p as (select * from (select event_id, pm2_5 as prediction,
    lead(pm2_5) over (partition by sensor_id order by "timestamp") as target from m
    where pm2_5 is not null) where target is not null)"""


@query(
    with_tables("m")
    + _PERSIST
    + """ select round(sqrt(avg((target - prediction) ** 2)), 6) as rmse,
    round(avg(abs(target - prediction)), 6) as mae,
    round(1 - sum((target - prediction) ** 2) / (var_pop(target) * count(*)), 6) as r2,
    count(*) as test_size from p"""
)
def regression_metrics(w: World) -> DataFrame:
    return rounded(metrics.regression_metrics(_persistence(w)), 6, "rmse", "mae", "r2")


@query(
    with_tables("m")
    + _PERSIST
    + " select event_id, target, prediction, target - prediction as residual from p"
)
def residual_table(w: World) -> DataFrame:
    return metrics.with_residual(_persistence(w)).select(
        "event_id", "target", "prediction", "residual"
    )


@query(
    with_tables("clean")
    + _JUDGED.replace(" from clean)", ", event_id, sensor_id, epoch_us(\"timestamp\") as us from clean)")
    + """ select event_id, label, row_number() over (partition by label
      order by md5(sensor_id || '|' || us)) <= ceil(0.2 * count(*) over (partition by label))
      as is_test from j"""
)
def split_train_test(w: World) -> DataFrame:
    labelled = features.generate_labels(validate.sanitize_ranges(w.measurements))
    key = ("sensor_id", F.unix_micros("timestamp"))
    split = features.split_train_test(labelled, key, 0.2, stratify="label")
    return split.select("event_id", "label", "is_test")


@query(
    with_tables("clean")
    + "select event_id, "
    + ", ".join(
        f"round((coalesce({p}, 0) - avg(coalesce({p}, 0)) over ()) "
        f"/ stddev_pop(coalesce({p}, 0)) over (), 6) as {p}"
        for p in POLLUTANTS
    )
    + " from clean"
)
def scale_features(w: World) -> DataFrame:
    clean = validate.sanitize_ranges(w.measurements)
    scaled = features.scale_features(clean, POLLUTANTS).select("event_id", *POLLUTANTS)
    return rounded(scaled, 6, *POLLUTANTS)


@query(
    with_tables("qm")
    + f"""select table_name, cast(pipeline_date as varchar) as pipeline_date, row_count, null_rate,
    freshness_minutes, schema_drift from qm where pipeline_date >= date '{AS_OF[:10]}' - 7
    and table_name = 'measurements'"""
)
def recent_quality(w: World) -> DataFrame:
    return quality.recent_quality(w.quality_metrics, AS_OF, 7, "measurements")
