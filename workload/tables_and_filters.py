"""Queries over sources, validation and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workload.projection import AS_OF, DAY, World, with_tables
from workload.registry import query
from zephyrine.functions.rules import critical_label
from zephyrine.operators import anomalies, backfill, features, filters, joins, quality, validate
from zephyrine.schemas import MEASURED, POLLUTANTS
from zephyrine.sources.registry_seed import SEED, load_sensor_registry, seed_sensors

_KEY = 'sensor_id, "timestamp"'
_POLL = ", ".join(POLLUTANTS)
_MEAS = ", ".join(MEASURED)
_SINCE = "\"timestamp\" >= timestamp '{as_of}' - interval {lookback}"


def since(lookback: str) -> str:
    return _SINCE.format(as_of=AS_OF, lookback=lookback)


# --- scans and sources -------------------------------------------------------------------


@query(
    with_tables("m", "s")
    + f'select {_KEY}, {_MEAS}, city, zone from m join s using (sensor_id) where {since("30 days")}'
)
def scan_measurements_window(w: World) -> DataFrame:
    return features.scan_measurements_window(w.measurements, w.sensors, AS_OF, 30)


@query(
    """select user_id as source, event_id as page,
       strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%SZ') as utc,
       case event_type when 'click' then 'pm25' when 'view' then 'pm10' when 'purchase' then 'no2'
       when 'signup' then 'o3' else 'noise' end as parameter,
       floor(value * 256) / 256::double as value from events"""
)
def scan_backfill_pages(w: World) -> DataFrame:
    rows = backfill.explode_pages(backfill.parse_pages(w.pages))
    return rows.select(
        "source", F.shiftright("seq", 32).alias("page"), "utc", "parameter", "value"
    )


_SEED_VALUES = ", ".join(
    f"('{i}', {lat}::double, {lon}::double, '{c}', '{z}')" for i, lat, lon, c, z in SEED
)


@query(
    with_tables("s")
    + f"""select sensor_id, lat, lon, city, zone, status from s union all
    select *, 'active' from (values {_SEED_VALUES}) as t(sensor_id, lat, lon, city, zone)
    where sensor_id not in (select sensor_id from s)"""
)
def load_sensor_registry_query(w: World) -> DataFrame:
    return load_sensor_registry(w.sensors, seed_sensors(w.spark))


@query(
    with_tables("long", "limits")
    + """select pollutant, warning, critical, max(value) as highest from limits
    join long using (pollutant) group by 1, 2, 3"""
)
def inline_values(w: World) -> DataFrame:
    cells = ", ".join(f"'{p}', {p}" for p in POLLUTANTS)
    highest = (
        w.measurements.agg(*(F.max(p).alias(p) for p in POLLUTANTS))
        .selectExpr(f"stack({len(POLLUTANTS)}, {cells}) as (pollutant, highest)")
    )
    return anomalies.threshold_table(w.spark).join(highest, "pollutant")


# --- validation --------------------------------------------------------------------------


@query(
    with_tables("m")
    + f"""select event_id, k in (1, 2) as malformed,
    case when k not in (1, 2, 3) then sensor_id end as sensor_id,
    case when k not in (1, 2) then "timestamp" end as "timestamp",
    {", ".join(f"case when k not in (1, 2, 5) then {c} end as {c}" for c in MEASURED)} from m"""
)
def parse_payload(w: World) -> DataFrame:
    parsed = validate.parse_payload(w.messages)
    fine = F.col(validate.CORRUPT).isNull()
    return parsed.select(
        "event_id",
        (~fine).alias("malformed"),
        F.when(fine, F.col("sensor_id")).alias("sensor_id"),
        F.when(fine, F.col("timestamp")).alias("timestamp"),
        *(F.when(fine, F.col(f"measurements.{c}")).alias(c) for c in MEASURED),
    )


@query(with_tables("m") + f"select event_id, {_KEY} from m where k not in (1, 2, 3, 4, 5)")
def validate_required(w: World) -> DataFrame:
    parsed = validate.parse_payload(w.messages).filter(F.col(validate.CORRUPT).isNull())
    return validate.validate_required(parsed).select("event_id", "sensor_id", "timestamp")


@query(
    with_tables("m")
    + f"select event_id, {_KEY}, battery_level from m where battery_level between 0 and 100"
)
def validate_battery(w: World) -> DataFrame:
    return validate.validate_battery(w.measurements).select(
        "event_id", "sensor_id", "timestamp", "battery_level"
    )


@query(with_tables("clean") + f"select event_id, {_KEY}, {_MEAS} from clean")
def sanitize_ranges(w: World) -> DataFrame:
    return validate.sanitize_ranges(w.measurements).select(
        "event_id", "sensor_id", "timestamp", *MEASURED
    )


@query(
    with_tables("reasons")
    + f"select event_id, {_KEY}, {_MEAS}, battery_level from reasons where reason is null"
)
def flatten_reading(w: World) -> DataFrame:
    valid, _ = validate.split_valid(validate.parse_payload(w.messages))
    return validate.flatten_reading(valid, keep=("event_id",))


@query(
    with_tables("m", "s")
    + """select event_id, coalesce(city, 'unknown') as city,
    coalesce(zone, 'urban_background') as zone, coalesce(status, 'active') as status
    from m left join s using (sensor_id)"""
)
def default_fields(w: World) -> DataFrame:
    side = w.sensors.select("sensor_id", "city", "zone", "status")
    joined = w.measurements.join(side, "sensor_id", "left")
    filled = validate.default_fields(
        joined, {"city": "unknown", "zone": "urban_background", "status": "active"}
    )
    return filled.select("event_id", "city", "zone", "status")


@query(
    with_tables("reasons")
    + "select reason, count(*) as n from reasons where reason is not null group by 1"
)
def quarantine_stream(w: World) -> DataFrame:
    _, rejected = validate.split_valid(validate.parse_payload(w.messages))
    return validate.quarantine(rejected).groupBy("reason").agg(F.count("raw_payload").alias("n"))


# --- filters and projections -------------------------------------------------------------


@query(with_tables("m") + f'select event_id, {_KEY} from m where {since("7 days")}')
def filter_since(w: World) -> DataFrame:
    return filters.filter_since(w.measurements, AS_OF, "7 days").select(
        "event_id", "sensor_id", "timestamp"
    )


@query(
    with_tables("m")
    + f"""select event_id, {_KEY} from m
    where "timestamp" between timestamp '2024-01-05' and timestamp '2024-01-20'"""
)
def filter_between(w: World) -> DataFrame:
    return filters.filter_between(w.measurements, "2024-01-05", "2024-01-20").select(
        "event_id", "sensor_id", "timestamp"
    )


@query(
    with_tables("m")
    + f"select event_id, {_KEY} from m where cast(\"timestamp\" as date) = date '{DAY}'"
)
def filter_on_date(w: World) -> DataFrame:
    return filters.filter_on_date(w.measurements, DAY).select("event_id", "sensor_id", "timestamp")


@query(
    with_tables("m")
    + f"select event_id, {_POLL} from m where "
    + " and ".join(f"{p} is not null" for p in POLLUTANTS)
)
def drop_null_rows(w: World) -> DataFrame:
    return features.drop_null_rows(w.measurements).select("event_id", *POLLUTANTS)


@query(
    with_tables("clean")
    + "select event_id, "
    + ", ".join(f"coalesce({c}, 0) as {c}" for c in MEASURED)
    + " from clean"
)
def fill_null_zero(w: World) -> DataFrame:
    clean = validate.sanitize_ranges(w.measurements)
    return features.fill_null_zero(clean, MEASURED).select("event_id", *MEASURED)


@query(with_tables("m") + "select event_id, pm2_5, no2, humidity from m")
def select_available(w: World) -> DataFrame:
    wanted = ("pm2_5", "no2", "visibility", "humidity", "pressure")
    return features.select_available(w.measurements, wanted, keep=("event_id",))


@query(with_tables("qm") + "select cast(pipeline_date as varchar) as pipeline_date, row_count from qm where table_name = 'measurements'")
def optional_filter(w: World) -> DataFrame:
    wanted = {"table_name": "measurements", "schema_drift": None}
    return quality.optional_filter(w.quality_metrics, wanted).select("pipeline_date", "row_count")


@query(
    with_tables("m", "s")
    + f'select event_id, {_MEAS}, battery_level from m join s using (sensor_id)'
)
def drop_label_columns(w: World) -> DataFrame:
    rows = joins.enrich_with_sensor(w.measurements, w.sensors)
    return features.drop_label_columns(rows).drop("event_type", "created_at")


@query(with_tables("pairs") + "select event_id as page, parameter, value from pairs")
def rename_pollutant_codes(w: World) -> DataFrame:
    long = backfill.explode_pages(backfill.parse_pages(w.pages))
    return backfill.rename_pollutant_codes(long).select(
        F.shiftright("seq", 32).alias("page"), "parameter", "value"
    )


# --- joins -------------------------------------------------------------------------------


@query(with_tables("m", "s") + f"select event_id, {_KEY}, city, zone from m join s using (sensor_id)")
def enrich_with_sensor(w: World) -> DataFrame:
    facts = w.measurements.select("event_id", "sensor_id", "timestamp")
    return joins.enrich_with_sensor(facts, w.sensors)


@query(
    with_tables("m", "s")
    + f"""select s.sensor_id, city, event_id, "timestamp" from s left join m
    on s.sensor_id = m.sensor_id and {since("1 hour")}"""
)
def left_join_recent(w: World) -> DataFrame:
    sensors = w.sensors.select("sensor_id", "city")
    facts = w.measurements.select("event_id", "sensor_id", "timestamp")
    return joins.left_join_recent(sensors, facts, AS_OF)


@query(
    with_tables("m", "ds")
    + """select event_id, cast(cast("timestamp" as date) as varchar) as day, pm2_5, pm2_5_max,
    record_count from m left join (select * from ds where record_count > 2) d
    on m.sensor_id = d.sensor_id and cast("timestamp" as date) = summary_date"""
)
def left_join_by_day(w: World) -> DataFrame:
    busy = w.daily_summaries.filter("record_count > 2")
    return joins.left_join_by_day(w.measurements, busy).select(
        "event_id", "day", "pm2_5", "pm2_5_max", "record_count"
    )


@query(
    with_tables("m", "a")
    + """select cast(d as varchar) as report_date, n, coalesce(c, 0) as critical from
    (select cast("timestamp" as date) as d, count(*) as n from m group by 1) x left join
    (select cast("timestamp" as date) as d, count(*) as c from a where severity = 'critical'
     and pollutant = 'pm10' group by 1) y using (d)"""
)
def left_join_aggregates(w: World) -> DataFrame:
    day = F.to_date("timestamp").alias("report_date")
    one = F.lit(1)
    base = w.measurements.groupBy(day).agg(F.count(one).alias("n"))
    events = w.anomalies.filter("severity = 'critical' and pollutant = 'pm10'")
    counted = events.groupBy(day).agg(F.count(one).alias("critical"))
    return joins.left_join_counts(base, counted, ("report_date",), "critical")


_BUCKET = (
    "case when pm2_5 < 0 then 0 when pm2_5 >= 150 then 11 else floor(pm2_5 / 15) + 1 end"
)


@query(
    with_tables("m")
    + f"""select cast(coalesce(h.b, r.b) as bigint) as bucket, coalesce(h.n, 0) as before,
    coalesce(r.n, 0) as after from
    (select {_BUCKET} as b, count(*) as n from m where event_type = 'click' and pm2_5 is not null
     group by 1) h full join
    (select {_BUCKET} as b, count(*) as n from m where event_type <> 'click' and pm2_5 is not null
     group by 1) r on h.b = r.b"""
)
def full_outer_histograms(w: World) -> DataFrame:
    from zephyrine.operators.summaries import histogram

    args = ("pm2_5", 0.0, 150.0, 10)
    left = histogram(w.measurements.filter("event_type = 'click'"), *args, "before")
    right = histogram(w.measurements.filter("event_type <> 'click'"), *args, "after")
    return joins.full_outer_histograms(left, right)


@query(
    with_tables("m", "a")
    + """select sensor_id, n, (select count(*) from a where a.sensor_id = x.sensor_id) as events
    from (select sensor_id, count(*) as n from m group by 1) x"""
)
def count_per_key_subquery(w: World) -> DataFrame:
    base = w.measurements.groupBy("sensor_id").agg(F.count("*").alias("n"))
    return joins.count_per_key(base, w.anomalies, ("sensor_id",), "events")


@query(
    with_tables("m", "s")
    + """select event_id, sensor_id, sensor_id in (select sensor_id from s) as known from m"""
)
def split_known_sensors(w: World) -> DataFrame:
    facts = w.measurements.select("event_id", "sensor_id")
    known, unknown = joins.split_known_sensors(facts, w.sensors)
    return known.withColumn("known", F.lit(True)).unionByName(
        unknown.withColumn("known", F.lit(False))
    )


@query(
    with_tables("m", "s")
    + """select distinct sensor_id, 0::double as lat, 0::double as lon, 'OpenAQ' as city,
    'unknown' as zone from m where sensor_id not in (select sensor_id from s)"""
)
def insert_missing_sensors(w: World) -> DataFrame:
    return joins.insert_missing_sensors(w.measurements, w.sensors)


@query(
    with_tables("clean")
    + """select event_id, cast(coalesce(pm2_5 > 75, false) or coalesce(pm10 > 150, false)
    or coalesce(no2 > 200, false) or coalesce(o3 > 180, false) or coalesce(co > 10, false)
    or coalesce(so2 > 350, false) as int) as label from clean"""
)
def generate_labels(w: World) -> DataFrame:
    clean = validate.sanitize_ranges(w.measurements)
    return clean.select("event_id", critical_label().alias("label"))
