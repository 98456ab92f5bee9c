"""The library's tables, projected from the driver's test tables.

``PROJECTION`` holds the Spark side, ``CTES`` the same tables as DuckDB SQL.  Both read whole
tables.  Measured values are multiples of powers of two, so sums and averages are exact in
double arithmetic and do not depend on the order of addition.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zephyrine.operators.anomalies import detect_threshold_anomalies
from zephyrine.operators.quality import heartbeat, quality_gate_by_day
from zephyrine.operators.summaries import daily_summary
from zephyrine.session import configure

AS_OF = "2024-01-31 00:00:00"
DAY = "2024-01-17"
LAST_RUN = "2024-01-20 06:00:00"

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
CUSTOMER = T.StructType(
    [
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType()),
    ]
)
NATION = T.StructType(
    [
        T.StructField("n_nationkey", T.IntegerType()),
        T.StructField("n_name", T.StringType()),
        T.StructField("n_regionkey", T.IntegerType()),
    ]
)
PART = T.StructType(
    [
        T.StructField("p_partkey", T.LongType()),
        T.StructField("p_name", T.StringType()),
        T.StructField("p_brand", T.StringType()),
        T.StructField("p_type", T.StringType()),
        T.StructField("p_size", T.IntegerType()),
        T.StructField("p_retailprice", T.DoubleType()),
    ]
)
DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)

_ID = "concat('CAP_', lpad(cast({n} + 1 as string), greatest(3, length(cast({n} + 1 as string))), '0'))"
_ZONE = """case c_mktsegment when 'HOUSEHOLD' then 'residential' when 'MACHINERY' then 'industrial'
           when 'AUTOMOBILE' then 'traffic' when 'BUILDING' then 'urban_background'
           else 'unknown' end"""


class World:
    """Tables of one scale factor, built lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = configure(spark), sf_dir.rstrip("/")

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self._read("events", EVENTS)

    def project(self, events: DataFrame) -> DataFrame:
        """Events -> measurements (batch or stream), out-of-range values included."""
        k = F.get_json_object("props", "$.k").cast("int")
        v = F.floor(F.col("value") * 256) / F.lit(256.0)
        # ``explode`` keeps the optimizer from looking up the JSON field anew in every column.
        return events.withColumn("k", F.explode(F.array(k))).withColumn("v", v).selectExpr(
            "event_id",
            "event_type",
            _ID.format(n="user_id") + " as sensor_id",
            "ts as timestamp",
            "case when event_type = 'error' and k % 2 = 0 then null else v end as pm2_5",
            "case when k = 7 then -v else v * 1.5D end as pm10",
            "k * 3D as no2",
            "k * 2D as o3",
            "v / 32D as co",
            "v * 0.875D as so2",
            "k - 30D as temperature",
            "k * 1.125D as humidity",
            "k + 5 as battery_level",
            "ts + make_dt_interval(0, 0, 0, event_id % 120) as created_at",
        )

    @cached_property
    def measurements(self) -> DataFrame:
        return self.project(self.events)

    @cached_property
    def event_stream(self) -> DataFrame:
        return self.project(
            self.spark.readStream.schema(EVENTS)
            .option("pathGlobFilter", "events.parquet")
            .parquet(self.dir)
        )

    @cached_property
    def sensors(self) -> DataFrame:
        """Customers in good standing; the others' readings come from unknown sensors."""
        nation = self._read("nation", NATION)
        return (
            self._read("customer", CUSTOMER)
            .filter("c_acctbal >= 0")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .selectExpr(
                _ID.format(n="c_custkey") + " as sensor_id",
                "cast(n_nationkey as double) as lat",
                "cast(n_regionkey as double) as lon",
                "n_name as city",
                _ZONE + " as zone",
                "'active' as status",
            )
        )

    @cached_property
    def anomalies(self) -> DataFrame:
        kept = ("sensor_id", "timestamp", "created_at")
        return detect_threshold_anomalies(self.measurements, keep=kept)

    @cached_property
    def daily_summaries(self) -> DataFrame:
        return daily_summary(self.measurements, self.anomalies)

    @cached_property
    def heartbeat_deltas(self) -> DataFrame:
        """One row per event type and day, as if each type had been a batch."""
        return self.measurements.groupBy(
            "event_type", F.to_date("created_at").alias("pipeline_date")
        ).agg(
            F.max("created_at").alias("last_batch_ts"),
            F.count("*").alias("records_processed"),
            F.lit("running").alias("status"),
        )

    @cached_property
    def etl_heartbeat(self) -> DataFrame:
        return heartbeat(self.heartbeat_deltas)

    @cached_property
    def quality_metrics(self) -> DataFrame:
        """Of all readings, and of those with a charged battery as a second table."""

        def daily(name: str, readings: DataFrame) -> DataFrame:
            return quality_gate_by_day(readings).select(
                F.lit(name).alias("table_name"),
                "pipeline_date",
                F.col("total").alias("row_count"),
                "null_rate",
                F.lit(0).alias("freshness_minutes"),
                F.lit(False).alias("schema_drift"),
            )

        charged = self.measurements.filter("battery_level > 50")
        return daily("measurements", self.measurements).unionByName(daily("charged", charged))

    @cached_property
    def model_runs(self) -> DataFrame:
        """Runs derived from the parts: a brand is a registry name, a part is a version."""
        return self._read("part", PART).selectExpr(
            "concat('run', p_partkey) as run_id",
            "p_brand as registry_name",
            "p_type as model_name",
            "p_partkey as run_order",
            "map('f1', floor(p_retailprice) / 2048D) as metrics",
            "p_partkey as version",
            "case p_size % 4 when 0 then 'None' when 1 then 'Staging' when 2 then 'Production' "
            "else 'Archived' end as stage",
        )

    @cached_property
    def messages(self) -> DataFrame:
        """Raw JSON texts: some cut short, some without a place, some wrongly typed."""
        place = "named_struct('lat', 1D, 'lon', 2D, 'city', 'x', 'zone', 'traffic')"
        body = f"""named_struct(
            'sensor_id', if(k = 3, null, sensor_id),
            'timestamp', date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
            'location', if(k = 4, null, {place}),
            'measurements', if(k = 5, null, named_struct('pm2_5', pm2_5, 'pm10', pm10, 'no2', no2,
                'o3', o3, 'co', co, 'so2', so2, 'temperature', temperature, 'humidity', humidity)),
            'battery_level', battery_level)"""
        value = """case when k = 1 then left(text, 40)
                        when k = 2 then replace(text, '"battery_level":', '"battery_level":"x","b":')
                        else text end as value"""
        return (
            self.measurements.withColumn("k", F.col("battery_level") - 5)
            .selectExpr("event_id", "created_at", "k", f"explode(array(to_json({body}))) as text")
            .selectExpr("event_id", value, "created_at")
        )

    @cached_property
    def readings_twice(self) -> DataFrame:
        """All readings plus later copies of the purchases."""
        copies = self.measurements.filter("event_type = 'purchase'").withColumn(
            "created_at", F.col("created_at") + F.expr("INTERVAL 1 hour")
        )
        return self.measurements.unionByName(copies.withColumn("pm2_5", F.lit(-1.0)))

    @cached_property
    def pages(self) -> DataFrame:
        """Backfill pages as JSON text, one per event, in event order per hour."""
        code = """case event_type when 'click' then 'pm25' when 'view' then 'pm10'
                  when 'purchase' then 'no2' when 'signup' then 'o3' else 'noise' end"""
        item = f"""named_struct('date', named_struct('utc',
                       date_format(date_trunc('hour', ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
                   'parameter', {code}, 'value', floor(value * 256) / 256D)"""
        return self.events.selectExpr(
            "user_id as source",
            "event_id as page",
            f"to_json(named_struct('results', array({item}))) as value",
        )

    @cached_property
    def documents(self) -> DataFrame:
        return self._read("documents", DOCUMENTS)


# --- the same tables in DuckDB SQL ------------------------------------------------------

_DUCK_ID = "'CAP_' || case when {n} < 999 then lpad(cast({n} + 1 as varchar), 3, '0') else cast({n} + 1 as varchar) end"

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "m": (
        (),
        f"""select event_id, event_type, {_DUCK_ID.format(n='user_id')} as sensor_id,
            ts as "timestamp",
            case when event_type = 'error' and k % 2 = 0 then null else v end as pm2_5,
            case when k = 7 then -v else v * 1.5::double end as pm10,
            k * 3::double as no2, k * 2::double as o3, v / 32::double as co,
            v * 0.875::double as so2, k - 30::double as temperature,
            k * 1.125::double as humidity, k + 5 as battery_level, k,
            ts + to_seconds(event_id % 120) as created_at
            from (select *, cast(json_extract_string(props, '$.k') as int) as k,
                  floor(value * 256) / 256::double as v from events) e""",
    ),
    "s": (
        (),
        f"""select {_DUCK_ID.format(n='c_custkey')} as sensor_id, n_nationkey::double as lat,
            n_regionkey::double as lon, n_name as city, {_ZONE} as zone, 'active' as status
            from customer join nation on c_nationkey = n_nationkey where c_acctbal >= 0""",
    ),
    "limits": (
        (),
        """select * from (values ('pm2_5', 25::double, 75::double), ('pm10', 50::double, 150::double),
            ('no2', 100::double, 200::double), ('o3', 120::double, 180::double),
            ('co', 4::double, 10::double), ('so2', 125::double, 350::double))
            as t(pollutant, warning, critical)""",
    ),
    "long": (
        ("m",),
        " union all ".join(
            f"""select sensor_id, "timestamp", created_at, '{p}' as pollutant, {p} as value from m"""
            for p in ("pm2_5", "pm10", "no2", "o3", "co", "so2")
        ),
    ),
    "a": (
        ("long", "limits"),
        """select sensor_id, "timestamp", created_at, 'rule_based' as anomaly_type,
            case when value >= critical then 'critical' else 'warning' end as severity,
            pollutant, value, case when value >= critical then critical else warning end as threshold
            from long join limits using (pollutant) where value >= warning""",
    ),
    "ds": (
        ("m", "a"),
        """select x.*, coalesce(y.n, 0) as anomaly_count from (
              select sensor_id, cast("timestamp" as date) as summary_date,
                avg(pm2_5) as pm2_5_avg, avg(pm10) as pm10_avg, avg(no2) as no2_avg,
                avg(o3) as o3_avg, avg(co) as co_avg, avg(so2) as so2_avg,
                max(pm2_5) as pm2_5_max, count(*) as record_count
              from m group by 1, 2) x
            left join (select sensor_id, cast("timestamp" as date) as summary_date, count(*) as n
                       from a group by 1, 2) y using (sensor_id, summary_date)""",
    ),
    "hd": (
        ("m",),
        """select event_type, cast(created_at as date) as pipeline_date,
            max(created_at) as last_batch_ts, count(*) as records_processed, 'running' as status
            from m group by 1, 2""",
    ),
    "hb": (
        ("hd",),
        """select pipeline_date, max(last_batch_ts) as last_batch_ts,
            cast(sum(records_processed) as bigint) as records_processed, 'running' as status
            from hd group by 1""",
    ),
    "qm": (
        ("m",),
        """select 'measurements' as table_name, cast("timestamp" as date) as pipeline_date,
            count(*) as row_count, count(*) filter (where pm2_5 is null) / count(*) as null_rate,
            0 as freshness_minutes, false as schema_drift from m group by 2
            union all select 'charged', cast("timestamp" as date), count(*),
            count(*) filter (where pm2_5 is null) / count(*), 0, false
            from m where battery_level > 50 group by 2""",
    ),
    "runs": (
        (),
        """select 'run' || p_partkey as run_id, p_brand as registry_name, p_type as model_name,
            p_partkey as run_order, floor(p_retailprice) / 2048::double as f1,
            p_partkey as version, case p_size % 4 when 0 then 'None' when 1 then 'Staging'
            when 2 then 'Production' else 'Archived' end as stage from part""",
    ),
    "clean": (
        ("m",),
        """select event_id, event_type, sensor_id, "timestamp", created_at, battery_level, k,
            case when pm2_5 >= 0 then pm2_5 end as pm2_5, case when pm10 >= 0 then pm10 end as pm10,
            case when no2 >= 0 then no2 end as no2, case when o3 >= 0 then o3 end as o3,
            case when co >= 0 then co end as co, case when so2 >= 0 then so2 end as so2,
            case when temperature between -50 and 60 then temperature end as temperature,
            case when humidity between 0 and 100 then humidity end as humidity from m""",
    ),
    "reasons": (
        ("m",),
        """select *, case when k in (1, 2) then 'malformed_json'
            when k = 3 then 'missing_sensor_id' when k = 4 then 'missing_location'
            when k = 5 then 'missing_measurements'
            when battery_level not between 0 and 100 then 'battery_out_of_range' end as reason
            from m""",
    ),
    "pairs": (
        (),
        f"""select {_DUCK_ID.format(n='user_id')} as sensor_id, date_trunc('hour', ts) as "timestamp",
            event_id, case event_type when 'click' then 'pm2_5' when 'view' then 'pm10'
            when 'purchase' then 'no2' when 'signup' then 'o3' end as parameter,
            floor(value * 256) / 256::double as value from events""",
    ),
}


def with_tables(*names: str) -> str:
    """``WITH`` clause defining the named tables and what they need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in CTES[name][0]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    return "with " + ",\n".join(f"{n} as ({CTES[n][1]})" for n in ordered) + "\n"
