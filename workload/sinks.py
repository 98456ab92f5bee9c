"""The table writers: write to fresh tables, twice where a replay must change nothing, read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workload.aggregates import ANOMALY_SQL, ROLLING_SQL
from workload.projection import World, with_tables
from workload.registry import query, rounded
from zephyrine.operators import rolling
from zephyrine.session import scratch_path
from zephyrine.sources.tables import TableStore
from zephyrine.streaming.ingest import ingest_batch


def _store(w: World) -> TableStore:
    return TableStore(w.spark, scratch_path(w.spark, "tables"))


@query(with_tables("m") + 'select sensor_id, "timestamp", pm2_5, battery_level from m')
def write_measurements(w: World) -> DataFrame:
    store = _store(w)
    for _ in range(2):
        store.insert_ignore("measurements", w.readings_twice, arrival=("created_at",))
    return store.read("measurements").select("sensor_id", "timestamp", "pm2_5", "battery_level")


@query(ANOMALY_SQL)
def write_anomalies(w: World) -> DataFrame:
    store = _store(w)
    for _ in range(2):
        store.insert_ignore("anomalies", w.anomalies, arrival=("created_at",))
    return store.read("anomalies").select(
        "sensor_id", "timestamp", "anomaly_type", "severity", "pollutant", "value", "threshold"
    )


@query(ROLLING_SQL)
def write_aggregates(w: World) -> DataFrame:
    store = _store(w)
    for _ in range(2):
        store.insert_ignore("aggregates", rolling.rolling_stats(w.measurements, "1day", "1 day"))
    return rounded(store.read("aggregates").drop("date", "created_at"), 6, "pm2_5_std", "pm10_std", "no2_std")


@query(
    with_tables("ds")
    + """select sensor_id, cast(summary_date as varchar) as summary_date, pm2_5_avg,
    anomaly_count, record_count from ds"""
)
def write_daily_summaries(w: World) -> DataFrame:
    """A stale version is written first and replaced."""
    store = _store(w)
    stale = w.daily_summaries.withColumn("record_count", F.lit(-1))
    store.upsert_replace("daily_summaries", stale)
    store.upsert_replace("daily_summaries", w.daily_summaries)
    return store.read("daily_summaries").select(
        "sensor_id", "summary_date", "pm2_5_avg", "anomaly_count", "record_count"
    )


def _ingested(w: World) -> TableStore:
    store = _store(w)
    for _ in range(2):
        ingest_batch(w.messages, 0, store, w.sensors)
    return store


@query(
    with_tables("reasons")
    + """select sensor_id, "timestamp" from reasons where reason is null"""
)
def archive_raw(w: World) -> DataFrame:
    return _ingested(w).read("raw_archive").select("sensor_id", "timestamp")


_VALID = """, v as (select * from reasons where reason is null),
    e as (select * from long join limits using (pollutant) join v using (sensor_id, "timestamp")
          where value >= warning)"""


@query(
    with_tables("reasons", "long", "limits", "s")
    + _VALID
    + """ select 'measurements' as table_name, count(*) as n from v
      where sensor_id in (select sensor_id from s)
    union all select 'anomalies', count(*) from e
    union all select 'raw_archive', count(*) from v
    union all select 'heartbeat', count(*) from v
    union all select 'quarantine', count(*) from reasons
      where reason is not null or sensor_id not in (select sensor_id from s)"""
)
def ingest_fanout(w: World) -> DataFrame:
    """Row counts of every sink after the same batch was processed twice."""
    store = _ingested(w)
    counted = None
    for name, table, rows in (
        ("measurements", "measurements", F.count("*")),
        ("anomalies", "anomalies", F.count("*")),
        ("raw_archive", "raw_archive", F.count("*")),
        ("heartbeat", "heartbeat_deltas", F.sum("records_processed")),
        ("quarantine", "quarantine", F.count("*")),
    ):
        one = store.read(table).agg(rows.alias("n")).select(F.lit(name).alias("table_name"), "n")
        counted = one if counted is None else counted.unionByName(one)
    return counted
