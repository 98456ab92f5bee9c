"""Fixed schemas and domain constants.  Nothing in the library infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed domain values -----------------------------------------------------------

POLLUTANTS = ("pm2_5", "pm10", "no2", "o3", "co", "so2")

# pollutant -> (warning, critical)
THRESHOLDS = {
    "pm2_5": (25.0, 75.0),
    "pm10": (50.0, 150.0),
    "no2": (100.0, 200.0),
    "o3": (120.0, 180.0),
    "co": (4.0, 10.0),
    "so2": (125.0, 350.0),
}

ZONE_CODES = {"urban_background": 0, "traffic": 1, "industrial": 2, "residential": 3}

# accepted range of each measured quantity, both ends included; None = open
VALUE_RANGES = {
    **{p: (0.0, None) for p in POLLUTANTS},
    "temperature": (-50.0, 60.0),
    "humidity": (0.0, 100.0),
}
BATTERY_RANGE = (0, 100)

ROLLING_WIDTHS = (5, 15, 60)
WINDOW_TYPES = {"1min": "1 minute", "5min": "5 minutes"}

# name used by the external source -> column
PARAMETER_COLUMNS = {
    "pm25": "pm2_5",
    "pm10": "pm10",
    "no2": "no2",
    "o3": "o3",
    "co": "co",
    "so2": "so2",
}

MEASURED = (*POLLUTANTS, "temperature", "humidity")

# --- schemas -----------------------------------------------------------------------


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields])


_S, _D, _I, _L = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()
_TS, _DT, _B = T.TimestampType(), T.DateType(), T.BooleanType()

LOCATION = _struct(("lat", _D), ("lon", _D), ("city", _S), ("zone", _S))
MEASUREMENT_VALUES = _struct(*((c, _D) for c in MEASURED))

READING = _struct(
    ("sensor_id", _S),
    ("timestamp", _TS),
    ("location", LOCATION),
    ("measurements", MEASUREMENT_VALUES),
    ("battery_level", _I),
    ("status", _S),
)

SENSORS = _struct(
    ("sensor_id", _S, False),
    ("lat", _D),
    ("lon", _D),
    ("city", _S),
    ("zone", _S),
    ("status", _S),
    ("created_at", _TS),
)

MEASUREMENTS = _struct(
    ("sensor_id", _S, False),
    ("timestamp", _TS, False),
    *((c, _D) for c in MEASURED),
    ("battery_level", _I),
    ("created_at", _TS),
)
MEASUREMENT_KEY = ("sensor_id", "timestamp")

AGGREGATES = _struct(
    ("sensor_id", _S),
    ("window_start", _TS),
    ("window_end", _TS),
    ("window_type", _S),
    ("pm2_5_mean", _D),
    ("pm2_5_std", _D),
    ("pm2_5_min", _D),
    ("pm2_5_max", _D),
    ("pm10_mean", _D),
    ("pm10_std", _D),
    ("no2_mean", _D),
    ("no2_std", _D),
    ("o3_mean", _D),
    ("co_mean", _D),
    ("so2_mean", _D),
    ("record_count", _L),
    ("created_at", _TS),
)
AGGREGATE_KEY = ("sensor_id", "window_start", "window_type")

ANOMALIES = _struct(
    ("sensor_id", _S),
    ("timestamp", _TS),
    ("anomaly_type", _S),
    ("severity", _S),
    ("pollutant", _S),
    ("value", _D),
    ("threshold", _D),
    ("ml_probability", _D),
    ("raw_payload", _S),
    ("created_at", _TS),
)
ANOMALY_KEY = ("sensor_id", "timestamp", "pollutant", "anomaly_type")

HEARTBEAT_DELTAS = _struct(
    ("pipeline_date", _DT),
    ("last_batch_ts", _TS),
    ("records_processed", _L),
    ("status", _S),
    ("batch_id", _L),
)

DAILY_SUMMARIES = _struct(
    ("sensor_id", _S),
    ("summary_date", _DT),
    ("pm2_5_avg", _D),
    ("pm2_5_max", _D),
    ("pm10_avg", _D),
    ("no2_avg", _D),
    ("o3_avg", _D),
    ("co_avg", _D),
    ("so2_avg", _D),
    ("anomaly_count", _L),
    ("record_count", _L),
    ("created_at", _TS),
)
SUMMARY_KEY = ("sensor_id", "summary_date")

QUALITY_METRICS = _struct(
    ("table_name", _S),
    ("pipeline_date", _DT),
    ("row_count", _L),
    ("null_rate", _D),
    ("freshness_minutes", _I),
    ("schema_drift", _B),
)

DATA_SOURCES = _struct(("name", _S), ("source_type", _S), ("description", _S))
CATALOG_TABLES = _struct(
    ("source_name", _S), ("table_name", _S), ("schema_name", _S), ("description", _S)
)
CATALOG_COLUMNS = _struct(
    ("table_name", _S), ("column_name", _S), ("data_type", _S), ("is_nullable", _B)
)
LINEAGE_EDGES = _struct(
    ("edge_order", _L), ("source_name", _S), ("target_name", _S), ("transformation", _S)
)

BACKFILL_PAGE = _struct(
    (
        "results",
        T.ArrayType(
            _struct(
                ("date", _struct(("utc", _S))),
                ("parameter", _S),
                ("value", _D),
            )
        ),
    ),
)

MODEL_RUNS = _struct(
    ("run_id", _S),
    ("registry_name", _S),
    ("model_name", _S),
    ("target", _S),
    ("run_order", _L),
    ("params", T.MapType(_S, _S)),
    ("metrics", T.MapType(_S, _D)),
    ("version", _L),
    ("stage", _S),
    ("model_path", _S),
    ("created_at", _TS),
)
