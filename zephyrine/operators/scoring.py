"""Scoring of readings with the stored models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zephyrine.operators.features import calendar_features
from zephyrine.operators.isolation import IsolationForest
from zephyrine.operators.models import transform
from zephyrine.operators.summaries import with_zone_code
from zephyrine.operators.validate import default_fields
from zephyrine.schemas import POLLUTANTS

# fixed values: defaults of a scoring request
REQUEST_DEFAULTS = {"city": "unknown", "zone": "urban_background"}
VALUE_DEFAULTS = {**{p: 0.0 for p in POLLUTANTS}, "temperature": 20.0, "humidity": 50.0}


def request_features(
    requests: DataFrame, as_of: str | None = None, strict: bool = False
) -> DataFrame:
    """Model features for readings that come without history.

    Means equal the single value, deviations and deltas are 0.  Only nulls take the defaults;
    ``strict`` also replaces zeros, the way an ``x or default`` test does.
    """
    now = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    rows = default_fields(requests, {**REQUEST_DEFAULTS, "timestamp": now})

    def value(name: str, default: float) -> Column:
        given = F.col(name)
        absent = given.isNull() | ((given == 0) if strict else F.lit(False))
        return F.when(absent, F.lit(default)).otherwise(given)

    rows = rows.withColumns({c: value(c, d) for c, d in VALUE_DEFAULTS.items()})
    zero = F.lit(0.0)
    rows = rows.withColumns(
        {
            "pm2_5_mean_5": F.col("pm2_5"),
            "pm2_5_std_5": zero,
            "pm2_5_delta": zero,
            "pm2_5_mean_15": F.col("pm2_5"),
            "pm2_5_std_15": zero,
            "pm10_mean_5": F.col("pm10"),
            "no2_mean_5": F.col("no2"),
        }
    )
    return with_zone_code(calendar_features(rows))


def score_batch(
    features: DataFrame,
    classifier: PipelineModel | IsolationForest | None = None,
    forecasters: dict[str, PipelineModel] | None = None,
    model_name: str = "none",
    model_version: str = "none",
) -> DataFrame:
    """Probability, flag and one forecast per target; null where no model is given."""
    forecasters = forecasters or {}
    rows = features
    probability: Column = F.lit(None).cast("double")
    if isinstance(classifier, IsolationForest):
        rows = rows.withColumn("anomaly_probability", classifier.score())
        # The forest's own threshold decides; its score is not calibrated around one half.
        rows = rows.withColumn(
            "is_anomaly", F.col("anomaly_probability") > F.lit(classifier.threshold)
        )
    elif classifier is not None:
        scored = classifier.transform(rows)
        probability = vector_to_array("probability")[1]
        rows = scored.withColumn("anomaly_probability", probability)
        rows = rows.select(*features.columns, "anomaly_probability")
        rows = rows.withColumn("is_anomaly", F.col("anomaly_probability") > 0.5)
    else:
        rows = rows.withColumn("anomaly_probability", probability)
        rows = rows.withColumn("is_anomaly", F.lit(None).cast("boolean"))
    for target in ("pm2_5", "no2"):
        name = f"{target}_forecast"
        if target in forecasters:
            rows = transform(forecasters[target], rows).withColumnRenamed("prediction", name)
        else:
            rows = rows.withColumn(name, F.lit(None).cast("double"))
    return rows.select(
        "sensor_id",
        "timestamp",
        "anomaly_probability",
        "is_anomaly",
        "pm2_5_forecast",
        "no2_forecast",
        F.lit(model_name).alias("model_name"),
        F.lit(model_version).alias("model_version"),
    )
