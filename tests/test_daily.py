import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from workload.projection import World
from zephyrine.operators import models as fits
from zephyrine.operators.anomalies import detect_threshold_anomalies
from zephyrine.operators.features import build_feature_matrix
from zephyrine.operators.validate import sanitize_ranges
from zephyrine.plans import training
from zephyrine.plans.daily import QualityGateFailed, run_daily, validate_day
from zephyrine.plans.views import VIEWS, Tables, register_views
from zephyrine.sources.declared import CatalogStore, declared_lineage
from zephyrine.sources.model_store import ModelStore
from zephyrine.sources.tables import TableStore

DAY, AS_OF = "2024-01-30", "2024-01-30 23:59:59"


@pytest.fixture(scope="module")
def world(spark):
    return World(spark, "/root/testdata/sf0.001")


@pytest.fixture
def store(world, spark, folder):
    made = TableStore(spark, f"{folder}/tables")
    clean = sanitize_ranges(world.measurements)
    made.insert_ignore("measurements", clean, arrival=("created_at",))
    events = detect_threshold_anomalies(clean, keep=("sensor_id", "timestamp", "created_at"))
    made.insert_ignore("anomalies", events, arrival=("created_at",))
    beats = world.heartbeat_deltas.withColumn("batch_id", F.lit(0).cast("long"))
    made.replace_partitions("heartbeat_deltas", beats.filter("event_type = 'view'"))
    return made


def test_the_daily_job(world, store, spark, folder):
    models = ModelStore(spark, f"{folder}/models")
    waiting = run_daily(spark, store, models, world.sensors, DAY, AS_OF, "2024-01-30")
    assert "new_data" in waiting.waiting_for and not waiting.training

    done = run_daily(
        spark, store, models, world.sensors, DAY, AS_OF, check_gates=False
    )
    assert done.record_count > 0 and done.deployed
    assert all(done.training["forecasting"][t][1] for t in ("pm2_5", "no2"))
    assert store.read("daily_summaries").select("summary_date").distinct().count() == 1
    assert store.read("quality_metrics").filter("table_name = 'measurements'").count() == 1
    production = models.runs().filter("stage = 'Production'")
    assert rows(production, "registry_name") == [
        ("anomaly-classifier",),
        ("pollution-forecaster-no2",),
        ("pollution-forecaster-pm2_5",),
        ("sensor-clustering",),
    ]
    matrix = build_feature_matrix(world.measurements, world.sensors, AS_OF, 30)
    scored = training.score_with_store(matrix, models)
    assert scored.filter("pm2_5_forecast is null or no2_forecast is null").count() == 0
    # One forecast model per target: the two forecasts differ.
    assert scored.filter("pm2_5_forecast <> no2_forecast").count() > 0
    assert scored.filter("anomaly_probability not between 0 and 1").count() == 0
    catalog = CatalogStore(spark, f"{store.root}/catalog")
    assert catalog.read("lineage_edges").count() == declared_lineage(spark).count()
    ages = {r["table_name"]: r["freshness_minutes"] for r in store.read("quality_metrics").collect()}
    assert ages["daily_summaries"] is not None


def test_the_gate_writes_its_row_before_it_fails(spark, folder):
    store = TableStore(spark, folder)
    at = dt.datetime(2024, 1, 5, 1)
    data = [("s", at + dt.timedelta(seconds=i), None if i < 31 else 1.0, at) for i in range(100)]
    schema = "sensor_id string, timestamp timestamp, pm2_5 double, created_at timestamp"
    store.insert_ignore("measurements", spark.createDataFrame(data, schema))
    with pytest.raises(QualityGateFailed):
        validate_day(store, "2024-01-05")
    assert rows(store.read("quality_metrics"), "row_count", "null_rate") == [(100, 0.31)]
    assert validate_day(store, "2024-01-06")["total"] == 0


def test_training_needs_enough_rows(world, spark, folder):
    models = ModelStore(spark, folder)
    matrix = build_feature_matrix(world.measurements, world.sensors, AS_OF, 30).limit(100)
    assert training.train_best_classifier(matrix, models) == (None, False)
    assert training.train_best_forecasters(matrix, models)["no2"] == (None, False)
    few = world.measurements.filter(F.col("sensor_id").isin("CAP_001", "CAP_002"))
    assert training.train_best_clustering(few, AS_OF, models) == (None, False)


def test_forecast_targets_are_fitted_side_by_side(world, spark, folder, monkeypatch):
    met, fit = threading.Barrier(2, timeout=120), fits.train_ridge
    monkeypatch.setattr(fits, "train_ridge", lambda *a, **b: met.wait() >= 0 and fit(*a, **b))
    models = ModelStore(spark, folder)
    matrix = build_feature_matrix(world.measurements, world.sensors, AS_OF, 30)
    found = training.train_best_forecasters(matrix, models, rounds=1)
    names = [training.forecaster_name(t) for t in ("pm2_5", "no2")]
    logged = rows(models.runs(), "run_order", "registry_name", "model_name", "version")
    assert logged == [
        (1, names[0], "Ridge", 1), (2, names[0], "BoostedTrees", 2), (3, names[1], "Ridge", 1), (4, names[1], "BoostedTrees", 2),
    ]
    assert [better for _, better in found.values()] == [True, True] and list(found) == ["pm2_5", "no2"]


def test_all_views_are_available_to_sql(world, spark):
    tables = Tables(
        measurements=world.measurements,
        sensors=world.sensors,
        anomalies=world.anomalies,
        daily_summaries=world.daily_summaries,
        etl_heartbeat=world.etl_heartbeat,
        quality_metrics=world.quality_metrics,
        model_runs=world.model_runs.withColumn("created_at", F.lit(AS_OF).cast("timestamp")),
    )
    assert len(VIEWS) == 19
    assert register_views(tables, AS_OF) == list(VIEWS)
    counted = spark.sql("select count(*) from v_anomaly_feed where severity = 'critical'")
    assert counted.first()[0] > 0
    assert register_views(Tables(measurements=world.measurements), AS_OF)[0] == (
        "v_pollutant_timeseries_24h"
    )
