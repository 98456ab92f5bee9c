import datetime as dt
import glob
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import SQLTransformer

from tests.conftest import rows
from zephyrine.operators import registry
from zephyrine.sources.model_store import ModelStore

SCHEMA = (
    "registry_name string, version long, stage string, run_order long, metrics map<string,double>"
)


def decide(spark, staging, production, up=True):
    data = [("m", 1, "Archived", 1, {"f1": 0.99})]
    if production is not None:
        data.append(("m", 2, "Production", 2, production))
    if staging is not None:
        data.append(("m", 3, "Staging", 3, staging))
    runs = spark.createDataFrame(data, SCHEMA)
    decision = registry.compare_stages(runs, "f1", up)
    stages = {r["version"]: r["stage"] for r in registry.promote(runs, decision).collect()}
    row = decision.first()
    return row["action"], row["improvement"], stages


@pytest.mark.parametrize(
    ("staging", "production", "up", "action", "gain", "stages"),
    [
        (None, {"f1": 0.5}, True, "none", None, {1: "Archived", 2: "Production"}),
        ({"x": 1.0}, {"f1": 0.5}, True, "none", None, {2: "Production", 3: "Staging"}),
        ({"f1": 0.5}, None, True, "promoted_first", None, {3: "Production"}),
        ({"f1": 0.5}, {"x": 1.0}, True, "promoted_first", None, {3: "Production"}),
        ({"f1": 0.75}, {"f1": 0.5}, True, "promoted_challenger", 0.25,
         {2: "Archived", 3: "Production"}),
        ({"f1": 0.5}, {"f1": 0.5}, True, "retained_champion", None,
         {2: "Production", 3: "Archived"}),
        ({"f1": 0.25}, {"f1": 0.5}, True, "retained_champion", None,
         {2: "Production", 3: "Archived"}),
        ({"f1": 0.25}, {"f1": 0.5}, False, "promoted_challenger", 0.25,
         {2: "Archived", 3: "Production"}),
    ],
)
def test_stages(spark, staging, production, up, action, gain, stages):
    found = decide(spark, staging, production, up)
    assert found[:2] == (action, gain)
    assert stages.items() <= found[2].items()


def test_best_run_takes_the_first_of_equals(spark):
    data = [
        ("m", 1, "None", 1, {"f1": 0.5}), ("m", 2, "None", 2, {"f1": 0.9}),
        ("m", 3, "None", 3, {"f1": 0.9}), ("m", 4, "None", 4, {"x": 5.0}),
    ]
    runs = spark.createDataFrame(data, SCHEMA)
    assert registry.best_run(runs, "f1").first()["version"] == 2
    assert registry.best_run(runs, "f1", higher_is_better=False).first()["version"] == 1
    assert registry.best_run(runs, "nothing").count() == 0


def test_model_store(spark, folder):
    store = ModelStore(spark, folder)
    assert store.load_model("m") == (None, {"name": "m", "version": "none", "stage": "none"})

    def model(n):
        step = SQLTransformer(statement=f"SELECT *, {n} AS n FROM __THIS__")
        return Pipeline(stages=[step]).fit(spark.range(1))

    at = dt.datetime(2024, 1, 1)
    ids = [
        store.append_model_run("m", f"k{n}", {"n": n}, {"f1": f1}, model(n), created_at=at)
        for n, f1 in ((1, 0.4), (2, 0.6))
    ]
    assert store.stage_if_better("m", ids, "f1", True) == (ids[1], True)
    loaded, info = store.load_model("m")
    assert info == {"name": "m", "version": "2", "stage": "Staging"}
    assert loaded.transform(spark.range(1)).first()["n"] == 2
    contest = (registry.Contest("m", "f1"),)
    assert rows(store.promote(contest), "action") == [("promoted_first",)]
    assert store.load_model("m")[1]["stage"] == "Production"
    worse = store.append_model_run("m", "k3", {}, {"f1": 0.1}, model(3), created_at=at)
    assert store.stage_if_better("m", [worse], "f1", True) == (worse, False)
    assert sorted(r["version"] for r in store.runs().collect()) == [1, 2, 3]


def test_writers_at_once_get_versions_of_their_own(spark, folder):
    with ThreadPoolExecutor(6) as pool:
        stores = [ModelStore(spark, folder) for _ in range(6)]
        ids = list(pool.map(lambda s: s.append_model_run("m", "x", {}, {"f1": 0.5}), stores))
    runs = stores[0].runs()
    assert rows(runs, "version") == [(n,) for n in range(1, 7)] == rows(runs, "run_order")
    assert {r["run_id"] for r in runs.collect()} == set(ids)


def test_stages_are_logged_and_nothing_is_rewritten(spark, folder):
    store = ModelStore(spark, folder)
    ids = [store.append_model_run("anomaly-classifier", "x", {}, {"f1": f}) for f in (0.5, 0.7)]

    def files():
        return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{folder}/model_*/*/part-*")}

    before = files()
    for run_id in ids:
        store.set_stage(run_id, "Staging")
        store.promote()
    assert before.items() <= files().items()
    assert rows(store.runs(), "version", "stage") == [(1, "Archived"), (2, "Production")]
    with ThreadPoolExecutor(4) as pool:  # the last event of a run holds
        list(pool.map(lambda s: store.set_stage(ids[0], s), ["None", "Staging", "None", "Staging"]))
    events = spark.read.parquet(f"{folder}/model_stages/*")
    assert events.select("event").distinct().count() == events.count()
    last = events.filter(events.run_id == ids[0]).orderBy(events.event.desc()).first()["stage"]
    assert rows(store.runs().filter("version = 1"), "stage") == [(last,)]
