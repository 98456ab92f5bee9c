"""Training jobs: candidates, evaluation, staging of the best."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zephyrine.functions.moments import Moment
from zephyrine.operators import clustering, features, isolation, metrics, models, summaries
from zephyrine.operators.scoring import score_batch
from zephyrine.session import cut_lineage
from zephyrine.sources.model_store import ModelStore

CLASSIFIER = "anomaly-classifier"
CLUSTERING = "sensor-clustering"
FORECAST_TARGETS = ("pm2_5", "no2")


def split_key() -> tuple:
    return "sensor_id", F.unix_micros("timestamp")


def forecaster_name(target: str) -> str:
    return f"pollution-forecaster-{target}"


#: Up to so many rows the gate looks at the first ones it finds; beyond, it counts.
GATE_ROWS = 1000


def train_gate(rows: DataFrame, minimum: int) -> bool:
    """Enough rows to train on?  A small minimum reads no more rows than needed, a large one is a distributed count."""
    if minimum <= GATE_ROWS:
        return len(rows.select(F.lit(1)).take(minimum)) >= minimum
    return rows.count() >= minimum


def train_best_classifier(matrix: DataFrame, store: ModelStore) -> tuple[str | None, bool]:
    """Logistic regression, random forest and isolation forest, all judged on one test split."""
    if not train_gate(matrix, 101):
        return None, False
    labelled = features.generate_labels(matrix)
    split = cut_lineage(features.split_train_test(labelled, split_key(), stratify="label"))
    train, test = split.filter(~F.col("is_test")), split.filter("is_test")
    runs = []
    for name, fit, params in (
        ("LogisticRegression", models.train_logistic, {"c": 1.0, "max_iter": 500}),
        ("RandomForest", models.train_random_forest, {"trees": 100, "depth": 10, "seed": 42}),
    ):
        model = fit(train, **params)
        found = models.evaluate_classifier(model, test).first().asDict()
        runs.append(store.append_model_run(CLASSIFIER, name, params, found, model))
    params = {"trees": 100, "contamination": 0.05, "seed": 42}
    forest = isolation.train_isolation_forest(train, **params)
    found = metrics.classification_metrics(forest.transform(test)).first().asDict()
    runs.append(store.append_model_run(CLASSIFIER, "IsolationForest", params, found, forest))
    return store.stage_if_better(CLASSIFIER, runs, "f1", higher_is_better=True)


def train_best_forecasters(
    matrix: DataFrame, store: ModelStore, rounds: int = 200
) -> dict[str, tuple[str | None, bool]]:
    """Ridge and boosted trees per target; each target has its own champion.

    The targets are fitted side by side, so that the cluster works for one while the other waits for a level's sums.
    """
    results: dict[str, tuple[str | None, bool]] = {}
    if not train_gate(matrix, 101):
        return {t: (None, False) for t in FORECAST_TARGETS}

    def fitted(target: str) -> list[tuple]:
        data = features.build_forecast_dataset(matrix, target)
        split = cut_lineage(features.split_train_test(data, split_key()))
        train, test = split.filter(~F.col("is_test")), split.filter("is_test")
        made = []
        for name, fit, params in (
            ("Ridge", models.train_ridge, {"alpha": 1.0}),
            ("BoostedTrees", models.train_boosted_trees, {"rounds": rounds, "seed": 42}),
        ):
            model = fit(train, **params)
            found = models.evaluate_forecaster(model, test).first().asDict()
            made.append((name, params, found, model, target))
        return made

    beside = inheritable_thread_target(matrix.sparkSession)
    with ThreadPoolExecutor(len(FORECAST_TARGETS)) as pool:
        work = [pool.submit(beside(fitted), target) for target in FORECAST_TARGETS]
        for target, made in zip(FORECAST_TARGETS, work, strict=True):
            name = forecaster_name(target)
            runs = [store.append_model_run(name, *run) for run in made.result()]
            results[target] = store.stage_if_better(name, runs, "rmse", higher_is_better=False)
    return results


def train_best_clustering(
    measurements: DataFrame, as_of: Moment, store: ModelStore, days: int = 90
) -> tuple[str | None, bool]:
    """k-means and density clusters over the sensor profiles, compared by silhouette."""
    profiles = cut_lineage(summaries.sensor_profile(measurements, as_of, f"{max(days, 7)} days"))
    if not train_gate(profiles, 5):
        return None, False
    columns = summaries.PROFILE_FEATURES
    scaled = cut_lineage(features.scale_features(profiles, columns))
    runs = []

    assigned, model = clustering.kmeans_sensors(profiles, columns)
    grouped = scaled.join(assigned.select("sensor_id", "cluster"), "sensor_id")
    found = {
        "silhouette_sq": clustering.silhouette(grouped, columns),
        "inertia": model.summary.trainingCost,
        "n_clusters": 4,
    }
    runs.append(
        store.append_model_run(CLUSTERING, "KMeans", {"k": 4, "restarts": 10}, found, model)
    )

    params = {"eps": 0.8, "min_samples": 3}
    density = cut_lineage(clustering.dbscan(scaled, columns, **params))
    counted = density.agg(
        F.countDistinct(F.nullif("cluster", F.lit(clustering.NOISE))).alias("found"),
        F.count_if(F.col("cluster") == clustering.NOISE).alias("noise"),
    ).first()
    score = 0.0
    if counted["found"] > 1:
        score = clustering.silhouette_of_names(scaled.join(density, "sensor_id"), columns)
    found = {
        "silhouette_sq": score,
        "n_clusters_found": counted["found"],
        "n_noise_points": counted["noise"],
    }
    runs.append(store.append_model_run(CLUSTERING, "DBSCAN", params, found))
    return store.stage_if_better(CLUSTERING, runs, "silhouette_sq", higher_is_better=True)


def score_with_store(rows: DataFrame, store: ModelStore) -> DataFrame:
    """Score feature rows with the champions; columns of absent models are null."""
    classifier, info = store.load_model(CLASSIFIER)
    forecasters, named = {}, info
    for target in FORECAST_TARGETS:
        model, about = store.load_model(forecaster_name(target))
        if model is not None:
            forecasters[target] = model
            named = info if classifier is not None else about
    if classifier is None and not forecasters:
        return score_batch(rows)
    return score_batch(rows, classifier, forecasters, named["name"], named["version"])
