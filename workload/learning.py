"""Queries that train, cluster and score; most have no SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workload.aggregates import _PROFILE_SQL
from workload.projection import AS_OF, World, with_tables
from workload.registry import ORACLES, query, rounded
from workload.streams import arriving_stream
from zephyrine.operators import clustering, features, isolation, metrics, models, scoring, summaries
from zephyrine.plans.training import split_key
from zephyrine.session import cut_lineage, scratch_path
from zephyrine.streaming.scoring import score_stream
from zephyrine.streaming.windows import run_to_table

COLUMNS = summaries.PROFILE_FEATURES


def _matrix(w: World) -> DataFrame:
    return features.build_feature_matrix(w.measurements, w.sensors, AS_OF, 30)


def _labelled(w: World) -> tuple[DataFrame, DataFrame]:
    labelled = cut_lineage(features.generate_labels(_matrix(w)))
    split = features.split_train_test(labelled, split_key(), stratify="label")
    return split.filter(~F.col("is_test")), split.filter("is_test")


def _forecast(w: World, target: str = "pm2_5") -> tuple[DataFrame, DataFrame]:
    data = cut_lineage(features.build_forecast_dataset(_matrix(w), target))
    split = features.split_train_test(data, split_key())
    return split.filter(~F.col("is_test")), split.filter("is_test")


def _profiles(w: World) -> DataFrame:
    return cut_lineage(summaries.sensor_profile(w.measurements, AS_OF))


@query()
def train_logistic(w: World) -> DataFrame:
    train, test = _labelled(w)
    return models.evaluate_classifier(models.train_logistic(train), test)


@query()
def train_random_forest(w: World) -> DataFrame:
    train, test = _labelled(w)
    return models.evaluate_classifier(models.train_random_forest(train), test)


@query()
def top_features(w: World) -> DataFrame:
    train, _ = _labelled(w)
    return models.feature_importances(w.spark, models.train_random_forest(train))


@query()
def isolation_forest(w: World) -> DataFrame:
    train, test = _labelled(w)
    forest = isolation.train_isolation_forest(train)
    return metrics.classification_metrics(forest.transform(test))


@query()
def train_ridge(w: World) -> DataFrame:
    train, test = _forecast(w)
    return models.evaluate_forecaster(models.train_ridge(train), test)


@query()
def train_boosted_trees(w: World) -> DataFrame:
    train, test = _forecast(w)
    return models.evaluate_forecaster(models.train_boosted_trees(train), test)


@query()
def kmeans_sensors(w: World) -> DataFrame:
    assigned, _ = clustering.kmeans_sensors(_profiles(w))
    return assigned.select("sensor_id", "cluster")


_UNROUNDED = _PROFILE_SQL.replace("round(stddev_samp(pm2_5), 6)", "stddev_samp(pm2_5)")
_Z = ", ".join(
    f"({c} - avg({c}) over ()) / coalesce(nullif(stddev_pop({c}) over (), 0), 1) as {c}"
    for c in COLUMNS
)
_DISTANCE = " + ".join(f"(a.{c} - b.{c}) ** 2" for c in COLUMNS)


@query(
    with_tables("m").replace("with ", "with recursive ", 1)
    + f""", p as ({_UNROUNDED}), z as (select sensor_id, {_Z} from p),
    near as (select a.sensor_id as x, b.sensor_id as y from z a join z b on {_DISTANCE} <= 0.64),
    core as (select x from near group by 1 having count(*) >= 3),
    edges as (select x, y from near where x in (select x from core) and y in (select x from core)),
    reached as (select x as root, x as node from core
      union select root, y from reached join edges on x = node),
    named as (select node, min(root) as cluster from reached group by 1),
    border as (select x, min(cluster) as cluster from near join named on y = node
      where x not in (select x from core) group by 1)
    select sensor_id, coalesce(named.cluster, border.cluster, '-1') as cluster,
    named.cluster is not null as is_core from z
    left join named on sensor_id = node left join border on sensor_id = border.x"""
)
def dbscan_sensors(w: World) -> DataFrame:
    scaled = features.scale_features(_profiles(w), COLUMNS)
    return clustering.dbscan(scaled, COLUMNS)


@query()
def pca_projection(w: World) -> DataFrame:
    scaled = features.scale_features(_profiles(w), COLUMNS)
    return clustering.pca_projection(scaled, COLUMNS)


@query(
    with_tables("m", "s")
    + f""", p as ({_UNROUNDED}),
    z as (select sensor_id, {_Z} from p),
    q as (select z.*, zone from z join s using (sensor_id)),
    d as (select a.sensor_id, a.zone as za, b.zone as zb,
          sum({_DISTANCE}) as total, count(*) as n from q a cross join q b group by 1, 2, 3),
    t as (select sensor_id, za,
          max(case when za = zb then total / nullif(n - 1, 0) end) as inside,
          min(case when za <> zb then total / n end) as outside,
          max(case when za = zb then n end) as own from d group by 1, 2)
    select round(avg(case when own = 1 then 0 else (outside - inside) / greatest(outside, inside)
    end), 6) as silhouette_sq from t"""
)
def silhouette(w: World) -> DataFrame:
    """How well the zones separate the sensor profiles."""
    scaled = features.scale_features(_profiles(w), COLUMNS)
    zoned = scaled.join(w.sensors.select("sensor_id", "zone"), "sensor_id")
    value = clustering.silhouette_of_names(cut_lineage(zoned), COLUMNS, "zone")
    made = w.spark.createDataFrame([(float(value),)], "silhouette_sq double")
    return rounded(made, 6, "silhouette_sq")


@query(
    with_tables("m", "s")
    + f""", p as ({_UNROUNDED}),
    z as (select sensor_id, {_Z} from p),
    q as (select z.*, zone from z join s using (sensor_id)),
    d as (select a.sensor_id, a.zone as za, b.zone as zb,
          sum(sqrt({_DISTANCE})) as total, count(*) as n from q a cross join q b group by 1, 2, 3),
    t as (select sensor_id, za,
          max(case when za = zb then total / nullif(n - 1, 0) end) as inside,
          min(case when za <> zb then total / n end) as outside,
          max(case when za = zb then n end) as own from d group by 1, 2)
    select round(avg(case when own = 1 then 0 else (outside - inside) / greatest(outside, inside)
    end), 6) as silhouette from t"""
)
def silhouette_euclidean(w: World) -> DataFrame:
    """The same under the plain distance, from sums over tiles."""
    scaled = features.scale_features(_profiles(w), COLUMNS)
    zoned = scaled.join(w.sensors.select("sensor_id", "zone"), "sensor_id")
    value = clustering.euclidean_silhouette(zoned, COLUMNS, "zone", slice_rows=64)
    made = w.spark.createDataFrame([(float(value),)], "silhouette double")
    return rounded(made, 6, "silhouette")


@query()
def score_batch(w: World) -> DataFrame:
    matrix = cut_lineage(features.generate_labels(_matrix(w)))
    classifier = models.train_logistic(matrix)
    forecasters = {
        target: models.train_ridge(features.build_forecast_dataset(matrix, target))
        for target in ("pm2_5", "no2")
    }
    return scoring.score_batch(matrix, classifier, forecasters, "anomaly-classifier", "1")


@query()
def stream_score(w: World) -> DataFrame:
    """The event stream scored by models trained on the feature matrix."""
    matrix = cut_lineage(features.generate_labels(_matrix(w)))
    classifier = models.train_logistic(matrix)
    forecast = models.train_ridge(features.build_forecast_dataset(matrix, "no2"), target="target")
    stream = arriving_stream(w)
    scored = score_stream(
        stream, classifier, {"no2": forecast}, "anomaly-classifier", "1", watermark=None, bucket_seconds=3600
    )
    place = scratch_path(w.spark, "scores")
    return run_to_table(scored, f"{place}/out", f"{place}/checkpoint")


_KEPT = ("pm2_5", "no2", "pm2_5_mean_5", "pm2_5_mean_15", "pm2_5_delta", "hour", "zone_enc")


@query(
    f"""select * from (select sensor_id, "timestamp", {", ".join(_KEPT)},
    lead(no2) over (partition by sensor_id order by "timestamp") as target
    from ({ORACLES["build_feature_matrix"]})) where target is not null"""
)
def build_forecast_dataset(w: World) -> DataFrame:
    data = features.build_forecast_dataset(_matrix(w), "no2")
    return features.select_available(data, _KEPT, keep=("sensor_id", "timestamp", "target"))
