"""Short and sliding windows, late events, gates, model storage, request scoring, the catalog."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from workload.aggregates import _PROFILE_SQL, ROLLING_SQL
from workload.learning import _matrix, _profiles
from workload.projection import AS_OF, DAY, World, with_tables
from workload.registry import ORACLES, query, rounded
from workload.streams import arriving_stream
from zephyrine import schemas
from zephyrine.operators import clustering, features, isolation, models, quality, rolling, scoring, summaries, trees
from zephyrine.plans import daily, training
from zephyrine.session import cut_lineage, scratch_path
from zephyrine.sources.declared import CatalogStore
from zephyrine.sources.model_store import ModelStore
from zephyrine.sources.tables import TableStore
from zephyrine.streaming.scoring import score_stream
from zephyrine.streaming.windows import run_to_table, start_lasting_stats, start_rolling_stats

_ROUNDED = ("pm2_5_std", "pm10_std", "no2_std")


def _window_sql(seconds: int, name: str, starts: str = "[0]") -> str:
    """The window statistics for windows of ``seconds``; ``starts`` shifts a reading's window back."""
    start = (
        f'make_timestamp((epoch_us("timestamp") // {seconds}000000) * {seconds}000000 - shift * 1000000)'
        if starts == "[0]"
        else 'make_timestamp((epoch_us("timestamp") // 300000000) * 300000000 - shift * 1000000)'
    )
    return (
        ROLLING_SQL.replace("date_trunc('day', \"timestamp\") + interval 1 day", f"{start} + interval {seconds} second")
        .replace("date_trunc('day', \"timestamp\")", start)
        .replace("'1day'", f"'{name}'")
        .replace("from m group by", f"from (select m.*, unnest({starts}) as shift from m) group by")
    )


@query(_window_sql(60, "1min"))
def rolling_stats_1min(w: World) -> DataFrame:
    return rounded(rolling.rolling_stats(w.measurements, "1min"), 6, *_ROUNDED)


@query(_window_sql(300, "5min"))
def rolling_stats_5min(w: World) -> DataFrame:
    return rounded(rolling.rolling_stats(w.measurements, "5min"), 6, *_ROUNDED)


@query(_window_sql(600, "sliding", "[0, 300]"))
def rolling_stats_sliding(w: World) -> DataFrame:
    stats = rolling.rolling_stats(w.measurements, "sliding", "10 minutes", "5 minutes")
    return rounded(stats, 6, *_ROUNDED)


@query(
    f"""select * from ({ROLLING_SQL})
    where window_end <= (select max(ts) from events) - interval 10 minute"""
)
def late_event_policy(w: World) -> DataFrame:
    """Append mode: a window is written once, when the watermark has passed its end."""
    place = scratch_path(w.spark, "late")
    store = TableStore(w.spark, f"{place}/tables")
    start_rolling_stats(
        w.event_stream, store, "1day", f"{place}/checkpoint", duration="1 day", digits=None, once=True
    ).awaitTermination()
    return rounded(store.read("aggregates").drop("date", "created_at"), 6, *_ROUNDED)


@query(
    with_tables("m", "s")
    + f"""select w.* from ({ROLLING_SQL}) w where sensor_id in (select sensor_id from s) and window_end <=
    (select max("timestamp") from m where sensor_id in (select sensor_id from s)) - interval 1 day"""
)
def late_events_kept(w: World) -> DataFrame:
    """Rows up to three days late in windows that close after one day: closed windows equal the batch windows."""
    place = scratch_path(w.spark, "late")
    store = TableStore(w.spark, f"{place}/tables")
    start_lasting_stats(
        arriving_stream(w), store, "1day", f"{place}/checkpoint", wait="1 day", duration="1 day", digits=None, once=True
    ).awaitTermination()
    return rounded(store.read("aggregates").drop("date", "created_at"), 6, *_ROUNDED)


@query(
    with_tables("m")
    + f"""select count(*) as total, count(*) filter (where pm2_5 is null) as null_pm25,
    count(*) filter (where pm2_5 < 0 or pm10 < 0) as negative_values,
    count(*) filter (where pm2_5 is null) / count(*) as null_rate,
    count(*) filter (where pm2_5 is null) / count(*) <= 0.3 as passed
    from m where cast("timestamp" as date) = date '{DAY[:10]}'"""
)
def quality_gate_day(w: World) -> DataFrame:
    """The gate of one day, on the stored table: one partition is read."""
    store = TableStore(w.spark, scratch_path(w.spark, "gate"))
    store.append("measurements", w.measurements)
    return quality.quality_gate(store.read("measurements"), DAY, 0.3)


_REQUEST = ("pm2_5", "pm10", "no2", "temperature", "humidity")


@query(
    with_tables("m")
    + """, r as (select event_id, coalesce(pm2_5, 0) as pm2_5, coalesce(pm10, 0) as pm10,
      coalesce(no2, 0) as no2, coalesce(temperature, 20) as temperature, coalesce(humidity, 50) as humidity,
      "timestamp" from m)
    select event_id, pm2_5, pm10, no2, temperature, humidity, pm2_5 as pm2_5_mean_5, 0::double as pm2_5_std_5,
      0::double as pm2_5_delta, pm10 as pm10_mean_5, no2 as no2_mean_5, hour("timestamp") as hour,
      (dayofweek("timestamp") + 6) % 7 as day_of_week, ((dayofweek("timestamp") + 6) % 7 >= 5)::int as is_weekend,
      0 as zone_enc from r"""
)
def request_features(w: World) -> DataFrame:
    """Readings without history or place, as a scoring request brings them."""
    bare = w.measurements.withColumns({"city": F.lit(None).cast("string"), "zone": F.lit(None).cast("string")})
    found = scoring.request_features(bare)
    return found.select(
        "event_id", *_REQUEST, "pm2_5_mean_5", "pm2_5_std_5", "pm2_5_delta", "pm10_mean_5", "no2_mean_5",
        "hour", "day_of_week", "is_weekend", "zone_enc",
    )


@query(with_tables("m") + "select count(*) > 100 as enough, count(*) > 1000000000 as plenty from m")
def train_gate(w: World) -> DataFrame:
    answer = (training.train_gate(w.measurements, 101), training.train_gate(w.measurements, 10**9))
    return w.spark.createDataFrame([answer], "enough boolean, plenty boolean")


@query(f"select count(*) as scored, 0::bigint as differing from ({ORACLES['build_feature_matrix']})")
def model_round_trip(w: World) -> DataFrame:
    """A fitted model saved with its run, loaded as the champion: no score differs."""
    matrix = cut_lineage(features.generate_labels(_matrix(w)))
    model = models.train_logistic(matrix)
    store = ModelStore(w.spark, scratch_path(w.spark, "models"))
    store.append_model_run("round-trip", "LogisticRegression", {"c": 1.0}, {"f1": 1.0}, model, stage="Production")
    loaded, _ = store.load_model("round-trip")
    key = ["sensor_id", "timestamp"]
    before = models.transform(model, matrix).select(*key, F.col("prediction").alias("a"))
    after = models.transform(loaded, matrix).select(*key, F.col("prediction").alias("b"))
    return before.join(after, key).agg(
        F.count("*").alias("scored"), F.count_if(F.col("a") != F.col("b")).alias("differing")
    )


@query(
    """select 3::bigint as candidates, 1::bigint as staged, 0::bigint as better_left_behind"""
)
def train_best(w: World) -> DataFrame:
    """The classifier candidates on one split: three runs, the best by F1 is staged."""
    store = ModelStore(w.spark, scratch_path(w.spark, "models"))
    training.train_best_classifier(cut_lineage(_matrix(w)), store)
    runs = store.runs().select("stage", F.col("metrics")["f1"].alias("f1"))
    best = runs.agg(F.max(F.when(F.col("stage") != "None", F.col("f1"))).alias("top"))
    return runs.crossJoin(F.broadcast(best)).agg(  # one row on the right
        F.count("*").alias("candidates"),
        F.count_if(F.col("stage") != "None").alias("staged"),
        F.count_if(F.col("f1") > F.col("top")).alias("better_left_behind"),
    )


def _contest(store: ModelStore, metric: str, lower_wins: bool) -> DataFrame:
    """Per registry name the runs, how many are staged, and how many that are not staged beat them."""
    runs = store.runs().select("registry_name", "stage", F.col("metrics")[metric].alias("value"))
    sign = F.lit(-1.0 if lower_wins else 1.0)
    staged = F.col("stage") == "Staging"
    top = F.max(F.when(staged, sign * F.col("value"))).over(Window.partitionBy("registry_name"))
    return runs.withColumn("top", top).groupBy("registry_name").agg(
        F.count("*").alias("candidates"),
        F.count_if(staged).alias("staged"),
        F.count_if(~staged & (sign * F.col("value") > F.col("top"))).alias("better_left_behind"),
    )


@query(
    """select 'pollution-forecaster-' || target as registry_name, 2::bigint as candidates, 1::bigint as staged,
    0::bigint as better_left_behind from (values ('pm2_5'), ('no2')) as t(target)"""
)
def train_best_forecasters(w: World) -> DataFrame:
    """Ridge and boosted trees for each target: the lower error is staged."""
    store = ModelStore(w.spark, scratch_path(w.spark, "models"))
    training.train_best_forecasters(cut_lineage(_matrix(w)), store)
    return _contest(store, "rmse", lower_wins=True)


@query(
    """select 'sensor-clustering' as registry_name, 2::bigint as candidates, 1::bigint as staged,
    0::bigint as better_left_behind"""
)
def train_best_clustering(w: World) -> DataFrame:
    """k-means and density clusters of the profiles: the higher silhouette is staged."""
    store = ModelStore(w.spark, scratch_path(w.spark, "models"))
    training.train_best_clustering(w.measurements, AS_OF, store)
    return _contest(store, "silhouette_sq", lower_wins=False)


@query(
    with_tables("m")
    + f""", p as ({_PROFILE_SQL}) select count(*) as sensors, least(4, count(*)) as clusters,
    0::bigint as nearer_elsewhere from p"""
)
def kmeans_fit(w: World) -> DataFrame:
    """Every sensor is in the cluster whose centre is nearest to its scaled profile."""
    columns = summaries.PROFILE_FEATURES
    profiles = _profiles(w)
    assigned, model = clustering.kmeans_sensors(profiles, columns)
    scaled = features.scale_features(profiles, columns).join(assigned.select("sensor_id", "cluster"), "sensor_id")
    gaps = [
        sum(((F.col(c) - float(x)) ** 2 for c, x in zip(columns, centre, strict=True)), F.lit(0.0))
        for centre in model.clusterCenters()
    ]
    own = F.element_at(F.array(*gaps), F.col("cluster") + 1)
    return scaled.agg(
        F.count("*").alias("sensors"),
        F.countDistinct("cluster").alias("clusters"),
        F.count_if(own > F.array_min(F.array(*gaps)) + 1e-9).alias("nearer_elsewhere"),
    )


@query(
    with_tables("m")
    + f""", p as ({_PROFILE_SQL}) select count(*) as sensors, 0.0::double as mean_1, 0.0::double as mean_2,
    0.0::double as covariance, true as first_is_wider from p"""
)
def pca_axes(w: World) -> DataFrame:
    """Coordinates on the principal axes are centred and uncorrelated, the first the widest."""
    columns = summaries.PROFILE_FEATURES
    found = clustering.pca_projection(features.scale_features(_profiles(w), columns), columns)
    size = F.greatest(F.var_pop("pc1"), F.lit(1e-12))
    return found.agg(
        F.count("*").alias("sensors"),
        F.abs(F.round(F.avg("pc1"), 6)).alias("mean_1"),
        F.abs(F.round(F.avg("pc2"), 6)).alias("mean_2"),
        F.abs(F.round(F.covar_pop("pc1", "pc2") / size, 6)).alias("covariance"),
        (F.var_pop("pc1") >= F.var_pop("pc2")).alias("first_is_wider"),
    )


@query(
    with_tables("m")
    + """select 'measurements' as table_name, count(*) as row_count from m
    union all select 'anomalies', 0 union all select 'aggregates', 0 union all select 'daily_summaries', 0
    union all select 'etl_heartbeat', 0
    union all select 'sensors', (select count(*) from customer where c_acctbal >= 0)"""
)
def run_catalog(w: World) -> DataFrame:
    """The catalog job over a store that holds the measurements, run twice."""
    store = TableStore(w.spark, scratch_path(w.spark, "catalog"))
    store.append("measurements", w.measurements)
    for _ in range(2):
        daily.run_catalog(w.spark, store, AS_OF, store.root, w.sensors)
    return store.read("quality_metrics").select("table_name", "row_count")


@query(
    """select source as name, 'documents' as source_type, count(*) || ' documents' as description
    from documents group by 1 union all select 'someone else', 'api', 'kept'"""
)
def write_catalog_tables(w: World) -> DataFrame:
    """Stale rows are replaced by key, rows of others stay, a replay changes nothing."""
    store = CatalogStore(w.spark, scratch_path(w.spark, "catalog"))
    rows = w.documents.groupBy(F.col("source").alias("name")).agg(
        F.lit("documents").alias("source_type"),
        F.concat(F.count("*").cast("string"), F.lit(" documents")).alias("description"),
    )
    other = w.spark.createDataFrame([("someone else", "api", "kept")], schemas.DATA_SOURCES)
    store.upsert("data_sources", rows.withColumn("description", F.lit("stale")).unionByName(other))
    for _ in range(2):
        store.upsert("data_sources", rows)
    return store.read("data_sources").drop("version")


def _fixed_models() -> tuple[PipelineModel, dict[str, PipelineModel]]:
    """A classifier and a forecaster with given coefficients, so that scores are an expression."""
    odds = "1 / (1 + exp(2D - coalesce(pm2_5, 0D) / 64D))"
    classifier = PipelineModel(
        [
            SQLTransformer(statement=f"SELECT *, 1 - {odds} AS _x_no, {odds} AS _x_yes FROM __THIS__"),
            VectorAssembler(inputCols=["_x_no", "_x_yes"], outputCol="probability"),
        ]
    )
    forecaster = PipelineModel(
        [SQLTransformer(statement="SELECT *, coalesce(no2, 0D) * 0.5D + 1D AS prediction FROM __THIS__")]
    )
    return classifier, {"no2": forecaster}


_SCORED = """select sensor_id, "timestamp", round(1 / (1 + exp(2 - coalesce(pm2_5, 0) / 64.0)), 9) as anomaly_probability,
    1 / (1 + exp(2 - coalesce(pm2_5, 0) / 64.0)) > 0.5 as is_anomaly, null::double as pm2_5_forecast,
    coalesce(no2, 0) * 0.5 + 1 as no2_forecast, 'fixed' as model_name, '1' as model_version from """


@query(_SCORED + f"({ORACLES['build_feature_matrix']})")
def score_fixed(w: World) -> DataFrame:
    """Batch scoring of the feature matrix with given coefficients."""
    classifier, forecasters = _fixed_models()
    scored = scoring.score_batch(_matrix(w), classifier, forecasters, "fixed", "1")
    return rounded(scored, 9, "anomaly_probability")


@query(with_tables("m", "s") + _SCORED + "m join s using (sensor_id)")
def stream_score_fixed(w: World) -> DataFrame:
    """The event stream scored with given coefficients of the reading itself."""
    classifier, forecasters = _fixed_models()
    stream = arriving_stream(w)
    scored = score_stream(stream, classifier, forecasters, "fixed", "1", watermark=None, bucket_seconds=3600)
    place = scratch_path(w.spark, "scores")
    found = run_to_table(scored, f"{place}/out", f"{place}/checkpoint")
    return rounded(found, 9, "anomaly_probability")


@query(
    f"""with d as (select pm2_5, target from ({ORACLES["build_forecast_dataset"]})),
    k as (select count(*) as n, avg(pm2_5) as m, stddev_pop(pm2_5) as s, avg(target) as t from d)
    select round(any_value(t), 6) as intercept,
    round(sum((pm2_5 - m) / s * (target - t)) / (any_value(n) + 1), 6) as slope from d cross join k"""
)
def ridge_one_feature(w: World) -> DataFrame:
    """Ridge on the z-score of one feature has a closed form."""
    data = cut_lineage(features.build_forecast_dataset(_matrix(w), "no2"))
    fitted = models.train_ridge(data, columns=("pm2_5",), alpha=1.0).stages[-1]
    row = (round(float(fitted.intercept), 6), round(float(fitted.coefficients[0]), 6))
    return w.spark.createDataFrame([row], "intercept double, slope double")


@query(
    f"""select count(*) as n, round(avg(label), 3) as label_rate, round(avg(label), 3) as mean_probability
    from ({ORACLES["generate_labels"]})"""
)
def logistic_calibration(w: World) -> DataFrame:
    """At its optimum a logistic regression predicts the label rate on average."""
    labelled = cut_lineage(features.generate_labels(w.measurements))
    model = models.train_logistic(labelled, columns=("pm2_5", "pm10", "no2"))
    yes = vector_to_array("probability")[1]
    return model.transform(labelled).agg(
        F.count("*").alias("n"),
        F.round(F.avg("label"), 3).alias("label_rate"),
        F.round(F.avg(yes), 3).alias("mean_probability"),
    )


@query(
    with_tables("m")
    + """, d as (select coalesce(no2, 0) as x, pm2_5 as y from m where pm2_5 is not null),
    b as (select avg(y) as base, count(*) as n from d),
    s as (select x, sum(base - y) as g, count(*) as h from d cross join b group by x),
    c as (select x, sum(g) over w as gl, sum(h) over w as hl, sum(g) over () as g, sum(h) over () as h
      from s window w as (order by x rows between unbounded preceding and current row)),
    top as (select * from c where h > hl
      order by gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1) desc, x limit 1)
    select x as threshold, round(-0.05 * gl / (hl + 1), 5) as left_value,
    round(-0.05 * (g - gl) / (h - hl + 1), 5) as right_value, round(base, 6) as base from top cross join b"""
)
def boosted_one_split(w: World) -> DataFrame:
    """The first split of boosting on one feature, its cut and its leaves."""
    rows = w.measurements.filter("pm2_5 is not null")
    model = models.train_boosted_trees(
        rows, ("no2",), "pm2_5", rounds=1, depth=1, subsample=1.0, column_sample=1.0
    )
    content = model.stages[-1].content
    tree = content["trees"][0]
    left, right = (round(tree["value"][tree[side][0]], 5) for side in ("left", "right"))
    row = (tree["threshold"][0], left, right, round(content["base"], 6))
    return w.spark.createDataFrame([row], "threshold double, left_value double, right_value double, base double")


@query(
    with_tables("m")
    + """, d as (select coalesce(no2, 0) as x, (pm2_5 > 50)::int as y from m where pm2_5 is not null),
    s as (select x, sum(y) as g, count(*) as h from d group by x),
    c as (select x, sum(g) over w as gl, sum(h) over w as hl, sum(g) over () as g, sum(h) over () as h
      from s window w as (order by x rows between unbounded preceding and current row)),
    top as (select x from c where h > hl order by gl * gl / hl + (g - gl) * (g - gl) / (h - hl) desc, x limit 1)
    select d.x <= top.x as low, count(*) as n, round(avg(y), 6) as probability from d cross join top group by 1"""
)
def tree_one_split(w: World) -> DataFrame:
    """One tree of depth 1 without a bootstrap: its two leaves hold the shares of ones."""
    rows = w.measurements.filter("pm2_5 is not null").withColumn("label", (F.col("pm2_5") > 50).cast("int"))
    data = trees.bin_rows(rows, ("no2",), "label")
    grown = trees.grow_trees(data, 1, trees.Growth(depth=1, reg=0.0), boosted=False)
    model = PipelineModel([*models.feature_stages(("no2",)), trees.ensemble_of(data, grown, boosted=False)])
    scored = models.transform(model, rows).withColumn("probability", F.round(vector_to_array("probability")[1], 6))
    low = F.coalesce("no2", F.lit(0.0)) <= grown[0]["threshold"][0]
    return scored.groupBy(low.alias("low"), "probability").agg(F.count("*").alias("n"))


#: (tree, node, feature, cut, low, high, size): three small trees over a sample of 16 rows.
_NODES = [
    (0, 0, "pm2_5", 300.0, 1, 2, 16), (0, 1, "no2", 30.0, 3, 4, 13), (0, 2, None, 0.0, -1, -1, 3),
    (0, 3, None, 0.0, -1, -1, 2), (0, 4, "pm10", 40.0, 5, 6, 11), (0, 5, None, 0.0, -1, -1, 1),
    (0, 6, None, 0.0, -1, -1, 10), (1, 0, "no2", 270.0, 1, 2, 16), (1, 1, "pm2_5", 10.0, 3, 4, 14),
    (1, 2, "pm10", 100.0, 5, 6, 2), (1, 3, None, 0.0, -1, -1, 1), (1, 4, None, 0.0, -1, -1, 13),
    (1, 5, None, 0.0, -1, -1, 1), (1, 6, None, 0.0, -1, -1, 1), (2, 0, None, 0.0, -1, -1, 16),
]
_MEAN_PATH = """case when {n} > 2 then 2 * (ln({n} - 1.0) + 0.5772156649015329) - 2 * ({n} - 1.0) / {n}
    when {n} = 2 then 1 else 0 end"""


@query(
    with_tables("m")
    + f""", nodes(tree, node, feature, cut, low, high, size) as (values
    {", ".join("(" + ", ".join("null" if v is None else repr(v) for v in n) + ")" for n in _NODES)}),
    walk as (
      with recursive walk as (
        select event_id, coalesce(pm2_5, 0) as pm2_5, coalesce(pm10, 0) as pm10, coalesce(no2, 0) as no2,
          tree, 0 as node, 0 as depth from m cross join (select distinct tree from nodes)
        union all
        select event_id, pm2_5, pm10, no2, w.tree, case when
          (case feature when 'pm2_5' then pm2_5 when 'pm10' then pm10 else no2 end) <= cut then low else high end,
          depth + 1 from walk w join nodes n on w.tree = n.tree and w.node = n.node and feature is not null)
      select w.*, size from walk w join nodes n on w.tree = n.tree and w.node = n.node and feature is null),
    scores as (select event_id, sum(depth) as steps,
      pow(2, -sum(depth + {_MEAN_PATH.format(n="size")}) / 3 / ({_MEAN_PATH.format(n="16")})) as score
      from walk group by event_id),
    bar as (select quantile_disc(score, 0.95) as cut from scores)
    select event_id, steps, round(score, 9) as score, round(cut, 9) as cut, score > cut as flagged
    from scores cross join bar"""
)
def isolation_forest_stored(w: World) -> DataFrame:
    """A stored forest: path lengths by recursion, scores, the threshold at the 95 % quantile, and what it flags."""
    columns = ("pm2_5", "pm10", "no2")
    nodes = w.spark.createDataFrame(_NODES, isolation.NODES)
    rows = cut_lineage(w.measurements.select("event_id", *columns))
    path = scratch_path(w.spark, "forest")
    isolation.IsolationForest.of_nodes(nodes, columns, 16).fit_threshold(rows, 0.05).save(w.spark, path)
    forest = isolation.IsolationForest.load(w.spark, path)
    walked = isolation.path_lengths(rows, forest.nodes(w.spark), ("event_id",), columns)
    steps = walked.groupBy("event_id").agg(F.sum("depth").alias("steps"))
    scored = forest.transform(rows).select(
        "event_id", F.round("score", 9).alias("score"), (F.col("prediction") == 1).alias("flagged")
    )
    return steps.join(scored, "event_id").withColumn("cut", F.lit(round(forest.threshold, 9)))


@query("select 2::bigint as features, 1.0::double as total, true as all_positive")
def importance_shares(w: World) -> DataFrame:
    """Importances of a forest are shares: not negative, one in total."""
    labelled = cut_lineage(features.generate_labels(w.measurements))
    model = models.train_random_forest(labelled, columns=("pm2_5", "pm10"))
    return models.feature_importances(w.spark, model).agg(
        F.count("*").alias("features"),
        F.round(F.sum("importance"), 6).alias("total"),
        F.bool_and(F.col("importance") >= 0).alias("all_positive"),
    )
