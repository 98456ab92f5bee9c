import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tests.conftest import rows
from zephyrine.operators import clustering, features, isolation, metrics, models, scoring, spaces, trees
from zephyrine.operators.components import connected_components
from zephyrine.plans import training

RNG = np.random.default_rng(7)


def table(spark, x, **columns):
    pdf = pd.DataFrame({f"f{i}": x[:, i] for i in range(x.shape[1])}).assign(**columns)
    pdf.insert(0, "id", [f"p{i:04d}" for i in range(len(x))])
    return spark.createDataFrame(pdf)


def test_split_is_exact_per_class_and_independent_of_partitioning(spark):
    df = spark.range(5000).select("id", (F.col("id") % 10 == 0).cast("int").alias("label"))
    made = features.split_train_test(df, ("id",), 0.2, stratify="label")
    assert rows(made.filter("is_test").groupBy("label").count()) == [(0, 900), (1, 100)]
    again = features.split_train_test(df.repartition(7), ("id",), 0.2, stratify="label")
    assert rows(again.filter("is_test"), "id") == rows(made.filter("is_test"), "id")
    plain = features.split_train_test(df.limit(11), ("id",), 0.2)
    assert plain.filter("is_test").count() == 3


def test_split_takes_any_number_of_classes(spark):
    df = spark.range(6000).select("id", (F.col("id") % 1500).alias("class"))
    made = features.split_train_test(df, ("id",), 0.3, stratify="class")
    tests = made.groupBy("class").agg(F.count_if("is_test").alias("n")).select("n").distinct()
    assert made.count() == 6000 and rows(tests) == [(2,)]


def test_split_narrows_large_classes(spark, monkeypatch):
    df = spark.range(5000).select("id", (F.col("id") % 10 == 0).cast("int").alias("label"))
    ranked = features.split_train_test(df, ("id",), 0.2, stratify="label")
    monkeypatch.setattr(features, "_RANKED_ROWS", 2)
    monkeypatch.setattr(features, "_DIGITS", 1)
    narrowed = features.split_train_test(df, ("id",), 0.2, stratify="label")
    assert rows(narrowed.filter("is_test"), "id") == rows(ranked.filter("is_test"), "id")
    assert features.split_train_test(df.limit(0), ("id",), 0.2, stratify="label").count() == 0


def test_scaling_uses_the_population_deviation(spark):
    x = RNG.normal(3, 2, (50, 2))
    x[:, 1] = 4.0
    made = features.scale_features(table(spark, x), ("f0", "f1")).orderBy("id").toPandas()
    np.testing.assert_allclose(made["f0"], (x[:, 0] - x[:, 0].mean()) / x[:, 0].std())
    assert (made["f1"] == 0).all()


def test_ridge_equals_the_closed_form(spark):
    x = RNG.normal(0, 3, (200, 3)) + 5
    y = x @ [1.0, -2.0, 0.5] + RNG.normal(0, 1, 200)
    model = models.train_ridge(table(spark, x, target=y), ("f0", "f1", "f2"), alpha=25.0)
    z = (x - x.mean(0)) / x.std(0)
    w = np.linalg.solve(z.T @ z + 25.0 * np.eye(3), z.T @ (y - y.mean()))
    np.testing.assert_allclose(model.stages[-1].coefficients.toArray(), w, rtol=1e-6)


def test_logistic_equals_newton(spark):
    x = RNG.normal(0, 1, (300, 2))
    y = (x @ [1.5, -1.0] + RNG.normal(0, 1, 300) > 0).astype(int)
    model = models.train_logistic(table(spark, x, label=y), ("f0", "f1"))
    z = np.column_stack([(x - x.mean(0)) / x.std(0), np.ones(300)])
    w = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-z @ w))
        penalty = np.diag([1.0, 1.0, 0.0])
        w -= np.linalg.solve(z.T * (p * (1 - p)) @ z + penalty, z.T @ (p - y) + penalty @ w)
    np.testing.assert_allclose(model.stages[-1].coefficients.toArray(), w[:2], atol=1e-4)


@pytest.mark.parametrize(
    ("pairs", "accuracy", "f1"),
    [
        ([(1, 0), (0, 0)], 0.5, 0.0),
        ([(1, 1), (0, 0)], 1.0, 1.0),
        ([(0, 0), (0, 0)], 1.0, 0.0),
        ([(1, 1), (1, 0), (0, 1), (0, 0)], 0.5, 0.5),
    ],
)
def test_classification_metrics(spark, pairs, accuracy, f1):
    df = spark.createDataFrame(pairs, "label int, prediction int")
    row = metrics.classification_metrics(df).first()
    assert (row["accuracy"], row["f1"], row["test_size"]) == (accuracy, f1, len(pairs))


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0)], "target double, prediction double")
    row = metrics.regression_metrics(df).first()
    assert (row["rmse"], row["mae"], row["r2"]) == (pytest.approx(0.5**0.5), 0.5, 0.5)
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "target double, prediction double")
    assert metrics.regression_metrics(flat).first()["r2"] is None


def brute_dbscan(x, ids, eps, least):
    near = ((x[:, None] - x[None]) ** 2).sum(-1) <= eps * eps
    core = near.sum(1) >= least
    parent = list(range(len(x)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(x)):
        for j in range(i):
            if core[i] and core[j] and near[i, j]:
                parent[root(i)] = root(j)
    names = {}
    for i in range(len(x)):
        if core[i]:
            names[root(i)] = min(names.get(root(i), "~"), ids[i])
    found = {}
    for i in range(len(x)):
        reach = [names[root(j)] for j in range(len(x)) if core[j] and (near[i, j] or i == j)]
        found[ids[i]] = (
            names[root(i)] if core[i] else min(reach, default=clustering.NOISE), bool(core[i])
        )
    return found


@pytest.mark.parametrize(
    ("dims", "eps", "least", "part_cells"),
    [(2, 0.8, 3, 4096), (2, 0.3, 5, 8), (4, 0.9, 3, 16), (3, 0.6, 2, 5), (3, 0.7, 60, 10)],
)
def test_density_clusters_match_brute_force(spark, dims, eps, least, part_cells):
    blobs = [RNG.normal(c, 0.35, (45, dims)) for c in (0.0, 2.0)]
    x = np.vstack([*blobs, RNG.uniform(-3, 5, (40, dims)), np.repeat(blobs[0][:1], 20, axis=0)])
    df = table(spark, x)
    names = tuple(f"f{i}" for i in range(dims))
    found = clustering.dbscan(df, names, key="id", eps=eps, min_samples=least, part_cells=part_cells)
    ids = [f"p{i:04d}" for i in range(len(x))]
    expected = brute_dbscan(x, ids, eps, least)
    assert {r["id"]: (r["cluster"], r["is_core"]) for r in found.collect()} == expected
    assert len({c for c, _ in expected.values()}) > (least < 60)


def test_density_clusters_store_no_pairs_of_connected_cells(spark, monkeypatch):
    x = np.vstack([RNG.uniform(0, 1.5, (500, 3)), RNG.uniform(2.2, 3.2, (150, 3)), RNG.uniform(-2, 5, (30, 3))])
    names, df, ids, stored, kept = ("f0", "f1", "f2"), table(spark, x), [f"p{i:04d}" for i in range(len(x))], [], clustering.cut_lineage
    monkeypatch.setattr(clustering, "cut_lineage", lambda d: stored.append(kept(d)) or stored[-1])
    found = clustering.dbscan(df, names, key="id", eps=0.5)
    assert {r["id"]: (r["cluster"], r["is_core"]) for r in found.collect()} == brute_dbscan(x, ids, 0.5, 3)
    assert max(d.count() for d in stored) <= 2 * len(x)


def test_merged_roots_are_the_smallest_of_their_components():
    a, b = RNG.integers(0, 300, (2, 260))
    expected = np.arange(300)
    for _ in range(300):
        low = np.minimum(expected[a], expected[b])
        np.minimum.at(expected, a, low)
        np.minimum.at(expected, b, low)
    first = spaces._merged(np.arange(300), a[:100], b[:100])
    assert (spaces._merged(first, a[100:], b[100:]) == expected).all() and len(set(expected)) > 20


@pytest.mark.parametrize("tile_rows", [7, 40])
def test_density_clusters_of_small_tiles_match_brute_force(spark, tile_rows):
    x = np.vstack([RNG.normal(0, 0.35, (60, 3)), RNG.uniform(-2, 3, (60, 3)), np.zeros((9, 3))])
    names, df, ids = ("f0", "f1", "f2"), table(spark, x), [f"p{i:04d}" for i in range(len(x))]
    found = clustering.dbscan(df, names, key="id", eps=0.5, part_cells=30, tile_rows=tile_rows)
    assert {r["id"]: (r["cluster"], r["is_core"]) for r in found.collect()} == brute_dbscan(x, ids, 0.5, 3)


def test_a_task_holds_a_tile_of_the_rows_within_reach_of_a_part(spark):
    cells = spark.range(1000).selectExpr("cast(id as string) as cell", "1L as n", "0L as part", "id < 300 as own")
    sizes = "part long, own long, facing long"

    def held(t):
        facing = t.column("facing").to_numpy()
        return t.slice(0, 1).select(["part"]).append_column("own", [[(~facing).sum()]]).append_column(
            "facing", [[facing.sum()]]
        )

    tiles = spaces._tiles(cells, cells, "cell", 100).applyInArrow(held, sizes).collect()
    assert len(tiles) == 30 and max(max(t.own, t.facing) for t in tiles) < 150
    assert (sum(t.own for t in tiles), sum(t.facing for t in tiles)) == (3000, 3000)


def test_every_cell_is_in_the_parts_within_reach(spark):
    x = np.concatenate([RNG.normal(0, 1, (300, 3)), RNG.normal(0, 0.01, (50, 3))])
    side, eps, names = 0.25, 0.5, ["x0", "x1", "x2"]
    cells = spark.createDataFrame(
        [(str(i), 1, *map(float, p), *map(float, p)) for i, p in enumerate(x)],
        "cell string, n long, " + ", ".join(f"{end}_{n} double" for end in ("lo", "hi") for n in names),
    )
    tree = spaces.fit_tree(cells, names, side, 20)
    placed = [(int(r.cell), r.part, r.own) for r in spaces.place_cells(cells, names, tree, eps).collect()]
    homes = {c: part for c, part, own in placed if own}
    assert len(homes) == sum(own for *_, own in placed) == len(x) and len(set(homes.values())) > 10
    held = {(c, part) for c, part, _ in placed}
    near = ((x[:, None] - x[None]) ** 2).sum(-1) <= eps * eps
    assert all((j, homes[i]) in held for i, j in zip(*np.nonzero(near), strict=True))
    assert len(held) < len(x) * len(set(homes.values())) / 2


def test_components(spark):
    chain = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(40)]
    edges = spark.createDataFrame([*chain, ("x", "y"), ("z", "z")], "u string, v string")
    found = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert found == {**{f"c{i:03d}": "c000" for i in range(41)}, "x": "x", "y": "x", "z": "z"}


def test_silhouette(spark):
    x = np.vstack([RNG.normal(0, 1, (20, 2)), RNG.normal(3, 1, (15, 2))])
    labels = np.repeat([0, 1], [20, 15])
    d = ((x[:, None] - x[None]) ** 2).sum(-1)
    scores = []
    for i in range(len(x)):
        inside = d[i, labels == labels[i]].sum() / ((labels == labels[i]).sum() - 1)
        outside = d[i, labels != labels[i]].mean()
        scores.append((outside - inside) / max(inside, outside))
    df = table(spark, x, cluster=labels)
    assert clustering.silhouette(df, ("f0", "f1")) == pytest.approx(np.mean(scores))
    assert clustering.silhouette(df.filter("cluster = 0"), ("f0", "f1")) == 0.0
    named = df.withColumn("cluster", F.concat(F.lit("k"), "cluster"))
    assert clustering.silhouette_of_names(named, ("f0", "f1")) == pytest.approx(np.mean(scores))


def test_copies_of_a_point_do_not_grow_with_the_points():
    assert [clustering.slices_of(n, 64) for n in (1, 65, 90_000, 540_000)] == [1, 2, 64, 64]
    assert clustering.slices_of(100 << 16, 64) == 100


@pytest.mark.parametrize("slice_rows", [7, 1000])
def test_euclidean_silhouette(spark, slice_rows):
    x = np.vstack([RNG.normal(0, 1, (20, 2)), RNG.normal(3, 1, (15, 2)), RNG.normal(9, 1, (1, 2))])
    labels = np.repeat([0, 1, -1], [20, 15, 1])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    scores = []
    for i in range(len(x)):
        inside = d[i, labels == labels[i]].sum() / max((labels == labels[i]).sum() - 1, 1)
        outside = min(d[i, labels == c].mean() for c in set(labels) - {labels[i]})
        scores.append(0.0 if labels[i] == -1 else (outside - inside) / max(inside, outside))
    df = table(spark, x, cluster=labels)
    args = ("f0", "f1"), "cluster", "id", slice_rows
    assert clustering.euclidean_silhouette(df, *args) == pytest.approx(np.mean(scores))
    assert clustering.euclidean_silhouette(df.filter("cluster = 0"), *args) == 0.0
    same = df.withColumns({"f0": F.lit(1.0), "f1": F.lit(1.0)})
    assert clustering.euclidean_silhouette(same, *args) == 0.0


def test_projection(spark):
    x = RNG.normal(0, 1, (60, 3)) @ np.diag([3.0, 1.0, 0.1])
    x -= x.mean(0)
    made = clustering.pca_projection(table(spark, x), ("f0", "f1", "f2"), keep=("id",))
    found = made.orderBy("id").select("pc1", "pc2").toPandas().to_numpy()
    _, _, axes = np.linalg.svd(x, full_matrices=False)
    np.testing.assert_allclose(np.abs(found), np.abs(x @ axes[:2].T), atol=1e-8)


@pytest.mark.parametrize(("trees", "sample"), [(100, 256), (10, 16)])
def test_isolation_forest_finds_the_strangers(spark, folder, trees, sample):
    x = RNG.normal(0, 1, (400, 3))
    x[:8] += 12
    df = table(spark, x).withColumn("k", F.col("id"))
    forest = isolation.train_isolation_forest(
        df, ("f0", "f1", "f2"), ("id", "k"), trees=trees, sample=sample, contamination=0.05
    )
    flagged = forest.transform(df).filter("prediction = 1")
    strangers = {f"p{i:04d}" for i in range(8)}
    assert strangers <= {r["id"] for r in flagged.collect()}
    assert 4 <= flagged.count() <= 40
    scored = forest.transform(df).select("id", "score")
    walked = isolation.path_lengths(df, forest.nodes(spark), ("id",), ("f0", "f1", "f2")).toPandas()
    walked["path"] = walked["depth"] + isolation.average_path(walked["size"])
    norm = len(forest.trees) * isolation.average_path(forest.sample)
    again = 2 ** -(walked.groupby("id")["path"].sum() / norm)
    assert np.allclose(again.sort_index(), scored.orderBy("id").toPandas()["score"])
    forest.save(spark, f"{folder}/forest")
    again = isolation.IsolationForest.load(spark, f"{folder}/forest")
    assert rows(again.transform(df), "id", "score") == rows(forest.transform(df), "id", "score")
    refit = isolation.train_isolation_forest(
        df.repartition(5), ("f0", "f1", "f2"), ("id", "k"), trees=trees, sample=sample
    )
    assert refit.threshold == forest.threshold


def test_a_stored_forest_walks_any_number_of_rows(spark):
    nodes = spark.createDataFrame(
        [(0, 0, "f0", 0.5, 1, 2, 9), (0, 1, None, 0.0, -1, -1, 5), (0, 2, "f1", 0.5, 3, 4, 4),
         (0, 3, None, 0.0, -1, -1, 3), (0, 4, None, 0.0, -1, -1, 1), (1, 0, None, 0.0, -1, -1, 9)],
        isolation.NODES,
    )
    df = spark.range(200).selectExpr("id", "id % 2 as f0", "id div 2 % 2 as f1")
    limit = spark.conf.get("spark.sql.cteRecursionRowLimit")
    spark.conf.set("spark.sql.cteRecursionRowLimit", "100")
    try:
        walked = isolation.path_lengths(df, nodes, ("id",), ("f0", "f1")).groupBy("tree", "depth", "size").count()
        assert rows(walked) == [(0, 1, 5, 100), (0, 2, 1, 50), (0, 2, 3, 50), (1, 0, 9, 200)]
    finally:
        spark.conf.set("spark.sql.cteRecursionRowLimit", limit)
    round_ = nodes.withColumn("low", F.when(F.col("node") == 2, 0).otherwise(F.col("low")))
    with pytest.raises(ValueError, match="circle"):
        isolation.path_lengths(df, round_, ("id",), ("f0", "f1"))


def test_the_gate_brings_no_rows_to_the_driver(spark, monkeypatch):
    df = spark.range(3000)
    assert training.train_gate(df, 101) and not training.train_gate(df.limit(100), 101)
    monkeypatch.setattr(type(df), "collect", lambda self: pytest.fail("rows collected"))
    assert training.train_gate(df, 3000) and not training.train_gate(df, 3001)


def test_request_defaults(spark):
    data = [(1.0, None, None), (2.0, 0.0, 0.0)]
    df = spark.createDataFrame(data, "pm2_5 double, temperature double, humidity double").select(
        F.lit("s").alias("sensor_id"), "*", *(F.lit(None).cast("double").alias(c) for c in
        ("pm10", "no2", "o3", "co", "so2")), F.lit(None).cast("string").alias("zone"),
    )
    made = scoring.request_features(df, as_of="2024-01-06 14:30:00")
    got = rows(made, "pm2_5", "pm10", "temperature", "humidity", "pm2_5_mean_15", "zone_enc")
    assert got == [(1.0, 0.0, 20.0, 50.0, 1.0, 0), (2.0, 0.0, 0.0, 0.0, 2.0, 0)]
    strict = scoring.request_features(df, as_of="2024-01-06 14:30:00", strict=True)
    assert rows(strict, "temperature", "humidity") == [(20.0, 50.0), (20.0, 50.0)]
    assert rows(made, "hour", "day_of_week", "is_weekend") == [(14, 5, 1), (14, 5, 1)]
    empty = scoring.score_batch(made)
    assert rows(empty, "anomaly_probability", "is_anomaly", "no2_forecast", "model_name") == [
        (None, None, None, "none")
    ] * 2


def tree_rows(spark, n=600):
    x = RNG.integers(0, 40, (n, 3)).astype(float)
    x[:, 2] = RNG.normal(0, 1, n)
    y = 3.0 * (x[:, 0] > 17) - 2.0 * (x[:, 1] < 9) + RNG.normal(0, 0.1, n)
    rows = [(*map(float, r), float(v), int(v > 1)) for r, v in zip(x, y, strict=True)]
    return spark.createDataFrame(rows, "a double, b double, c double, target double, label int").repartition(5)


@pytest.mark.parametrize("boosted", [True, False])
def test_trees_are_equal_in_one_task_and_in_the_cluster(spark, boosted):
    growth = trees.Growth(depth=4, row_sample=0.8, columns_per_tree=0.7, bootstrap=not boosted, columns_per_node=0.7)
    data = trees.bin_rows(tree_rows(spark), ("a", "b", "c"), "target" if boosted else "label", bins=32)
    here = trees.grow_trees(data, 4, growth, boosted)
    spread = trees.grow_trees(data, 4, growth, boosted, task_rows=0, keep_every=2)
    assert here == spread and any(len(t["feature"]) > 7 for t in here)


def test_boosting_sums_the_smaller_child_of_a_node_over_parts_of_equal_size(spark, monkeypatch):
    rows_ = tree_rows(spark, 900).coalesce(1).union(tree_rows(spark, 5).limit(0)).cache()  # most parts are empty
    growth, asked = trees.Growth(depth=4, row_sample=0.8, columns_per_tree=0.7), []
    data = trees.bin_rows(rows_, ("a", "b", "c"), "target", bins=32)
    parts = [sum(len(b[2]) for b in part) for part in trees._blocks(data, 0.0).glom().collect()]
    assert sum(parts) == 900 and max(parts) <= min(parts) + len(parts)
    kept = trees._sums_of
    monkeypatch.setattr(trees, "_sums_of", lambda *a: asked.append(list(a[3])) or kept(*a))
    spread = trees.grow_trees(data, 3, growth, boosted=True, task_rows=0)
    assert spread == trees.grow_trees(data, 3, growth, boosted=True)
    assert sum(map(len, asked)) == sum(1 + sum(1 for f in _split_above(t, 3) if f >= 0) for t in spread)
    monkeypatch.setattr(trees, "PARTS_GATHERED", 0)  # sums of many parts meet in tasks
    assert trees.grow_trees(data, 3, growth, boosted=True, task_rows=0, keep_every=2) == spread


def _split_above(tree, depth):
    """The features of the nodes above a depth."""
    above, level = [], [0]
    for _ in range(depth):
        above += [tree["feature"][n] for n in level]
        level = [tree[side][n] for n in level if tree["feature"][n] >= 0 for side in ("left", "right")]
    return above


def test_columns_are_described_in_a_task_each(spark, monkeypatch):
    x = RNG.integers(0, 500, (2000, 2)).astype(float)
    df = table(spark, x, target=x[:, 0] - 250).repartition(7).withColumn("f1", F.nullif("f1", F.lit(3.0)))
    values = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in ("f0", "f1")}
    stats = trees._column_stats(df, values, F.col("target"), [0.25, 0.5, 0.75])
    x[x[:, 1] == 3, 1] = 0
    for k in range(2):
        assert stats[k]["q"] == [np.sort(x[:, k])[i] for i in (499, 999, 1499)]
        assert abs(stats[k]["d"] / len(np.unique(x[:, k])) - 1) < 0.2
    y = x[:, 0] - 250
    assert (stats[-1]["n"], stats[-1]["most"], stats[-1]["whole"]) == (2000, np.abs(y).max(), 1)
    assert stats[-1]["mean"] == pytest.approx(y.mean())
    nothing = trees._column_stats(df.limit(0), values, F.col("target"), [0.5])
    assert nothing[-1]["n"] == 0 and nothing[0]["q"] is None


@pytest.mark.parametrize("fit, target", [(models.train_ridge, "target"), (models.train_logistic, "label")])
def test_a_fit_computes_its_rows_once(spark, fit, target):
    read = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(value):
        read.add(1)
        return value

    rows_ = tree_rows(spark).withColumn("a", counted.asNondeterministic()("a"))
    fit(rows_, ("a", "b", "c"), target)
    assert read.value == 600


def test_a_forest_ships_a_number_per_cell_and_looks_up_values_once(spark, monkeypatch):
    rows_ = tree_rows(spark)
    looked = []
    kept = trees._distinct_values
    monkeypatch.setattr(trees, "_distinct_values", lambda *a: looked.append(a) or kept(*a))
    data = trees.bin_rows(rows_, ("a", "b", "c"), "label", bins=64)
    assert len(looked) == 1 and sorted(looked[0][1]) == [0, 1] and [len(c) for c in data.cuts][:2] == [39, 39]
    growth = trees.Growth(depth=5, reg=0.0, least_rows_to_split=5, step=1.0, bootstrap=True, columns_per_node=0.7)
    got = [np.array(c) for c in zip(*((r.key, r.y) for r in data.rows.collect()), strict=True)]
    bins = np.stack([np.frombuffer(r.x, np.uint8) for r in data.rows.collect()])
    args = (bins, *got, 0.0, 3, growth, data.cuts, data.size, data.scale, False)
    plain = trees._grow_here(*args)
    monkeypatch.setattr(trees, "_level", None)  # the packed sums do
    assert trees.grow_trees(data, 3, growth, boosted=False, task_rows=0) == plain
    assert trees.grow_trees(data, 3, growth, boosted=False) == plain and len(plain[0]["feature"]) > 7
    assert not trees.bin_rows(rows_, ("a", "b"), "target").signs


def test_rows_walk_to_the_node_their_values_lead_to():
    tree = {"feature": [1, -1, 0, -1, -1], "bin": [3, 0, 5, 0, 0], "threshold": [3.5, 0, 5.5, 0, 0],
            "left": [1, 0, 3, 0, 0], "right": [2, 0, 4, 0, 0]}
    bins = np.array([[5, 4], [6, 4], [0, 3], [255, 0]], np.uint8)
    assert trees.nodes_of(tree, bins).tolist() == [3, 4, 1, 1]
    assert trees.nodes_of(tree, bins, rows=np.array([1, 3])).tolist() == [4, 1]
    raw = np.array([[5.5, 9], [np.nan, 9], [0, np.nan], [0, 3.5]])
    assert trees.nodes_of(tree, raw, "threshold").tolist() == [3, 4, 3, 1]


def test_sums_of_a_node_are_those_of_its_own_columns():
    bins, slot = RNG.integers(0, 8, (500, 4)).astype(np.uint8), RNG.integers(0, 3, 500)
    g, w = RNG.integers(-99, 99, 500), RNG.integers(1, 4, 500)
    whole = trees.histograms(bins, slot, g, w, np.arange(3), 8)
    for columns in (np.array([[0, 2], [1, 3], [0, 3]]), np.array([[1, 2]] * 3)):
        sums = trees._node_sums(bins, slot, g, w, columns, 8)
        for node, own in enumerate(columns):
            assert (sums[:, node] == whole[:, node, own]).all()


def test_nodes_below_the_least_size_are_not_split(spark):
    rows = tree_rows(spark, 60)
    data = trees.bin_rows(rows, ("a", "b", "c"), "target")
    growth = trees.Growth(depth=10, reg=0.0, least_hessian=0.0, least_rows_to_split=20)
    (tree,) = trees.grow_trees(data, 1, growth, boosted=False)
    bins = np.stack([np.frombuffer(r.x, np.uint8) for r in data.rows.collect()])
    at = trees.nodes_of(tree, bins)
    inside = {n for n, f in enumerate(tree["feature"]) if f >= 0}
    sizes = {n: int((at == n).sum()) for n in range(len(tree["feature"])) if n not in inside}
    for n in sorted(inside, reverse=True):
        sizes[n] = sizes[tree["left"][n]] + sizes[tree["right"][n]]
    assert sizes[0] == 60 and min(sizes[n] for n in inside) >= 20 and len(inside) > 1


def test_boosting_learns_and_names_the_planted_features(spark, folder):
    rows_ = tree_rows(spark)
    model = models.train_boosted_trees(rows_, ("a", "b", "c"), rounds=60, depth=3)
    assert models.evaluate_forecaster(model, rows_).first()["r2"] > 0.95
    order = [r["feature"] for r in models.feature_importances(spark, model).collect()]
    assert order == ["a", "b", "c"]
    model.write().overwrite().save(f"{folder}/model")
    again = PipelineModel.load(f"{folder}/model")
    same = models.transform(again, rows_).select("prediction").collect()
    assert same == models.transform(model, rows_).select("prediction").collect()


def test_a_forest_gives_shares_and_planted_importances(spark):
    rows_ = tree_rows(spark)
    model = models.train_random_forest(rows_, ("a", "b", "c"), trees=40, depth=5)
    assert models.evaluate_classifier(model, rows_).first()["f1"] > 0.9
    assert models.feature_importances(spark, model).first()["feature"] == "a"


def test_quantile_cuts_and_constant_features(spark):
    rows_ = tree_rows(spark).withColumn("same", F.lit(1.0))
    data = trees.bin_rows(rows_, ("c", "same", "a"), "target", bins=16)
    assert [len(c) for c in data.cuts][1] == 0 and 10 <= len(data.cuts[0]) <= 15
    assert trees.grow_trees(trees.bin_rows(rows_.limit(0), ("a",), "target"), 2, trees.Growth(), True) == [
        trees.new_tree(), trees.new_tree(),
    ]
