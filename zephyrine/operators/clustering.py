"""Clustering of sensor profiles: k-means, density clusters, silhouette, projection."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zephyrine.operators import spaces
from zephyrine.operators.components import connected_components
from zephyrine.operators.features import scale_features
from zephyrine.operators.summaries import PROFILE_FEATURES
from zephyrine.session import cut_lineage

NOISE = "-1"
#: Slices that all points are dealt into for tiles of distances, unless a slice would have more than so many rows.
SLICES, SLICE_MOST = 64, 1 << 16
#: Distances of a tile that are computed at once; they stay in a processor's cache.
TILE_BLOCK = 1 << 16


def _vectors(df: DataFrame, columns: tuple[str, ...], name: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=name).transform(df)


def train_kmeans(
    scaled: DataFrame,
    columns: tuple[str, ...] = PROFILE_FEATURES,
    k: int = 4,
    restarts: int = 10,
    seed: int = 42,
) -> KMeansModel:
    """Best of several starts by within-cluster cost; expects scaled columns."""
    points = cut_lineage(_vectors(scaled, columns).select("features"))
    fits = [KMeans(k=k, seed=seed + i).fit(points) for i in range(restarts)]
    return min(fits, key=lambda m: m.summary.trainingCost)


def kmeans_sensors(
    profiles: DataFrame,
    columns: tuple[str, ...] = PROFILE_FEATURES,
    k: int = 4,
    restarts: int = 10,
    seed: int = 42,
) -> tuple[DataFrame, KMeansModel]:
    """(profiles with their cluster, the model)."""
    scaled = scale_features(profiles, columns)
    model = train_kmeans(scaled, columns, k, restarts, seed)
    assigned = model.setPredictionCol("cluster").transform(_vectors(scaled, columns))
    return profiles.join(assigned.select("sensor_id", "cluster"), "sensor_id"), model


def silhouette(df: DataFrame, columns: tuple[str, ...], cluster: str = "cluster") -> float:
    """Mean silhouette under squared Euclidean distance; 0 for a single cluster.

    The squared distance lets the mean distance to a cluster follow from its sums, so no pair of
    points is formed.
    """
    if len(df.select(cluster).distinct().limit(2).collect()) < 2:
        return 0.0
    points = _vectors(df.withColumn("_p", F.col(cluster).cast("double")), columns)
    return ClusteringEvaluator(predictionCol="_p", featuresCol="features").evaluate(points)


def slices_of(total: int, slice_rows: int) -> int:
    return max(1, min(-(-total // slice_rows), SLICES), -(-total // SLICE_MOST))


def euclidean_silhouette(
    df: DataFrame,
    columns: tuple[str, ...],
    cluster: str = "cluster",
    key: str = "sensor_id",
    slice_rows: int = 8192,
) -> float:
    """Mean silhouette under the plain Euclidean distance; 0 for a single cluster, noise counts as one more.

    The points are dealt into slices of about ``slice_rows`` by a hash of the key, but at most ``SLICES`` slices, so
    that a point is not copied more often the more points there are; only beyond ``SLICE_MOST`` rows in each are there
    more.  Every pair of slices is a tile, in which a task sums each point's distances to the points of every cluster
    of the other slice.  Only these sums leave a tile, never a pair, and a task holds two slices.  The work is that of
    all distances, which this measure asks for; it is the same path at every size.
    """
    names = [f"x{i}" for i in range(len(columns))]
    points = cut_lineage(
        df.select(
            F.col(key).cast("string").alias("id"),
            F.col(cluster).cast("string").alias("cluster"),
            *(F.col(c).cast("double").alias(x) for c, x in zip(columns, names, strict=True)),
        )
    )
    total, clusters = points.agg(F.count("*"), F.approx_count_distinct("cluster")).first()
    if clusters < 2 and len(points.select("cluster").distinct().limit(2).collect()) < 2:
        return 0.0
    slices = slices_of(total, slice_rows)
    own = F.pmod(F.xxhash64("id"), F.lit(slices)).cast("int")
    sliced = points.withColumn("own", own)
    left = sliced.withColumns({"row": F.col("own"), "column": F.explode(F.sequence("own", F.lit(slices - 1)))})
    right = sliced.withColumns({"row": F.explode(F.sequence(F.lit(0), "own")), "column": F.col("own")})

    def grouped(t: pa.Table) -> tuple[pa.Table, pa.Array, np.ndarray, np.ndarray]:
        """The rows by cluster, the clusters, where each begins, and the coordinates."""
        label = t.column("cluster").combine_chunks().dictionary_encode()
        member = label.indices.to_numpy()
        order = np.argsort(member, kind="stable")
        t = t.take(pa.array(order))
        return t, label.dictionary, np.searchsorted(member[order], np.arange(len(label.dictionary))), spaces.matrix(t, names)

    def told(t: pa.Table, others: pa.Array, sums: np.ndarray) -> pa.Table:
        rows = np.repeat(np.arange(len(sums)), len(others))
        return pa.table(
            {
                "id": t.column("id").take(pa.array(rows)),
                "cluster": t.column("cluster").take(pa.array(rows)),
                "other": others.take(pa.array(np.tile(np.arange(len(others)), len(sums)))),
                "total": pa.array(sums.ravel()),
            }
        )

    def tile(at: tuple[pa.Scalar, ...], a: pa.Table, b: pa.Table) -> pa.Table:
        (a, mine, _, x), (b, others, begins, y) = grouped(a), grouped(b)
        member = np.zeros(0, int)
        if len(x):
            member = a.column("cluster").combine_chunks().dictionary_encode().indices.to_numpy()
        across = np.zeros((len(x), len(others)))
        down = np.zeros((len(mine), len(y)))
        step = max(1, TILE_BLOCK // max(len(y), 1))
        axes = np.ascontiguousarray(y.T)
        total, gaps = np.empty((step, len(y))), np.empty((step, len(y)))
        for k in range(0, len(x) if len(y) else 0, step):
            part = x[k : k + step]
            distance, gap = total[: len(part)], gaps[: len(part)]
            distance[:] = 0
            for axis, other in enumerate(axes):
                np.subtract(part[:, axis, None], other, out=gap)
                np.multiply(gap, gap, out=gap)
                distance += gap
            np.sqrt(distance, out=distance)
            across[k : k + step] = np.add.reduceat(distance, begins, axis=1)
            held, first = np.unique(member[k : k + step], return_index=True)
            down[held] += np.add.reduceat(distance, first, axis=0)
        found = told(a, others, across)
        return found if at[0] == at[1] else pa.concat_tables([found, told(b, mine, down.T)])

    met = left.drop("own").groupBy("row", "column").cogroup(right.drop("own").groupBy("row", "column"))
    sums = met.applyInArrow(tile, "id string, cluster string, other string, total double")
    sums = sums.groupBy("id", "cluster", "other").agg(F.sum("total").alias("total"))
    sizes = points.groupBy(F.col("cluster").alias("other")).agg(F.count("*").alias("n"))
    mine = F.col("cluster") == F.col("other")
    per_point = (
        sums.join(sizes, "other")
        .groupBy("id")
        .agg(
            F.max(F.when(mine & (F.col("n") > 1), F.col("total") / (F.col("n") - 1))).alias("inside"),
            F.min(F.when(~mine, F.col("total") / F.col("n"))).alias("outside"),
        )
    )
    most = F.greatest("inside", "outside")
    value = F.when(F.col("inside").isNull() | (most == 0), 0.0).otherwise((F.col("outside") - F.col("inside")) / most)
    return float(per_point.agg(F.avg(value)).first()[0])


def silhouette_of_names(
    df: DataFrame, columns: tuple[str, ...], cluster: str = "cluster"
) -> float:
    """The same for clusters with text names; noise counts as one more cluster."""
    numbered = StringIndexer(inputCol=cluster, outputCol="_number").fit(df).transform(df)
    return silhouette(numbered, columns, "_number")


def pca_projection(
    df: DataFrame, columns: tuple[str, ...], k: int = 2, keep: tuple[str, ...] = ("sensor_id",)
) -> DataFrame:
    """Coordinates on the first principal axes; expects centred columns."""
    points = _vectors(df, columns)
    model = PCA(k=k, inputCol="features", outputCol="_pc").fit(points)
    axes = vector_to_array("_pc")
    return model.transform(points).select(
        *keep, *(axes[i].alias(f"pc{i + 1}") for i in range(k))
    )


# --- density clusters ------------------------------------------------------------------


def _square(c: Column) -> Column:
    return c * c


def _total(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts)


def dbscan(
    df: DataFrame,
    columns: tuple[str, ...],
    key: str = "sensor_id",
    eps: float = 0.8,
    min_samples: int = 3,
    part_cells: int = 4096,
    tile_rows: int = 1 << 15,
) -> DataFrame:
    """Exact density clustering: (key, cluster, is_core).

    A cluster is named by its smallest core key, noise is ``-1``; a border point takes the
    smallest cluster in reach.  ``min_samples`` counts the point itself.

    Space is cut into cells whose diagonal is below ``eps``.  Points sharing a cell are
    neighbours by construction, so pairs inside a cell are never formed, and a cell with
    ``min_samples`` points, a dense one, consists of core points.

    Cells meet in the parts of a split tree of about ``part_cells`` cells each.  A part also gets the cells
    within ``eps`` of its box.  A part's own rows face all rows of the part in tiles of about ``tile_rows`` on each side,
    and a task holds one tile, however many rows lie within ``eps`` of a part.  No pair of cells or points is written but those
    of the last step below; what leaves a tile grows with its rows.

    - Cells whose points all lie within ``eps`` of those of a dense cell consist of core points: they are anchored, and a
      tile links them by their bounds, one link per cell.
    - Points of the other sparse cells, which are few, count their neighbours in sparse cells and, by component, in dense
      ones.
    - Core points of sparse cells are linked and border points attached, one link per cell of a tile.
    - Anchored cells in reach that are not connected yet, one of them dense, leave the tile as pairs; their points are
      joined.
    """
    names = [f"x{i}" for i in range(len(columns))]
    side = eps / math.sqrt(len(columns)) * (1 - 1e-9)
    points = df.select(
        F.col(key).cast("string").alias("id"),
        *(F.col(c).cast("double").alias(x) for c, x in zip(columns, names, strict=True)),
    )
    cell = F.concat_ws(",", *(F.floor(F.col(x) / F.lit(side)).cast("string") for x in names))
    points = cut_lineage(points.withColumns({"cell": cell, "row_no": F.monotonically_increasing_id()}))

    cells = cut_lineage(
        points.groupBy("cell").agg(
            F.count("*").alias("n"),
            *(F.min(x).alias(f"lo_{x}") for x in names),
            *(F.max(x).alias(f"hi_{x}") for x in names),
        )
    )
    tree = spaces.fit_tree(cells, names, side, part_cells)
    placed = cut_lineage(spaces.place_cells(cells, names, tree, eps))
    few = F.col("n") < min_samples
    sparse = points.join(cells.filter(few).select("cell"), "cell")
    anchored = _anchored_cells(cells.filter(~few), spaces.whole_links(placed, names, eps, min_samples, tile_rows))
    known = cut_lineage(placed.join(anchored, "cell", "left"))
    asks = F.col("own") & F.col("component").isNull()
    seen = spaces.sparse_neighbours(known.filter(few).withColumn("own", asks), sparse, names, eps, tile_rows)
    near = cut_lineage(
        spaces.dense_near(known.filter(~few | asks).withColumn("own", asks), names, eps, min_samples, tile_rows)
    )
    dense = points.join(cells.filter(~few).select("cell"), "cell")
    facing = cut_lineage(spaces.dense_neighbours(known.filter(asks), sparse, near, dense, names, eps, tile_rows))

    core = cut_lineage(_core_points(points, cells, anchored, facing, seen, min_samples))
    flagged = sparse.join(core.select("id", F.lit(True).alias("core")), "id", "left")
    links, attached = spaces.sparse_links(known.filter(few), flagged, names, eps, tile_rows)
    pairs = spaces.apart_pairs(known.filter("component is not null"), names, eps, min_samples, tile_rows)
    linked = _cell_clusters(core, anchored, pairs, links, facing, names, eps)
    border = _border_points(points, core, linked, facing, attached)
    core_labels = core.join(linked, "cell")
    named = core_labels.groupBy("component").agg(F.min("id").alias("cluster"))
    settled = (
        core_labels.select("id", "component", F.lit(True).alias("is_core"))
        .unionByName(border.withColumn("is_core", F.lit(False)))
        .join(named, "component")
        .groupBy("id")
        .agg(F.min("cluster").alias("cluster"), F.bool_or("is_core").alias("is_core"))
    )
    return points.select("id").join(settled, "id", "left").select(
        F.col("id").alias(key),
        F.coalesce("cluster", F.lit(NOISE)).alias("cluster"),
        F.coalesce("is_core", F.lit(False)).alias("is_core"),
    )


def _near_points(
    points: DataFrame, pairs: DataFrame, others: DataFrame, names: list[str], eps: float
) -> DataFrame:
    """(id, cell, other, other_id) for points of paired cells at most ``eps`` apart."""
    outside = _total(
        [
            _square(
                F.greatest(
                    F.lit(0.0), F.col(f"o_lo_{x}") - F.col(x), F.col(x) - F.col(f"o_hi_{x}")
                )
            )
            for x in names
        ]
    )
    limit = F.lit(eps * eps)
    facing = points.join(pairs, "cell").filter(outside <= limit).select(
        "id", "cell", "other", *names
    )
    target = others.select(
        F.col("id").alias("other_id"),
        F.col("cell").alias("other"),
        *(F.col(x).alias(f"o_{x}") for x in names),
    )
    distance = _total([_square(F.col(x) - F.col(f"o_{x}")) for x in names])
    return facing.join(target, "other").filter(distance <= limit)


def _anchored_cells(dense: DataFrame, links: DataFrame) -> DataFrame:
    """(cell, component) of the dense cells and of those that are linked to one by their bounds."""
    found = connected_components(cut_lineage(links)).withColumnRenamed("node", "cell")
    every = dense.select("cell").union(found.select("cell")).distinct()
    return cut_lineage(
        every.join(found, "cell", "left").withColumn("component", F.coalesce("component", "cell"))
    )


def _core_points(
    points: DataFrame,
    cells: DataFrame,
    anchored: DataFrame,
    facing: DataFrame,
    sparse_seen: DataFrame,
    min_samples: int,
) -> DataFrame:
    sure = points.join(anchored.select("cell"), "cell", "left_semi")
    rest = points.join(cells.select("cell", "n"), "cell").join(anchored.select("cell"), "cell", "left_anti")
    seen = facing.groupBy("id").agg(F.sum("n").alias("seen_n"))
    others = [F.coalesce(c, F.lit(0)) for c in ("seen_n", "sparse_n")]
    promoted = (
        rest.join(seen, "id", "left")
        .join(sparse_seen, "id", "left")
        .filter(F.col("n") + others[0] + others[1] >= min_samples)
    )
    return sure.select(*points.columns).unionByName(promoted.select(*points.columns))


def _cell_clusters(
    core: DataFrame,
    anchored: DataFrame,
    pairs: DataFrame,
    links: DataFrame,
    facing: DataFrame,
    names: list[str],
    eps: float,
) -> DataFrame:
    """(cell, component) for the cells that hold core points."""
    cells = core.select("cell").distinct()
    undecided = cut_lineage(pairs.filter(F.col("cell") < F.col("other")))
    touching = _near_points(core, undecided, core, names, eps).select(F.col("cell").alias("u"), F.col("other").alias("v"))
    seen = core.select("id", F.col("cell").alias("u")).join(facing, "id").select("u", F.col("component").alias("v"))
    edges = links.select("u", "v").union(touching).union(seen).distinct()
    # Anchored cells stand for their component, so that only what joins components is left.
    for end in ("u", "v"):
        label = anchored.select(F.col("cell").alias(end), "component")
        edges = edges.join(label, end, "left").withColumn(end, F.coalesce("component", end)).drop("component")
    found = connected_components(cut_lineage(edges.select("u", "v").distinct()))
    first = cells.join(anchored, "cell", "left").withColumn("node", F.coalesce("component", "cell"))
    linked = first.select("cell", "node").join(found, "node", "left")
    return cut_lineage(linked.select("cell", F.coalesce("component", "node").alias("component")))


def _border_points(
    points: DataFrame, core: DataFrame, linked: DataFrame, facing: DataFrame, attached: DataFrame
) -> DataFrame:
    """(id, component) for every cluster a non-core point can join."""
    rest = points.join(core.select("id"), "id", "left_anti")
    same = rest.join(linked, "cell").select("id", "component")
    near = rest.select("id").join(facing.select("id", F.col("component").alias("cell")), "id").join(linked, "cell")
    sparse = attached.join(linked, "cell").select("id", "component")
    return same.unionByName(near.select("id", "component")).unionByName(sparse).distinct()
