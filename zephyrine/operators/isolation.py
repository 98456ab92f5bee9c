"""Isolation forest.

Spark draws the rows of every tree and groups them by tree; a task sees one tree's sample, at
most a few hundred rows.  Scoring walks the small fitted trees over Arrow batches.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from zephyrine.operators.features import CLASSIFIER_FEATURES
from zephyrine.session import cut_lineage

_TREE_SCHEMA = (
    "tree int, feature array<int>, cut array<double>, low array<int>, high array<int>, size array<int>"
)
NODES = "tree int, node int, feature string, cut double, low int, high int, size int"
_FOREST_SCHEMA = "columns array<string>, sample int, threshold double"
_EULER = 0.5772156649015329


def average_path(n) -> np.ndarray:
    """Mean depth of an unsuccessful search among n keys."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3.0)
    grown = 2.0 * (np.log(big - 1.0) + _EULER) - 2.0 * (big - 1.0) / big
    return np.where(n > 2, grown, np.where(n == 2, 1.0, 0.0))


def _grow(rows: np.ndarray, rng: np.random.Generator, limit: int) -> dict[str, list]:
    """Random cuts until a node holds one distinct row or the depth limit is reached."""
    nodes: dict[str, list] = {k: [] for k in ("feature", "cut", "low", "high", "size")}

    def add(members: np.ndarray) -> int:
        for name, value in (
            ("feature", -1), ("cut", 0.0), ("low", -1), ("high", -1), ("size", len(members))
        ):
            nodes[name].append(value)
        return len(nodes["feature"]) - 1

    waiting = [(add(rows), rows, 0)]
    while waiting:
        node, members, depth = waiting.pop()
        spread = np.flatnonzero(members.max(axis=0) > members.min(axis=0))
        if depth >= limit or len(members) < 2 or not len(spread):
            continue
        feature = int(rng.choice(spread))
        values = members[:, feature]
        cut = float(rng.uniform(values.min(), values.max()))
        below = values <= cut
        nodes["feature"][node], nodes["cut"][node] = feature, cut
        for side, part in (("low", members[below]), ("high", members[~below])):
            child = add(part)
            nodes[side][node] = child
            waiting.append((child, part, depth + 1))
    return nodes


@dataclass
class IsolationForest:
    columns: tuple[str, ...]
    trees: list[dict[str, np.ndarray]] = field(repr=False)
    sample: int
    threshold: float = math.nan

    def score(self) -> Column:
        """Anomaly score in 0..1 as a column; larger is stranger."""
        trees, norm = self.trees, float(average_path(self.sample)) or 1.0

        @pandas_udf("double")
        def scores(values: pd.Series) -> pd.Series:
            if not len(values):
                return pd.Series([], dtype=float)
            rows = np.stack(values.to_numpy())
            depth = np.zeros(len(rows))
            for t in trees:
                at = np.zeros(len(rows), dtype=np.int64)
                steps = np.zeros(len(rows))
                moving = t["feature"][at] >= 0
                while moving.any():
                    here = at[moving]
                    left = rows[moving, t["feature"][here]] <= t["cut"][here]
                    at[moving] = np.where(left, t["low"][here], t["high"][here])
                    steps[moving] += 1
                    moving = t["feature"][at] >= 0
                depth += steps + average_path(t["size"][at])
            return pd.Series(np.exp2(-depth / len(trees) / norm))

        return scores(_row_of(self.columns))

    def nodes(self, spark: SparkSession) -> DataFrame:
        """The forest as a table (tree, node, feature, cut, low, high, size); a leaf's feature is null."""
        rows = [
            (i, n, self.columns[f] if f >= 0 else None, *(t[k][n].item() for k in ("cut", "low", "high", "size")))
            for i, t in enumerate(self.trees)
            for n, f in enumerate(t["feature"].tolist())
        ]
        return spark.createDataFrame(rows, NODES)

    @classmethod
    def of_nodes(cls, nodes: DataFrame, columns: tuple[str, ...], sample: int) -> IsolationForest:
        """The forest a table of nodes describes; nodes are numbered from 0, the root, in every tree."""
        found: dict[int, list[Row]] = {}
        for row in nodes.orderBy("tree", "node").collect():  # trees * 2 * sample nodes at most
            found.setdefault(row["tree"], []).append(row)
        trees = [
            {
                "feature": np.array([columns.index(r["feature"]) if r["feature"] else -1 for r in rows]),
                "cut": np.array([r["cut"] or 0.0 for r in rows]),
                **{k: np.array([r[k] for r in rows], np.int64) for k in ("low", "high", "size")},
            }
            for rows in found.values()
        ]
        return cls(tuple(columns), trees, sample)

    def fit_threshold(self, df: DataFrame, contamination: float = 0.05) -> IsolationForest:
        """Take the ``1 - contamination`` quantile of the scores of ``df`` as the threshold."""
        cut = df.select(self.score().alias("score")).agg(
            F.percentile_approx("score", 1.0 - contamination, 10_000).alias("cut")
        )
        self.threshold = cut.first()["cut"]
        return self

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [
            (i, *(t[k].tolist() for k in ("feature", "cut", "low", "high", "size")))
            for i, t in enumerate(self.trees)
        ]
        trees = spark.createDataFrame(rows, _TREE_SCHEMA)
        about = spark.createDataFrame(
            [(list(self.columns), self.sample, self.threshold)], _FOREST_SCHEMA
        )
        for part, df in (("trees", trees), ("about", about)):
            df.coalesce(1).write.mode("overwrite").option(
                "partitionOverwriteMode", "static"
            ).parquet(f"{path}/{part}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> IsolationForest:
        about = spark.read.schema(_FOREST_SCHEMA).parquet(f"{path}/about").first()
        rows = spark.read.schema(_TREE_SCHEMA).parquet(f"{path}/trees").orderBy("tree").collect()
        return cls(
            tuple(about["columns"]), [_arrays(r) for r in rows], about["sample"], about["threshold"]
        )

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``score`` and ``prediction`` (1 = anomaly)."""
        scored = df.withColumn("score", self.score())
        return scored.withColumn(
            "prediction", (F.col("score") > F.lit(self.threshold)).cast("double")
        )


def _arrays(row: Row) -> dict[str, np.ndarray]:
    return {
        name: np.array(row[name], dtype=float if name == "cut" else np.int64)
        for name in ("feature", "cut", "low", "high", "size")
    }


def _row_of(columns: tuple[str, ...]) -> Column:
    return F.array(*(F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns))


def draw_samples(
    df: DataFrame, columns: tuple[str, ...], key: tuple[str, ...], trees: int, sample: int, seed: int
) -> DataFrame:
    """Rows (tree, row) with ``sample`` rows per tree, chosen by a hash of key and tree.

    A tree looks at the rows whose hash is among the lowest ``4 * sample / total`` of all hashes,
    four times as many as it needs, and takes the lowest of them.  Small and large inputs are
    drawn alike; a row is copied only to the trees that look at it.
    """
    total = df.count()
    bound = min(1.0, 4.0 * sample / max(total, 1)) * 1e9
    draws = F.transform(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda tree: F.struct(
            tree.alias("tree"),
            F.pmod(F.xxhash64(*key, tree, F.lit(seed)), F.lit(1_000_000_000)).alias("draw"),
        ),
    )
    looked = df.select(
        _row_of(columns).alias("row"),
        *key,
        F.explode(F.filter(draws, lambda d: d["draw"] < math.ceil(bound))).alias("d"),
    )
    drawn = looked.select("row", *key, "d.tree", "d.draw")
    ranked = Window.partitionBy("tree").orderBy("draw", *key)
    return (
        drawn.withColumn("_rank", F.row_number().over(ranked))
        .filter(F.col("_rank") <= sample)
        .select("tree", "row")
    )


def train_isolation_forest(
    df: DataFrame,
    columns: tuple[str, ...] = CLASSIFIER_FEATURES,
    key: tuple[str, ...] = ("sensor_id", "timestamp"),
    trees: int = 100,
    sample: int = 256,
    contamination: float = 0.05,
    seed: int = 42,
) -> IsolationForest:
    """The threshold is the ``1 - contamination`` quantile of the training scores."""
    used = tuple(c for c in columns if c in df.columns)
    limit = max(1, math.ceil(math.log2(sample)))

    def grow(frame: pd.DataFrame) -> pd.DataFrame:
        tree = int(frame["tree"].iloc[0])
        rows = np.stack(frame["row"].to_numpy())
        rows = rows[np.lexsort(rows.T)]  # arrival order must not matter
        nodes = _grow(rows, np.random.default_rng([seed, tree]), limit)
        return pd.DataFrame({"tree": [tree], **{k: [v] for k, v in nodes.items()}})

    fitted = (
        draw_samples(df, used, key, trees, sample, seed)
        .groupBy("tree")
        .applyInPandas(grow, _TREE_SCHEMA)
        .orderBy("tree")
        .collect()  # trees * 2 * sample nodes at most
    )
    grown = [_arrays(r) for r in fitted]
    drawn = max((int(t["size"][0]) for t in grown), default=1)
    return IsolationForest(used, grown, drawn).fit_threshold(df, contamination)


def _height(nodes: DataFrame) -> int:
    """The most steps from a root to a leaf in a table of nodes, found a level at a time."""
    held = cut_lineage(nodes.filter("feature is not null").select("tree", "node", "low", "high"))
    inner = held.count()  # a path of more steps would meet a node twice
    children = held.select("tree", F.explode(F.array("low", "high")).alias("node")).join(held, ["tree", "node"])
    level, steps = held.filter("node = 0"), 0
    while not level.isEmpty():
        steps += 1
        if steps > inner:
            raise ValueError("the nodes of a tree form a circle")
        below = level.select("tree", F.explode(F.array("low", "high")).alias("node"))
        level = cut_lineage(children.join(below, ["tree", "node"], "left_semi"))
    return steps


def path_lengths(df: DataFrame, nodes: DataFrame, key: tuple[str, ...], columns: tuple[str, ...]) -> DataFrame:
    """(key, tree, depth, size): the leaf every row reaches in every tree of a table of nodes, by a join per level.

    For forests kept as tables, beside other tables; ``IsolationForest.score`` walks the same trees in one pass.
    The joins follow each other without a table in between, as many as the highest tree has levels.
    """
    values = F.map_from_arrays(F.array(*map(F.lit, columns)), _row_of(columns))
    roots = nodes.select("tree").distinct()
    walk = df.select(*key, values.alias("_values")).crossJoin(roots)
    walk = walk.withColumns({"node": F.lit(0), "depth": F.lit(0)})
    step = nodes.select("tree", "node", "feature", "cut", "low", "high")
    inner = F.col("feature").isNotNull()
    side = F.when(F.col("_values")[F.col("feature")] <= F.col("cut"), F.col("low")).otherwise(F.col("high"))
    for _ in range(_height(nodes)):
        walk = walk.join(step, ["tree", "node"]).select(
            *key, "_values", "tree", F.when(inner, side).otherwise(F.col("node")).alias("node"),
            (F.col("depth") + inner.cast("int")).alias("depth"),
        )
    leaves = nodes.filter(~inner).select("tree", "node", "size")
    return walk.join(leaves, ["tree", "node"]).select(*key, "tree", "depth", "size")
