"""Connected components of an edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zephyrine.session import cut_lineage


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); component = smallest node.

    Alternates the large-star and small-star steps of Kiveris et al. (2014), which need a
    logarithmic number of rounds.  Each step is a minimum per node and a join; every round is
    checkpointed, and the rounds end when one changes nothing.
    """
    current = cut_lineage(
        edges.filter("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    nodes = edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct()
    seen = _fingerprint(current)
    settled = False
    while not settled:
        current = cut_lineage(_small_star(_large_star(current)))
        now = _fingerprint(current)
        settled, seen = now == seen, now
    # Settled: every edge points from a node straight at its component's smallest node.
    found = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.join(found, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )


def _fingerprint(edges: DataFrame) -> tuple:
    mark = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(mark)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return (
        both.join(lowest, "u")
        .filter("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = edges.join(lowest, "u")
    onward = linked.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return onward.union(lowest.select("u", F.col("m").alias("v"))).distinct()
