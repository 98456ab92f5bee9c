"""Regression trees grown from histograms: boosting and forests over binned features.

Values are binned at quantiles once.  A level of the trees needs one aggregate: the summed gradient, hessian and
number of rows per (tree, node, feature, bin).  The best split of a node maximises

    GL^2 / (HL + reg) + GR^2 / (HR + reg) - G^2 / (H + reg)

and a leaf's value is ``-G / (H + reg)``.  Gradients are summed as whole numbers (fixed point), so sums are exact and
a model does not depend on how its rows are spread over tasks.  Rows and columns are drawn per tree and node by hashes.

``Binned`` holds rows in the cluster; they are cached as blocks of arrays, and a level of the trees is one Spark job.  Up to ``task_rows`` rows are a bounded table of
one byte a value: one task then does the same sums over the same rows without a job per level.  Both give equal trees.
In boosting, only the smaller child of a split node is summed: the other one has the rest of the node's sums.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zephyrine.session import cut_lineage

#: Rows whose sums stay exact in doubles.
EXACT_ROWS = 1 << 16
#: Rows that walk down a tree together; what they look up stays in a core's cache.
WALK_ROWS = 1 << 14


@dataclass(frozen=True)
class Growth:
    depth: int = 6
    reg: float = 1.0
    least_hessian: float = 1.0
    least_rows_to_split: int = 2
    row_sample: float = 1.0
    bootstrap: bool = False
    columns_per_tree: float = 1.0
    columns_per_node: float = 1.0
    step: float = 0.05
    seed: int = 42


# --- one tree ----------------------------------------------------------------------------
# A tree is a dict of lists by node: feature (-1 at a leaf), bin, threshold, left, right, value, gain.


def new_tree() -> dict:
    return {"feature": [-1], "bin": [0], "threshold": [0.0], "left": [0], "right": [0], "value": [0.0], "gain": [0.0]}


def nodes_of(tree: dict, bins: np.ndarray, by: str = "bin", rows: np.ndarray | None = None) -> np.ndarray:
    """The node every row of ``bins`` (or of raw values, by ``threshold``), or each of ``rows``, has reached.

    A few thousand rows at a time take a step together, in tables where a leaf leads to itself.
    """
    feature, left, right = (np.array(tree[c]) for c in ("feature", "left", "right"))
    cut, own = np.array(tree[by]).astype(bins.dtype), np.arange(len(feature))
    leaf = feature < 0
    feature = np.where(leaf, 0, feature)
    child = np.stack([np.where(leaf, own, right), np.where(leaf, own, left)], axis=1).ravel()
    flat, width = np.ascontiguousarray(bins).ravel(), bins.shape[1]
    rows = np.arange(len(bins)) if rows is None else rows
    reached = np.zeros(len(rows), np.int64)
    for k in range(0, len(rows), WALK_ROWS):
        first = rows[k : k + WALK_ROWS] * width
        at = reached[k : k + WALK_ROWS]
        while not leaf.take(at).all():
            at = child.take(2 * at + (flat.take(first + feature.take(at)) <= cut.take(at)))
        reached[k : k + WALK_ROWS] = at
    return reached


def _mixed(keys: np.ndarray, salt: int) -> np.ndarray:
    """Uniform numbers in [0, 1) from row keys and a number, by the finalizer of a 64-bit mixing hash."""
    with np.errstate(over="ignore"):
        z = keys.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) % (1 << 64))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) / (1 << 53)


def row_weights(keys: np.ndarray, tree: int, growth: Growth) -> np.ndarray:
    """How often each row counts in a tree: 0 or 1 of a sample, or about Poisson(1) of a bootstrap."""
    if growth.bootstrap:
        shares = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
        drawn = _mixed(keys, growth.seed * 1_000_003 + tree)
        times = np.zeros(len(keys), np.uint8)
        for share in shares:  # a binary search per row takes longer than these few comparisons
            times += drawn >= share
        return times.astype(np.int64)
    if growth.row_sample >= 1:
        return np.ones(len(keys), np.int64)
    return (_mixed(keys, growth.seed * 1_000_003 + tree) < growth.row_sample).astype(np.int64)


def allowed_columns(width: int, tree: int, node: int, growth: Growth) -> np.ndarray:
    """Which features a node may split on."""
    kept = np.arange(width)
    for share, numbers in ((growth.columns_per_tree, (tree,)), (growth.columns_per_node, (tree, node))):
        if share < 1:
            draw = np.random.default_rng([growth.seed, *numbers])
            kept = np.sort(draw.permutation(kept)[: max(1, int(share * width))])
    mask = np.zeros(width, bool)
    mask[kept] = True
    return mask


def histograms(
    bins: np.ndarray, at: np.ndarray, g: np.ndarray, w: np.ndarray, slots: np.ndarray, size: int
) -> np.ndarray:
    """Sums (gradient, weight, rows) per (slot, feature, bin); ``slots`` numbers the open nodes, -1 for others."""
    n = int(slots.max()) + 1
    total = np.zeros((3, n, bins.shape[1], size))
    rows = np.flatnonzero((slots[at] >= 0) & (w > 0))
    for k in range(0, len(rows), EXACT_ROWS):
        part = rows[k : k + EXACT_ROWS]
        slot, gp, wp = slots[at[part]] * size, g[part].astype(float), w[part].astype(float)
        for f in range(bins.shape[1]):
            key = slot + bins[part, f]
            total[0, :, f] += np.bincount(key, gp, n * size).reshape(n, size)
            total[1, :, f] += np.bincount(key, wp, n * size).reshape(n, size)
            total[2, :, f] += np.bincount(key, minlength=n * size).reshape(n, size)
    return total


def best_splits(sums: np.ndarray, allowed: np.ndarray, scale: float, growth: Growth):
    """Per slot (feature, bin, gain, G, H, GL, HL, rows); feature -1 where no split improves the node."""
    g, h, c = sums[0] / scale, sums[1], sums[2]
    total_g, total_h, rows = g[:, 0].sum(-1), h[:, 0].sum(-1), c[:, 0].sum(-1)
    gl, hl = g.cumsum(-1), h.cumsum(-1)
    gr, hr = total_g[:, None, None] - gl, total_h[:, None, None] - hl

    def score(a, b):
        return np.where(b > 0, a * a / np.maximum(b + growth.reg, 1e-12), 0.0)

    gain = score(gl, hl) + score(gr, hr) - score(total_g, total_h)[:, None, None]
    good = (hl >= growth.least_hessian) & (hr >= growth.least_hessian) & allowed[:, :, None]
    good &= (rows >= growth.least_rows_to_split)[:, None, None]
    flat = np.where(good, gain, -np.inf).reshape(len(gain), -1)
    best = flat.argmax(1)
    feature, place = np.divmod(best, g.shape[2])
    slot = np.arange(len(best))
    top = flat[slot, best]
    feature = np.where(top > 1e-9, feature, -1)
    return feature, place, top, total_g, total_h, gl[slot, feature, place], hl[slot, feature, place], rows


def _leaf(g: float, h: float, growth: Growth) -> float:
    return -g / (h + growth.reg) * growth.step if h + growth.reg > 0 else 0.0


def split_nodes(tree: dict, opened: list[int], found, cuts: list[list[float]], growth: Growth) -> list[int]:
    """Apply the splits to the open nodes; the nodes that are open then."""
    fresh = []
    for node, feature, place, gain, g, h, gl, hl in zip(opened, *(f.tolist() for f in found[:7]), strict=True):
        tree["value"][node] = _leaf(g, h, growth)
        if feature < 0:
            continue
        tree["feature"][node], tree["bin"][node], tree["gain"][node] = feature, place, gain
        tree["threshold"][node] = cuts[feature][place]
        for side, gs, hs in (("left", gl, hl), ("right", g - gl, h - hl)):
            tree[side][node] = len(tree["feature"])
            fresh.append(len(tree["feature"]))
            for name, value in zip(tree, (-1, 0, 0.0, 0, 0, _leaf(gs, hs, growth), 0.0), strict=True):
                tree[name].append(value)
    return fresh


def _slots(tree: dict, opened: list[int]) -> np.ndarray:
    slots = np.full(len(tree["feature"]), -1)
    slots[opened] = np.arange(len(opened))
    return slots


# --- sums of whole numbers -----------------------------------------------------------------
# If residuals are -1, 0 or 1, as a forest's are on labels 0 and 1, the sums of residuals and weights of a cell go into one
# whole number, and a node's rows are counted once.  They are unpacked where splits are chosen.

WEIGHT_BITS = 31
MOST_WEIGHT = 12  # of a row in a bootstrap
PACKED_ROWS = 1 << 17  # rows whose packed sum stays exact in doubles


def _columns(width: int, t: int, opened: list[int], growth: Growth) -> np.ndarray:
    return np.stack([np.flatnonzero(allowed_columns(width, t, node, growth)) for node in opened])


def _packed_sums(
    bins: np.ndarray, keys: np.ndarray, residual: np.ndarray, t: int, tree: dict,
    opened: list[int], columns: np.ndarray, growth: Growth, size: int,
) -> tuple[np.ndarray, np.ndarray]:
    """Packed sums per (open node, one of its ``columns``, bin) and the number of rows per open node."""
    n, k = columns.shape
    slots = _slots(tree, opened)
    alike = (columns == columns[0]).all()
    width, total, seen = bins.shape[1], np.zeros((n, k, size), np.int64), np.zeros(n, np.int64)
    for begin in range(0, len(bins), PACKED_ROWS):
        part = slice(begin, begin + PACKED_ROWS)
        x = np.ascontiguousarray(bins[part])
        flat, w = x.ravel(), row_weights(keys[part], t, growth)
        rows = np.flatnonzero(w)
        own = slots.take(nodes_of(tree, x, rows=rows))
        if (own < 0).any():
            rows, own = rows[own >= 0], own[own >= 0]
        w = w.take(rows).astype(float)
        packed = w * (residual[part].take(rows) * float(1 << WEIGHT_BITS) + 1.0)
        first, start = rows * width, own * size
        seen += np.bincount(own, minlength=n)
        for j in range(k):
            at = columns[0, j] if alike else columns[:, j].take(own)
            sums = np.bincount(start + flat.take(first + at), packed, n * size)
            total[:, j] += sums.astype(np.int64).reshape(n, size)
    return total, seen


def _unpacked_splits(
    total: np.ndarray, seen: np.ndarray, t: int, opened: list[int], columns: np.ndarray, width: int, scale: float, growth: Growth
):
    """``best_splits`` of the open nodes."""
    n, size = len(opened), total.shape[-1]
    rows, whole = np.arange(n), np.zeros((3, n, width, size))
    weights = total & ((1 << WEIGHT_BITS) - 1)
    for j in range(columns.shape[1]):
        whole[0, rows, columns[:, j]] = (total[:, j] >> WEIGHT_BITS) * scale
        whole[1, rows, columns[:, j]] = weights[:, j]
    allowed = np.zeros((n, width), bool)
    allowed[rows[:, None], columns] = True
    lost = np.flatnonzero(~allowed[:, 0])  # totals are read off the first feature
    whole[0, lost, 0, 0] = (total[lost, 0] >> WEIGHT_BITS).sum(-1) * scale
    whole[1, lost, 0, 0] = weights[lost, 0].sum(-1)
    whole[2, :, 0, 0] = seen
    return best_splits(whole, allowed, scale, growth)


# --- rows in one task ----------------------------------------------------------------------


def _forest_here(bins, keys, y, number, growth, cuts, size, scale) -> list[dict]:
    """A forest over rows in memory, from packed sums."""
    trees = []
    for t in range(number):
        tree, opened = new_tree(), [0]
        for _ in range(growth.depth):
            if opened:
                columns = _columns(bins.shape[1], t, opened, growth)
                total, seen = _packed_sums(bins, keys, -y, t, tree, opened, columns, growth, size)
                found = _unpacked_splits(total, seen, t, opened, columns, bins.shape[1], scale, growth)
                opened = split_nodes(tree, opened, found, cuts, growth)
        trees.append(tree)
    return trees


def _grow_here(bins, keys, y, start, number, growth, cuts, size, scale, boosted) -> list[dict]:
    """All trees over rows in memory; boosting (one at a time) follows the residuals, a forest does not."""
    trees, score = [], np.full(len(y), start)
    for t in range(number):
        g = np.rint((score - y) * scale).astype(np.int64)
        w = row_weights(keys, t, growth)
        g = g * w
        tree, opened = new_tree(), [0]
        for _ in range(growth.depth):
            if not opened:
                break
            at = nodes_of(tree, bins)
            sums = histograms(bins, at, g, w, _slots(tree, opened), size)
            allowed = np.stack([allowed_columns(bins.shape[1], t, node, growth) for node in opened])
            opened = split_nodes(tree, opened, best_splits(sums, allowed, scale, growth), cuts, growth)
        trees.append(tree)
        if boosted:
            score += np.array(tree["value"])[nodes_of(tree, bins)]
    return trees


# --- rows in the cluster -------------------------------------------------------------------
# The rows lie in blocks (bins, keys, y, score) of arrays, cached, so that a pass over them costs no work per row but sums.

BLOCK_ROWS = 1 << 17
PART_ROWS = 1 << 20
Block = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _unpacked(b: pa.RecordBatch, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(b.column("x").to_pylist()), np.uint8).reshape(-1, width)


def _blocks(data: Binned, start: float) -> RDD[Block]:
    """The rows as blocks of at most ``BLOCK_ROWS``, in parts of equal size that a task can hold."""
    width = data.width

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def packed() -> pa.RecordBatch:
            columns = [np.concatenate([_unpacked(b, width) for b in held])]
            columns += [np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("key", "y")]
            made = [pa.array([c.tobytes()], pa.binary()) for c in columns]
            held.clear()
            return pa.RecordBatch.from_arrays(made, ["x", "key", "y"])

        for b in batches:
            if sum(h.num_rows for h in held) + b.num_rows > BLOCK_ROWS and held:
                yield packed()
            if b.num_rows:
                held.append(b)
        if held:
            yield packed()

    def arrays(row) -> Block:
        y = np.frombuffer(row["y"], float)
        x = np.frombuffer(row["x"], np.uint8).reshape(-1, width)
        return x, np.frombuffer(row["key"], np.int64), y, np.full(len(y), start)

    parts = max(data.rows.sparkSession.sparkContext.defaultParallelism, -(-data.n // PART_ROWS))
    rows = data.rows.select("x", "y", "key").repartition(parts)  # many of the rows' own parts can be empty
    return rows.mapInArrow(pack, "x binary, key binary, y binary").rdd.map(arrays)


def _node_sums(
    bins: np.ndarray, slot: np.ndarray, g: np.ndarray, w: np.ndarray, columns: np.ndarray, size: int
) -> np.ndarray:
    """Sums (gradient, weight, rows) per (slot, one of the slot's ``columns``, bin) as whole numbers."""
    n, k = columns.shape
    total = np.zeros((3, n, k, size), np.int64)
    alike, single = (columns == columns[0]).all(), not len(w) or w.max() == 1
    for first in range(0, len(slot), EXACT_ROWS):
        part = slice(first, first + EXACT_ROWS)
        own, x, gp = slot[part], bins[part], g[part].astype(float)
        row, start = np.arange(len(own)), slot[part] * size
        for j in range(k):
            key = start + (x[:, columns[0, j]] if alike else x[row, columns[own, j]])
            seen = np.bincount(key, minlength=n * size).reshape(n, size)
            total[0, :, j] += np.bincount(key, gp, n * size).astype(np.int64).reshape(n, size)
            total[2, :, j] += seen
            if single:
                total[1, :, j] += seen
            else:
                total[1, :, j] += np.bincount(key, w[part], n * size).astype(np.int64).reshape(n, size)
    return total


def _block_sums(
    block: Block, t: int, tree: dict, slots: np.ndarray, columns: np.ndarray, growth: Growth, size: int, scale: float
) -> np.ndarray:
    """``_node_sums`` of the rows drawn for a tree that have reached a node with a slot."""
    bins, keys, y, score = block
    w = row_weights(keys, t, growth)
    drawn = np.flatnonzero(w)
    slot = slots[nodes_of(tree, bins, rows=drawn)]
    rows = drawn[slot >= 0]
    g = np.rint((score[rows] - y[rows]) * scale).astype(np.int64) * w[rows]
    return _node_sums(bins[rows], slot[slot >= 0], g, w[rows], columns, size)


NODES_TOGETHER = 32


def _packed_level(
    blocks: RDD[Block], trees: dict[int, dict], opened: dict[int, list[int]],
    growth: Growth, width: int, size: int, scale: float, cuts: list[list[float]],
) -> dict[int, list[int]]:
    """The same as ``_level`` from packed sums, which go to the grouped tasks by runs of a tree's open nodes."""

    def scan(part: Iterator[Block]) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
        held = [(bins, keys, score - y) for bins, keys, y, score in part]
        for t, tree in trees.items():
            if not opened[t]:
                continue
            columns = _columns(width, t, opened[t], growth)
            total, seen = np.zeros((*columns.shape, size), np.int64), np.zeros(len(columns), np.int64)
            for bins, keys, residual in held:
                sums, rows = _packed_sums(bins, keys, residual, t, tree, opened[t], columns, growth, size)
                total += sums
                seen += rows
            whole = np.concatenate([total.reshape(len(columns), -1), seen[:, None]], axis=1)
            for k in range(0, len(columns), NODES_TOGETHER):
                yield (t, k), whole[k : k + NODES_TOGETHER]

    def choose(item: tuple[tuple[int, int], np.ndarray]) -> list[tuple[int, int, list]]:
        (t, k), whole = item
        nodes = opened[t][k : k + NODES_TOGETHER]
        columns, seen = _columns(width, t, nodes, growth), whole[:, -1]
        total = whole[:, :-1].reshape(*columns.shape, size)
        found = _unpacked_splits(total, seen, t, nodes, columns, width, scale, growth)
        return [(t, node, [f[i].item() for f in found[:7]]) for i, node in enumerate(nodes) if seen[i]]

    there = sum(-(-len(o) // NODES_TOGETHER) for o in opened.values())
    summed = blocks.mapPartitions(scan).reduceByKey(np.add, min(there, blocks.getNumPartitions()))
    return _applied({(t, node): found for t, node, found in summed.flatMap(choose).collect()}, trees, opened, cuts, growth)


def _applied(splits: dict[tuple[int, int], list], trees, opened, cuts, growth) -> dict[int, list[int]]:
    """The open nodes after the found splits were made."""
    after = {}
    for t, tree in trees.items():
        held = [n for n in opened[t] if (t, n) in splits]
        columns = [np.array(c) for c in zip(*(splits[t, n] for n in held), strict=True)]
        after[t] = split_nodes(tree, held, columns, cuts, growth) if held else []
    return after


def _level(
    blocks: RDD[Block], trees: dict[int, dict], opened: dict[int, list[int]],
    growth: Growth, width: int, size: int, scale: float, cuts: list[list[float]],
) -> dict[int, list[int]]:
    """One level of all trees: sums per part and open node, the best split per node in grouped tasks, a row a node here."""

    def scan(part: Iterator[Block]) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
        held = list(part)
        for t, tree in trees.items():
            if not opened[t]:
                continue
            columns = np.stack([np.flatnonzero(allowed_columns(width, t, node, growth)) for node in opened[t]])
            slots, total = _slots(tree, opened[t]), np.zeros((3, *columns.shape, size), np.int64)
            for block in held:
                total += _block_sums(block, t, tree, slots, columns, growth, size, scale)
            for k in np.flatnonzero(total[2, :, 0].any(-1)):
                yield (t, opened[t][k]), total[:, k]

    def choose(item: tuple[tuple[int, int], np.ndarray]) -> tuple[int, int, list]:
        (t, node), sums = item
        allowed = allowed_columns(width, t, node, growth)
        whole = np.zeros((3, 1, width, size))
        whole[:, 0, allowed] = sums
        if not allowed[0]:  # totals are read off the first feature
            whole[:, 0, 0, 0] = sums[:, 0].sum(-1)
        found = best_splits(whole, allowed[None], scale, growth)
        return t, node, [f[0].item() for f in found[:7]]

    there = sum(map(len, opened.values()))
    summed = blocks.mapPartitions(scan).reduceByKey(np.add, min(there, blocks.getNumPartitions()))
    return _applied({(t, node): found for t, node, found in summed.map(choose).collect()}, trees, opened, cuts, growth)


#: Parts whose sums the driver adds itself; those of more parts meet in grouped tasks first.
PARTS_GATHERED = 32


def _sums_of(
    blocks: RDD[Block], t: int, tree: dict, nodes: list[int], columns: np.ndarray, growth: Growth, size: int, scale: float
) -> np.ndarray:
    """Sums (gradient, weight, rows) per (one of ``nodes``, one of its ``columns``, bin) over all blocks."""
    slots, kinds = _slots(tree, nodes), [0, 1, 2] if growth.bootstrap else [0, 2]  # otherwise a row's weight is 1

    def scan(part: Iterator[Block]) -> Iterator[tuple[int, np.ndarray]]:
        total = np.zeros((3, *columns.shape, size), np.int64)
        for block in part:
            total += _block_sums(block, t, tree, slots, columns, growth, size, scale)
        for k in range(0, len(nodes), NODES_TOGETHER):
            yield k, total[kinds, k : k + NODES_TOGETHER]

    found = blocks.mapPartitions(scan)
    if blocks.getNumPartitions() > PARTS_GATHERED:
        found = found.reduceByKey(np.add, -(-len(nodes) // NODES_TOGETHER))
    total = np.zeros((len(kinds), *columns.shape, size), np.int64)
    for k, sums in found.collect():
        total[:, k : k + sums.shape[1]] += sums
    return total if growth.bootstrap else total[[0, 1, 1]]


def _boosted_tree(
    sums_of: Callable[[dict, list[int], np.ndarray], np.ndarray], t: int, growth: Growth,
    width: int, size: int, scale: float, cuts: list[list[float]],
) -> dict:
    """A tree from the sums of its nodes; the larger child of a split node has what the smaller one leaves of its sums.

    The sums of one level are held here, which are bounded by the tree's depth.
    """
    tree, opened, before = new_tree(), [0], {}
    for _ in range(growth.depth):
        if not opened:
            break
        rest = {}  # node: (the node it is split from, its sibling)
        for node in before if growth.columns_per_node >= 1 else ():
            if tree["feature"][node] >= 0:
                left, right = tree["left"][node], tree["right"][node]
                columns, sums = before[node]
                rows = sums[2, np.searchsorted(columns, tree["feature"][node])]
                fewer = 2 * rows[: tree["bin"][node] + 1].sum() <= rows.sum()
                rest |= {right: (node, left)} if fewer else {left: (node, right)}
        asked = [node for node in opened if node not in rest]
        columns = _columns(width, t, asked, growth)
        held = dict(zip(asked, zip(columns, sums_of(tree, asked, columns).swapaxes(0, 1), strict=True), strict=True))
        for node, (parent, sibling) in rest.items():
            held[node] = before[parent][0], before[parent][1] - held[sibling][1]
        opened = [node for node in opened if held[node][1][2, 0].any()]
        if not opened:
            break
        whole, allowed = np.zeros((3, len(opened), width, size)), np.zeros((len(opened), width), bool)
        for i, node in enumerate(opened):
            kept, sums = held[node]
            whole[:, i, kept], allowed[i, kept] = sums, True
            if not allowed[i, 0]:  # totals are read off the first feature
                whole[:, i, 0, 0] = sums[:, 0].sum(-1)
        opened = split_nodes(tree, opened, best_splits(whole, allowed, scale, growth), cuts, growth)
        before = held
    return tree


@dataclass
class Binned:
    """Training rows: ``x`` (a byte per feature), ``y``, ``key`` (a hash of the row), ``score``."""

    rows: DataFrame
    n: int
    width: int
    cuts: list[list[float]]
    mean: float
    scale: float
    signs: bool = False  # whether y is -1, 0 or 1 everywhere

    @property
    def size(self) -> int:
        return max(len(c) for c in self.cuts) + 1


def _distinct_values(train: DataFrame, columns: dict[int, Column], most: int) -> dict[int, list[float]]:
    """The smallest ``most`` distinct values of each column, from one pass over the rows."""
    if not columns:
        return {}
    cells = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), v.alias("v")) for k, v in columns.items())))
    found = train.select(cells.alias("cell")).select("cell.k", "cell.v").distinct()
    lists = found.groupBy("k").agg(F.slice(F.sort_array(F.collect_list("v")), 1, most).alias("v"))
    return {r["k"]: list(r["v"]) for r in lists.collect()}


def _column_stats(train: DataFrame, values: dict[str, Column], y: Column, shares: list[float]) -> dict[int, dict]:
    """Quantiles and about the number of distinct values of each column, and numbers on ``y`` under -1, from one pass.

    A column's sketches meet in a task of its own: those of many parts and columns take long to merge.
    """
    columns = {-1: y} | dict(enumerate(values.values()))
    cells = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), v.alias("v")) for k, v in columns.items())))
    v, feature = F.col("v"), F.col("k") >= 0
    found = train.select(cells.alias("cell")).select("cell.k", "cell.v").groupBy("k").agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"), F.max(F.abs(v)).alias("most"),
        F.min((v == F.rint(v)).cast("int")).alias("whole"),
        F.percentile_approx(F.when(feature, v), shares, 10_000).alias("q"),
        F.approx_count_distinct(F.when(feature, v)).alias("d"),
    )
    nothing = {"n": 0, "mean": None, "most": None, "whole": None, "q": None, "d": 0}
    return dict.fromkeys(columns, nothing) | {r["k"]: r.asDict() for r in found.collect()}


def bin_rows(train: DataFrame, columns: tuple[str, ...], target: str, bins: int = 128) -> Binned:
    """Bin ``columns`` (null as 0) at their distinct values, or at quantiles if there are ``bins`` or more."""
    values = {c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in columns}
    y = F.col(f"`{target}`").cast("double")
    stats = _column_stats(train, values, y, [k / bins for k in range(1, bins)])
    few = [k for k in range(len(values)) if stats[k]["d"] < bins]  # about; the exact values are looked up and counted
    held = _distinct_values(train, {k: list(values.values())[k] for k in few}, 2 * bins)
    cuts = []
    for k in range(len(values)):
        exact = k in few and len(held.get(k, [])) <= bins
        cuts.append(held.get(k, [])[:-1] if exact else sorted(set(stats[k]["q"] or [])))
    bounds = [np.array(c) for c in cuts]
    n, mean = stats[-1]["n"], stats[-1]["mean"] or 0.0
    size = max(2 * (stats[-1]["most"] or 0.0), 1.0)
    bits = min(61 - math.log2(max(n, 1) * size * 16), 51 - math.log2(EXACT_ROWS * size * 16))
    scale = 2.0 ** math.floor(bits)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [np.searchsorted(bounds[k], b.column(f"x{k}").to_numpy()) for k in range(len(bounds))]
            packed = np.stack(x, axis=1).astype(np.uint8)
            ends = np.arange(b.num_rows + 1, dtype=np.int32) * np.int32(len(bounds))
            whole = pa.BinaryArray.from_buffers(pa.binary(), b.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(packed)])
            yield pa.RecordBatch.from_arrays([whole, b.column("y"), b.column("key")], ["x", "y", "key"])

    named = [v.alias(f"x{k}") for k, v in enumerate(values.values())]
    rows = train.filter(y.isNotNull()).select(*named, y.alias("y"), F.xxhash64(y, *values.values()).alias("key"))
    made = rows.mapInArrow(scan, "x binary, y double, key long").withColumn("score", F.lit(float(mean)))
    signs = stats[-1]["whole"] == 1 and stats[-1]["most"] <= 1
    return Binned(cut_lineage(made), n, len(columns), cuts, float(mean), scale, signs)


def grow_trees(
    data: Binned, number: int, growth: Growth, boosted: bool, task_rows: int = 1_000_000, keep_every: int = 40
) -> list[dict]:
    """``number`` trees: each on the residuals of those before it, or all on the target itself."""
    start = data.mean if boosted else 0.0
    growth = growth if boosted else replace(growth, step=1.0)
    width, size, scale, cuts = data.width, data.size, data.scale, data.cuts
    packed = not boosted and data.signs and scale >= 1 and data.n * MOST_WEIGHT < 1 << WEIGHT_BITS
    if data.n <= task_rows:

        def whole(table: pa.Table) -> pa.Table:
            b = table.combine_chunks().to_batches()[0]
            y, keys = b.column("y").to_numpy(), b.column("key").to_numpy()
            bins = np.ascontiguousarray(_unpacked(b, width))
            if packed:
                trees = _forest_here(bins, keys, y, number, growth, cuts, size, scale)
            else:
                trees = _grow_here(bins, keys, y, start, number, growth, cuts, size, scale, boosted)
            return pa.table({"trees": [json.dumps(trees)]})

        rows = data.rows.withColumn("one", F.lit(0)).groupBy("one").applyInArrow(whole, "trees string").collect()
        return json.loads(rows[0]["trees"]) if rows else [new_tree() for _ in range(number)]

    first = blocks = _blocks(data, start).persist(StorageLevel.MEMORY_AND_DISK)
    args = (growth, width, size, scale, cuts)
    try:
        if not boosted:
            trees = {t: new_tree() for t in range(number)}
            opened = {t: [0] for t in trees}
            for _ in range(growth.depth):
                if any(opened.values()):
                    opened = (_packed_level if packed else _level)(blocks, trees, opened, *args)
            return list(trees.values())
        done: list[dict] = []
        for t in range(number):
            past = []
            if done:
                # From time to time scores are put together anew from the first blocks, so that no long lineage builds up.
                past, anew = [blocks] if blocks is not first else [], t % keep_every == 0
                blocks = _scored(first if anew else blocks, done if anew else done[-1:])
                blocks.persist(StorageLevel.MEMORY_AND_DISK)

            def sums_of(tree: dict, nodes: list[int], columns: np.ndarray) -> np.ndarray:
                found = _sums_of(blocks, t, tree, nodes, columns, growth, size, scale)
                while past:  # the first level has computed the scores that follow it
                    past.pop().unpersist()
                return found

            done.append(_boosted_tree(sums_of, t, *args))
        return done
    finally:
        blocks.unpersist()
        first.unpersist()


def _scored(blocks: RDD[Block], trees: list[dict]) -> RDD[Block]:
    """The blocks with the trees' values added to the scores, one after another."""

    def added(block: Block) -> Block:
        bins, keys, y, score = block
        for tree in trees:
            score = score + np.array(tree["value"])[nodes_of(tree, bins)]
        return bins, keys, y, score

    return blocks.map(added)


# --- the model -----------------------------------------------------------------------------


class TreeEnsembleModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Sum (boosting) or mean (forest) of trees over the column ``features``.

    A regressor adds ``prediction``; a classifier adds ``probability`` and ``prediction`` (1 above one half).
    """

    ensemble = Param(Params._dummy(), "ensemble", "trees, base and kind as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, ensemble: str | None = None):
        super().__init__()
        if ensemble is not None:
            self._set(ensemble=ensemble)

    @property
    def content(self) -> dict:
        return json.loads(self.getOrDefault(self.ensemble))

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802
        """Summed gains of the splits per feature, as shares of their total."""
        content = self.content
        total = np.zeros(content["width"])
        for tree in content["trees"]:
            for feature, gain in zip(tree["feature"], tree["gain"], strict=True):
                if feature >= 0:
                    total[feature] += gain
        return DenseVector(total / total.sum() if total.sum() else total)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        content = self.content
        trees = [{k: np.array(v) for k, v in tree.items()} for tree in content["trees"]]
        base, mean = content["base"], not content["boosted"]

        @F.pandas_udf("double")
        def score(values: pd.Series) -> pd.Series:
            made = np.full(len(values), base)
            if len(values):
                x = np.stack(values.to_numpy())
                for tree in trees:
                    made += tree["value"][nodes_of(tree, x, "threshold")]
            return pd.Series(np.clip(made / len(trees), 0.0, 1.0) if mean else made)

        scored = score(vector_to_array("features"))
        if content["boosted"]:
            return dataset.withColumn("prediction", scored)
        sure = dataset.withColumn("probability", scored)
        both = array_to_vector(F.array(1.0 - F.col("probability"), F.col("probability")))
        return sure.withColumn("prediction", (F.col("probability") > 0.5).cast("double")).withColumn("probability", both)


def ensemble_of(data: Binned, trees: list[dict], boosted: bool) -> TreeEnsembleModel:
    content = {"trees": trees, "base": data.mean if boosted else 0.0, "boosted": boosted, "width": data.width}
    return TreeEnsembleModel(ensemble=json.dumps(content))
