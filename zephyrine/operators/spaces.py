"""Parts of space: a split tree over grid cells, and work on the cells that meet in a part."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from zephyrine.session import cut_lineage

SAMPLE_CELLS = 50_000
#: Distances that a task holds at once.
BLOCK = 1 << 21
#: Pairs of cells that a task writes at once.
PAIRS = 1 << 16


@dataclass
class SplitTree:
    """Cuts at grid lines: cells with a lower bound of ``cut`` or more in ``axis`` go to ``right``."""

    axis: int = -1
    cut: float = 0.0
    left: SplitTree | None = None
    right: SplitTree | None = None
    leaf: int = 0


def _split(lows: np.ndarray, side: float, parts: float, numbers) -> SplitTree:
    """The tree over a sample of cells' lower corners, ``parts`` leaves deep, cut at medians of the widest axis."""
    if parts > 1 and len(lows) > 1:
        spread = np.percentile(lows, 90, axis=0) - np.percentile(lows, 10, axis=0)
        for axis in np.argsort(-spread, kind="stable"):
            cut = np.floor(np.median(lows[:, axis]) / side) * side
            right = lows[:, axis] >= cut
            if not right.any() or right.all():
                cut += side
                right = lows[:, axis] >= cut
            if right.any() and not right.all():
                made = SplitTree(int(axis), float(cut))
                made.left = _split(lows[~right], side, parts / 2, numbers)
                made.right = _split(lows[right], side, parts / 2, numbers)
                return made
    return SplitTree(leaf=next(numbers))


def fit_tree(cells: DataFrame, names: list[str], side: float, part_cells: int) -> Broadcast:
    """A broadcast tree whose leaves hold about ``part_cells`` cells; it is fitted to ``SAMPLE_CELLS`` of them."""
    total = cells.count()
    share = min(1.0, SAMPLE_CELLS / max(total, 1))
    chosen = F.xxhash64("cell").bitwiseAND((1 << 62) - 1) <= int(share * (1 << 62))
    lows = cells.filter(chosen).select(*(f"lo_{x}" for x in names)).collect()
    rows = np.array(lows, float).reshape(-1, len(names))
    tree = _split(rows, side, total / part_cells, iter(range(1 << 62)))
    return cells.sparkSession.sparkContext.broadcast(tree)


def _parts(node: SplitTree, lo, hi, gaps, rows, own, eps: float):
    """(leaf, rows, own) for every leaf within ``eps`` of the boxes ``lo`` to ``hi``."""
    near = (gaps * gaps).sum(axis=1) <= eps * eps
    gaps, rows, own = gaps[near], rows[near], own[near]
    if not len(rows):
        return
    if node.axis < 0:
        yield node.leaf, rows, own
        return
    low, high = lo[rows, node.axis], hi[rows, node.axis]
    left, right = gaps.copy(), gaps
    left[:, node.axis] = np.maximum(left[:, node.axis], low - node.cut)
    right[:, node.axis] = np.maximum(right[:, node.axis], node.cut - high)
    yield from _parts(node.left, lo, hi, left, rows, own & (low < node.cut), eps)
    yield from _parts(node.right, lo, hi, right, rows, own & (low >= node.cut), eps)


def place_cells(cells: DataFrame, names: list[str], tree: Broadcast, eps: float) -> DataFrame:
    """The cells with ``part`` and ``own``: once in the part they lie in, and in every part within ``eps``."""

    def scan(batches):
        for b in batches:
            lo, hi = (np.stack([b.column(f"{end}_{x}").to_numpy() for x in names], axis=1) for end in ("lo", "hi"))
            rows = np.arange(b.num_rows)
            start = np.zeros((b.num_rows, len(names))), rows, np.ones(b.num_rows, bool)
            for leaf, found, own in _parts(tree.value, lo, hi, *start, eps * (1 + 1e-9)) if b.num_rows else ():
                part = b.take(pa.array(found))
                part = part.append_column("part", pa.array(np.full(len(found), leaf, np.int64)))
                yield part.append_column("own", pa.array(own))

    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in cells.schema)}, part long, own boolean"
    return cells.mapInArrow(scan, schema)


def matrix(table: pa.Table, names: list[str]) -> np.ndarray:
    columns = [table.column(x).to_numpy() for x in names]
    return np.stack(columns, axis=1) if table.num_rows else np.zeros((0, len(names)))


def _near(a: np.ndarray, b: np.ndarray, eps: float):
    """(first row, matrix of whether rows of ``a`` lie within ``eps`` of rows of ``b``), a block of rows at a time."""
    step = max(1, BLOCK // max(len(b), 1))
    for k in range(0, len(a), step):
        total = np.zeros((len(a[k : k + step]), len(b)))
        for axis in range(a.shape[1]):
            total += (a[k : k + step, axis, None] - b[None, :, axis]) ** 2
        yield k, total <= eps * eps


def _tiles(rows: DataFrame, placed: DataFrame, key: str, tile_rows: int, weight: str | None = None) -> GroupedData:
    """Own rows of a part (``facing`` false) against all rows of the part (``facing`` true), in tiles of about
    ``tile_rows`` on each side; a cell of ``placed`` has one of the rows, or ``weight`` of them."""
    size = F.col(weight) if weight else F.lit(1)
    high, wide = (F.ceil(F.sum(c) / tile_rows).cast("int") for c in (F.when(F.col("own"), size).otherwise(0), size))
    sizes = placed.groupBy("part").agg(high.alias("high"), wide.alias("wide")).filter("high > 0")
    return _dealt(rows.filter("own"), rows, sizes, key).drop("own").groupBy("part", "row", "column")


def _dealt(own: DataFrame, all_: DataFrame, sizes: DataFrame, key: str) -> DataFrame:
    """The rows of both sides (``facing`` says which) in the tiles of their part, ``high`` times ``wide`` of them."""
    down, across = (F.pmod(F.xxhash64(key), F.col(c).cast("long")).cast("int") for c in ("high", "wide"))
    every_row, every_column = (F.explode(F.sequence(F.lit(0), F.col(c) - 1)) for c in ("high", "wide"))
    own = own.join(sizes, "part").withColumns({"row": down, "column": every_column, "facing": F.lit(False)})
    all_ = all_.join(sizes, "part").withColumns({"row": every_row, "column": across, "facing": F.lit(True)})
    return own.unionByName(all_).drop("high", "wide")


def _sides(table: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(names of the cells, the cell of every row, own rows, rows they face)."""
    cells = table.column("cell").combine_chunks().dictionary_encode()
    facing = table.column("facing").to_numpy()
    return cells.dictionary, cells.indices.to_numpy(), np.flatnonzero(~facing), np.flatnonzero(facing)


def _boxes(table: pa.Table, names: list[str], rows: np.ndarray, others: np.ndarray):
    """(rows, squared least and squared largest distances of their boxes to those of ``others``), a block at a time."""
    lo, hi = (matrix(table, [f"{end}_{x}" for x in names]) for end in ("lo", "hi"))
    step = max(1, BLOCK // max(len(others), 1))
    for k in range(0, len(rows) if len(others) else 0, step):
        a = rows[k : k + step]
        gap, reach = np.zeros((len(a), len(others))), np.zeros((len(a), len(others)))
        for x in range(len(names)):
            below = lo[a, x, None] - hi[None, others, x]
            above = lo[None, others, x] - hi[a, x, None]
            gap += np.maximum(np.maximum(below, above), 0.0) ** 2
            reach += np.maximum(-below, -above) ** 2
        yield a, gap, reach


def _with_dense(n: np.ndarray, own: np.ndarray, every: np.ndarray, least: int):
    """Rows and those they face, so that one of two is dense: a dense cell meets all others, a sparse one the dense cells."""
    return (own[n[own] >= least], every), (own[n[own] < least], every[n[every] >= least])


def _merged(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The root of every node, the smallest of its component, once the nodes ``a`` and ``b`` are joined pairwise."""
    while True:
        x, y = roots[a], roots[b]
        apart = x != y
        if not apart.any():
            return roots
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(roots, np.maximum(x, y), np.minimum(x, y))
        while True:
            onward = roots[roots]
            if (onward == roots).all():
                break
            roots = onward


def whole_links(
    placed: DataFrame, names: list[str], eps: float, min_samples: int, tile_rows: int = 1 << 15
) -> DataFrame:
    """Links (u, v) between cells whose points all lie within ``eps`` of each other, one of them dense.

    The points of both cells are core points then.  A tile gives one link per cell, to the first cell of its component there.
    """

    def link(table: pa.Table) -> pa.Table:
        named, cell, own, every = _sides(table)
        roots = np.arange(len(named))
        for rows, others in _with_dense(table.column("n").to_numpy(), own, every, min_samples):
            for a, _, reach in _boxes(table, names, rows, others):
                i, j = np.nonzero(reach <= eps * eps)
                roots = _merged(roots, cell[a[i]], cell[others[j]])
        moved = np.flatnonzero(roots != np.arange(len(roots)))
        return pa.table({"u": named.take(pa.array(moved)), "v": named.take(pa.array(roots[moved]))})

    return _tiles(placed, placed, "cell", tile_rows).applyInArrow(link, "u string, v string")


def apart_pairs(
    known: DataFrame, names: list[str], eps: float, min_samples: int, tile_rows: int = 1 << 15
) -> DataFrame:
    """Ordered pairs (cell, other) of cells in different components with boxes within ``eps``, one of them dense.

    ``known`` are placed cells with their ``component``.
    """
    bounds = [f"{end}_{x}" for x in names for end in ("lo", "hi")]

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        _, _, own, every = _sides(table)
        component = table.column("component").combine_chunks().dictionary_encode().indices.to_numpy()
        for rows, others in _with_dense(table.column("n").to_numpy(), own, every, min_samples):
            for a, gap, _ in _boxes(table, names, rows, others):
                i, j = np.nonzero((gap <= eps * eps) & (component[a, None] != component[None, others]))
                for first in range(0, len(i), PAIRS):
                    part = slice(first, first + PAIRS)
                    yield from told(table, a[i[part]], others[j[part]]).to_batches()

    def told(table: pa.Table, a: np.ndarray, b: np.ndarray) -> pa.Table:
        left, right = table.select(["cell"]).take(pa.array(a)), table.take(pa.array(b))
        made = {"cell": left.column("cell"), "other": right.column("cell")}
        return pa.table(made | {f"o_{c}": right.column(c) for c in bounds}).combine_chunks()

    tiles = _tiles(known, known, "cell", tile_rows)
    return tiles.applyInArrow(meet, "cell string, other string, " + ", ".join(f"o_{c} double" for c in bounds))


def dense_near(
    known: DataFrame, names: list[str], eps: float, min_samples: int, tile_rows: int = 1 << 15
) -> DataFrame:
    """(part, cell, n, component) of the dense cells whose boxes lie within ``eps`` of an own cell of the part.

    ``known`` are placed cells: the dense ones, and the sparse ones that ask, alone ``own``.
    """

    def find(table: pa.Table) -> pa.Table:
        _, _, own, every = _sides(table)
        n = table.column("n").to_numpy()
        others = every[n[every] >= min_samples]
        near = np.zeros(len(others), bool)
        for _, gap, _ in _boxes(table, names, own, others):
            near |= (gap <= eps * eps).any(axis=0)
        return table.select(["part", "cell", "n", "component"]).take(pa.array(others[near]))

    found = _tiles(known, known, "cell", tile_rows).applyInArrow(find, "part long, cell string, n long, component string")
    return found.distinct()


def dense_neighbours(
    asking: DataFrame, sparse: DataFrame, near: DataFrame, dense: DataFrame, names: list[str], eps: float, tile_rows: int = 1 << 15
) -> DataFrame:
    """(id, component, n): how many points of a component's dense cells lie within ``eps`` of a point of a sparse cell.

    ``asking`` are the placed sparse cells, each in its own part, ``near`` the dense cells that they face there, ``sparse``
    and ``dense`` the points of either.
    """

    def count(table: pa.Table) -> pa.Table:
        facing = table.column("facing").to_numpy()
        own, every = np.flatnonzero(~facing), np.flatnonzero(facing)
        x = matrix(table, names)
        component = table.column("component").combine_chunks().take(pa.array(every)).dictionary_encode()
        member = component.indices.to_numpy()
        order = np.argsort(member, kind="stable")
        begins = np.searchsorted(member[order], np.arange(len(component.dictionary)))
        rows, seen, n = [], [], []
        for k, hit in _near(x[own], x[every[order]], eps) if len(every) else ():
            counts = np.add.reduceat(hit, begins, axis=1, dtype=np.int64)
            i, j = np.nonzero(counts)
            rows.append(own[k + i])
            seen.append(j)
            n.append(counts[i, j])
        rows, seen, n = (np.concatenate(v) if v else np.array([], np.int64) for v in (rows, seen, n))
        ids = table.column("id").combine_chunks().take(pa.array(rows))
        return pa.table({"id": ids, "component": component.dictionary.take(pa.array(seen)), "n": pa.array(n)})

    high, wide = (F.ceil(F.sum("n") / tile_rows).cast("int").alias(c) for c in ("high", "wide"))
    sizes = asking.groupBy("part").agg(high).join(near.groupBy("part").agg(wide), "part")
    held = ("row_no", "id", *names)
    rows = asking.select("cell", "part").join(sparse.select("cell", *held), "cell").drop("cell")
    others = near.select("cell", "part", "component").join(dense.select("cell", *held), "cell").drop("cell")
    rows, others = rows.withColumn("component", F.lit(None).cast("string")), others.withColumn("id", F.lit(None).cast("string"))
    tiles = _dealt(rows, others, sizes, "row_no").groupBy("part", "row", "column")
    return tiles.applyInArrow(count, "id string, component string, n long")


def _members(placed: DataFrame, sparse: DataFrame, tile_rows: int) -> GroupedData:
    """The points of sparse cells, in the tiles of every part that has their cell."""
    rows = placed.select("cell", "part", "own").join(sparse, "cell")
    return _tiles(rows, placed, "row_no", tile_rows, "n")


def sparse_neighbours(
    placed: DataFrame, sparse: DataFrame, names: list[str], eps: float, tile_rows: int = 1 << 15
) -> DataFrame:
    """(id, sparse_n): how many points of other sparse cells lie within ``eps`` of a point of a sparse cell.

    ``placed`` are the sparse cells, those whose points ask alone ``own``; ``sparse`` are their points.
    """

    def count(table: pa.Table) -> pa.Table:
        x, (_, cell, own, every) = matrix(table, names), _sides(table)
        n = np.zeros(len(own), np.int64)
        for k, near in _near(x[own], x[every], eps):
            rows = own[k : k + len(near)]
            n[k : k + len(near)] = (near & (cell[rows, None] != cell[None, every])).sum(axis=1)
        found = table.select(["row_no", "id"]).take(pa.array(own))
        return found.append_column("sparse_n", pa.array(n))

    counts = _members(placed, sparse, tile_rows).applyInArrow(count, "row_no long, id string, sparse_n long")
    return counts.groupBy("row_no", "id").agg(F.sum("sparse_n").alias("sparse_n")).drop("row_no")


def _distinct(a: np.ndarray, b: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The different pairs of ``a`` and ``b``; ``b`` is below ``size``."""
    return np.divmod(np.unique(a.astype(np.int64) * size + b), max(size, 1))


def sparse_links(
    placed: DataFrame, flagged: DataFrame, names: list[str], eps: float, tile_rows: int = 1 << 15
) -> tuple[DataFrame, DataFrame]:
    """Links (u, v) between sparse cells with core points in reach, and (id, cell) of border points of sparse cells.

    A tile gives one link per cell, to the first cell of its component there, and for a border point one cell per
    component in reach.  ``placed`` are the sparse cells, ``flagged`` their points.
    """

    def link(table: pa.Table) -> pa.Table:
        x, (named, cell, own, every) = matrix(table, names), _sides(table)
        core = np.array(table.column("core").fill_null(False).to_pylist(), bool)
        cores = every[core[every]]
        roots = np.arange(len(named))
        rows = own[core[own]]
        for k, near in _near(x[rows], x[cores], eps):
            i, j = np.nonzero(near)
            roots = _merged(roots, cell[rows[k + i]], cell[cores[j]])
        moved = np.flatnonzero(roots != np.arange(len(roots)))
        rest, ids, seen = own[~core[own]], [], []
        for k, near in _near(x[rest], x[cores], eps):
            i, j = np.nonzero(near)
            found = _distinct(rest[k + i], roots[cell[cores[j]]], len(named))
            ids.append(found[0])
            seen.append(found[1])
        ids, seen = (np.concatenate(v) if v else np.array([], np.int64) for v in (ids, seen))
        border = table.column("id").combine_chunks().take(pa.array(ids, pa.int64()))
        left = pa.concat_arrays([named.take(pa.array(moved, pa.int64())), border])
        right = named.take(pa.array(np.concatenate([roots[moved], seen]), pa.int64()))
        return pa.table({"u": left, "v": right, "link": pa.array(np.arange(len(left)) < len(moved))})

    made = cut_lineage(
        _members(placed, flagged, tile_rows).applyInArrow(link, "u string, v string, link boolean")
    )
    attached = made.filter("not link").select(F.col("u").alias("id"), F.col("v").alias("cell"))
    return made.filter("link").select("u", "v"), attached
