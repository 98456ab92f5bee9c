"""SimHash near-duplicates, found through tables of distances to reference fingerprints.

1. ``fingerprints``: 64 bits per document, from the XXH64 of its word shingles, whole text.
2. ``pivot_table``: for each distinct fingerprint its Hamming distances to many references, in
   total and block by block.  The distance to a reference changes by at most the number of
   differing bits, in every block and in total.
3. Two fingerprints within ``max_bits`` bits differ in at most ``max_bits`` of the
   ``max_bits + 3`` blocks.  In the blocks left over all their coordinates are equal, so an equi
   join on the coordinates of every choice of three blocks meets every such pair.  Sixteen
   references determine a block's bits, so a key stands for equal bits in three blocks.
   Fingerprints of one key differ in the other blocks only.  Where a key has many, those bits
   are cut into ``max_bits + 3`` blocks again: by the same argument a pair within ``max_bits``
   bits meets under one of the finer keys.  With two bits, two cuts leave 11 free bits, so a key
   never has more than 2,048 rows, however many fingerprints share their other bits.
4. ``linked``: inside one such key, sorted by the first total coordinate, rows further apart than
   ``max_bits`` in any total coordinate are discarded and survivors verified by exact distance.
   Pairs that are connected already are skipped and only joining links leave the task, so a
   large group of copies gives links in proportion to its size and loses no connection.
5. Components by alternating large and small stars; exact copies meet only by their fingerprint.

Null text counts as empty; documents without words have fingerprint zero and are linked like any
other.  Null ids keep their row; a group's id is its smallest id that is not null.  Rows equal in
id and text, and texts equal up to case and white space, share a fingerprint.  A very long text is
hashed in slices, whole.  Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zephyrine.llm.text import carried, same_key, stored
from zephyrine.operators.components import connected_components
from zephyrine.session import cut_lineage

BITS = 64
#: Hash seed of the fingerprint's definition.
SEED = 42
_SLICE = 1 << 16


def references(count: int) -> list[int]:
    """Reference fingerprints: the SplitMix64 sequence from zero."""
    made, state, low = [], 0, (1 << BITS) - 1
    for _ in range(count):
        state = (state + 0x9E3779B97F4A7C15) & low
        z = ((state ^ (state >> 30)) * 0xBF58476D1CE4E5B9) & low
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & low
        made.append(z ^ (z >> 31))
    return made


def fingerprint(text: bytes | None, shingle: int) -> int:
    """SimHash of one text, as a signed 64-bit number."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = min(shingle, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - last].tolist(), ends[last:].tolist(), strict=True)
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), _SLICE):
        octets = hashes[k : k + _SLICE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(packed.view(np.int64)[0])


def fingerprints(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3
) -> DataFrame:
    """(key_id, key_hash, fp) per row; ``fp`` is the fingerprint as a signed number."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [fingerprint(t, shingle) for t in b.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("key_id"), b.column("key_hash"), pa.array(made, pa.int64())],
                ["key_id", "key_hash", "fp"],
            )

    chosen = carried(docs, id, text).select("key_id", "key_hash", F.col("body").cast("binary"))
    return chosen.mapInArrow(scan, "key_id long, key_hash long, fp long")


def _blocks(free: int, count: int) -> np.ndarray:
    """Bit masks that split the set bits of ``free`` into ``count`` runs of nearly equal length."""
    bits = [1 << k for k in range(BITS) if free >> k & 1]
    edges = [len(bits) * k // count for k in range(count + 1)]
    return np.array([sum(bits[a:b]) for a, b in zip(edges, edges[1:], strict=False)], np.uint64)


def pivot_rows(
    fp: np.ndarray, max_bits: int, pivots: int, free: int = (1 << BITS) - 1
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distances, keys, left) of fingerprints: total distance per pivot, one key per three blocks.

    The blocks split the bits of ``free``; ``left`` has its bits outside a key's blocks.  A key is
    a weighted sum of the block distances; different distances that share a key only make
    candidates that verification discards.
    """
    refs, masks = np.array(references(pivots), np.uint64), _blocks(free, max_bits + 3)
    apart = fp[:, None] ^ refs
    local = np.bitwise_count(apart[:, :, None] & masks)  # fingerprint, pivot, block
    weights = np.array(references(pivots * 3 + 1)[1:], np.uint64) | np.uint64(1)
    keys, left = [], []
    for number, chosen in enumerate(combinations(range(len(masks)), 3)):
        wide = local[:, :, chosen].reshape(len(fp), -1).astype(np.uint64)
        keys.append((wide * weights).sum(axis=1, dtype=np.uint64) * np.uint64(2 * number + 1) + np.uint64(number))
        left.append(free & ~sum(masks[list(chosen)].tolist()))
    return np.bitwise_count(apart), np.stack(keys, axis=1), np.array(left, np.uint64)


def _keyed(rows: DataFrame, max_bits: int, pivots: int) -> DataFrame:
    """(key, free, nearest, fp, distances) of (key, free, fp): each key's rows under finer keys."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            above, free, fp = (b.column(x).to_numpy().view(np.uint64) for x in ("key", "free", "fp"))
            for mask in np.unique(free):
                here = free == mask
                table, keys, left = pivot_rows(fp[here], max_bits, pivots, int(mask))
                times = keys.shape[1]
                keys = keys + above[here, None] * np.uint64(0x9E3779B97F4A7C15)
                packed = pa.array([row.tobytes() for row in table], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys.ravel().view(np.int64)),
                        pa.array(np.tile(left, len(table)).view(np.int64)),
                        pa.array(np.repeat(table[:, 0].view(np.int8), times)),
                        pa.array(np.repeat(fp[here].view(np.int64), times)),
                        packed.take(pa.array(np.repeat(np.arange(len(table)), times))),
                    ],
                    ["key", "free", "nearest", "fp", "distances"],
                )

    schema = "key long, free long, nearest byte, fp long, distances binary"
    return rows.select("key", "free", "fp").mapInArrow(scan, schema)


def pivot_table(prints: DataFrame, max_bits: int, pivots: int = 16, rows_per_key: int = 1 << 11) -> DataFrame:
    """(key, free, nearest, fp, distances): a row per key; ``nearest`` is the first total distance.

    A key of more than ``rows_per_key`` distinct fingerprints is split: its rows differ in the bits
    of ``free`` only, and these are cut into blocks and keyed in the same way, as often as needed.
    """
    table = _keyed(prints.select(F.lit(0).cast("long").alias("key"), F.lit(-1).cast("long").alias("free"), "fp"), max_bits, pivots)
    while True:
        sizes = table.filter("free <> 0").groupBy("key").count()
        hot = stored(sizes.filter(F.col("count") > rows_per_key).select("key"), "hot-keys")
        if hot.isEmpty():
            return table
        heavy = cut_lineage(table.join(hot, "key", "left_semi"))
        table = table.join(hot, "key", "left_anti").unionByName(_keyed(heavy, max_bits, pivots))


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining a[i] with b[i]; a label is the smallest index of its group."""
    while True:
        x, y = label[a], label[b]
        if (x == y).all():
            return label
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not ((onward := label[label]) == label).all():
            label = onward


def joining_links(key, fp, table, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all rows of equal key within ``max_bits``; sorted by key, first pivot."""
    n = len(key)
    label, left, shift = np.arange(n), np.arange(n), 1
    found_a, found_b = [], []
    while True:
        # Sorted rows: once (i, i + shift) is too far apart, so is every later one.
        left = left[: np.searchsorted(left, n - shift)]
        near = key[left] == key[left + shift]
        near &= table[left + shift, 0] - table[left, 0] <= max_bits
        left = left[near]
        if not len(left):
            break
        a = left[label[left] != label[left + shift]]
        a = a[np.abs(table[a] - table[a + shift]).max(axis=1, initial=0) <= max_bits]
        a = a[np.bitwise_count(fp[a] ^ fp[a + shift]) <= max_bits]
        if len(a):
            found_a.append(fp[a])
            found_b.append(fp[a + shift])
            label = _merge(label, a, a + shift)
        shift += 1
    if not found_a:
        return fp[:0], fp[:0]
    return np.concatenate(found_a), np.concatenate(found_b)


def linked(prints: DataFrame, max_bits: int, pivots: int = 16, rows_per_key: int = 1 << 11) -> DataFrame:
    """(u, v) links between distinct fingerprints that connect all within ``max_bits`` bits."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(key, fp, table):
            u, v = joining_links(key, fp, table, max_bits)
            links = [pa.array(x.view(np.int64), pa.int64()) for x in (u, v)]
            return pa.RecordBatch.from_arrays(links, ["u", "v"])

        held = None
        for b in batches:
            rows = (
                b.column("key").to_numpy(),
                b.column("fp").to_numpy().view(np.uint64),
                np.frombuffer(b"".join(b.column("distances").to_pylist()), np.int8).reshape(-1, pivots),
            )
            if held is not None:
                rows = tuple(np.concatenate(x) for x in zip(held, rows, strict=True))
            if not len(rows[0]):
                continue
            whole = np.searchsorted(rows[0], rows[0][-1])  # the last key may go on
            held = tuple(x[whole:] for x in rows)
            if whole:
                yield made(*(x[:whole] for x in rows))
        if held is not None:
            yield made(*held)

    return (
        pivot_table(prints, max_bits, pivots, rows_per_key)
        .select("key", "nearest", "fp", "distances")
        .repartition("key")
        .sortWithinPartitions("key", "nearest")
        .mapInArrow(scan, "u long, v long")
    )


def near_duplicates(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    max_bits: int = 2,
    pivots: int = 16,
) -> DataFrame:
    """(key_id, key_hash, fp, component, component_id) per row of ``docs``.

    ``component`` is the smallest fingerprint of the group, ``component_id`` its smallest id.
    """
    rows = cut_lineage(fingerprints(docs, id, text, shingle))
    prints = cut_lineage(rows.groupBy("fp").agg(F.min("key_id").alias("first_id")))
    links = cut_lineage(linked(prints.select("fp"), max_bits, pivots))
    groups = connected_components(links)
    members = prints.join(groups.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    smallest = members.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = members.join(smallest, "component").select("fp", "component", "component_id")
    return rows.join(named, "fp").select("key_id", "key_hash", "fp", "component", "component_id")


def drop_near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` with one row of each group: the smallest id, of equal ids one whose hash is smallest.

    Null ids come last.  Rows equal in id and text count as one.
    """
    found = cut_lineage(near_duplicates(docs, id, text, **how).select("key_id", "key_hash", "component"))
    rank = F.struct(F.col("key_id").isNull().alias("last"), "key_id", "key_hash")
    kept = found.groupBy("component").agg(F.min(rank).alias("best")).select("best.*").drop("last")
    keys = found.groupBy("key_id", "key_hash").count()
    # The verdicts travel to the rows: few of them are broadcast, and the texts stay where they are read.
    removed = stored(keys.join(kept, same_key(keys, kept), "left_anti").drop("count"), "near-removed")
    again = stored(keys.filter("count > 1").drop("count"), "near-again")
    rows = carried(docs, id, text).drop("body")
    rows = rows.join(removed, same_key(rows, removed), "left_anti")
    single = rows.join(again, same_key(rows, again), "left_anti").select("row.*")
    if again.isEmpty():
        return single
    several = rows.join(again, same_key(rows, again), "left_semi")
    one = several.groupBy("key_id", "key_hash").agg(F.first("row").alias("row"))
    return single.unionByName(one.select("row.*"))
