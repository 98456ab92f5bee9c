"""Line deduplication by a sharded minimal perfect hash over distinct line hashes.

1. Each line's key (stripped, A-Z lower-cased) is hashed twice: ``h`` places it, ``check`` proves
   it.  Distinct documents per key are counted over the whole corpus; a key of a third of all
   documents is counted in partial sums.
2. The distinct keys are split into shards by ``h``.  A shard's minimal perfect hash is a cascade of bit arrays (Limasset et al. 2017): a key alone at its place in a
   level is settled, the others fall to the next level; its rank among settled places is its
   slot.  Slots index compact arrays of fingerprints, counts and the document that keeps the line.
3. Documents probe: their line hashes travel to the shard, in groups of bounded size (a shard that
   a hot line makes large is copied to as many groups as it needs), and come back as line numbers
   to drop, by the count and the keeper found at the key's slot.  Line texts are never joined.

A key counts once per document id.  The document with the largest id keeps all its copies of the
line; null ids count as one document that never keeps.  Null and empty texts are one empty line.
Rows equal in id and text lose the same lines.  A very long text is split into its lines whole and its
rows are dealt by line.  An empty table has no index and gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zephyrine.llm.text import BLANK_CHARS, carried, line_array, lower_ascii, replace_text, same_key
from zephyrine.session import cut_lineage

#: Places per key in a level; more settles keys sooner and costs bits.
GAMMA = 2
INDEX = (
    "shard long, level_bits array<int>, bits binary, checks binary, counts binary, keepers binary,"
    " spilled array<struct<h:long,check:long,n_docs:int,keeper:long>>"
)
_ARRAYS = ("level_bits", "bits", "checks", "counts", "keepers", "spilled")


def _place(h: np.ndarray, level: int, size: int) -> np.ndarray:
    """Where each hash falls in a level: a multiply-and-shift mix, then the remainder."""
    with np.errstate(over="ignore"):
        x = h ^ np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return ((x ^ (x >> np.uint64(33))) % np.uint64(size)).astype(np.int64)


def build_levels(h: np.ndarray) -> list[np.ndarray]:
    """Bit arrays of the cascade over distinct 64-bit hashes."""
    levels, rest = [], h
    while len(rest):
        size = GAMMA * len(rest) + 1
        place = _place(rest, len(levels), size)
        alone = np.bincount(place, minlength=size) == 1
        levels.append(alone)
        rest = rest[~alone[place]]
    return levels


def slots(h: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """The slot of each hash; -1 where the hash settles nowhere, so is no key."""
    found, rest, before = np.full(len(h), -1, np.int64), np.arange(len(h)), 0
    for n, level in enumerate(levels):
        rank = np.cumsum(level) - 1
        place = _place(h[rest], n, len(level))
        here = level[place]
        found[rest[here]] = before + rank[place[here]]
        before += int(rank[-1]) + 1
        rest = rest[~here]
    return found


def _build(table: pa.Table) -> pa.Table:
    # Of keys with one h the first takes the slot: the one in most documents.
    table = table.sort_by([("h", "ascending"), ("n_docs", "descending"), ("check", "ascending")])
    h = table.column("h").to_numpy()
    first = np.concatenate(([True], h[1:] != h[:-1]))
    settled, spilled = table.filter(pa.array(first)), table.filter(pa.array(~first))
    h = h[first].view(np.uint64)
    levels = build_levels(h)
    order = np.argsort(slots(h, levels))
    packed = [np.packbits(x) for x in levels]
    row = {
        "shard": [table.column("shard")[0].as_py()],
        "level_bits": [[len(x) for x in levels]],
        "bits": [np.concatenate(packed).tobytes()],
        "checks": [settled.column("check").to_numpy()[order].tobytes()],
        "counts": [settled.column("n_docs").to_numpy()[order].tobytes()],
        "keepers": [settled.column("keeper").to_numpy()[order].tobytes()],
        "spilled": [spilled.select(["h", "check", "n_docs", "keeper"]).to_pylist()],
    }
    fields = [("h", pa.int64()), ("check", pa.int64()), ("n_docs", pa.int32()), ("keeper", pa.int64())]
    kinds = [pa.int64(), pa.list_(pa.int32()), *[pa.binary()] * 4, pa.list_(pa.struct(fields))]
    return pa.table({k: pa.array(v, t) for (k, v), t in zip(row.items(), kinds, strict=True)})


def _load(row: dict) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    bits, levels, at = np.frombuffer(row["bits"], np.uint8), [], 0
    for size in row["level_bits"]:
        width = -(-size // 8)
        levels.append(np.unpackbits(bits[at : at + width], count=size).astype(bool))
        at += width
    kinds = {"checks": np.int64, "counts": np.int32, "keepers": np.int64}
    return levels, *(np.frombuffer(row[name], kind) for name, kind in kinds.items())


def _probe(probes: pa.Table, index: pa.Table, min_docs: int) -> pa.Table:
    """Probes of one group whose key is counted often enough and kept by another document."""
    names = ["key_id", "key_hash", "line_no"]
    if not probes.num_rows or not index.num_rows:
        return probes.select(names).slice(0, 0)
    row = index.select(list(_ARRAYS)).to_pylist()[0]
    levels, checks, counts, keepers = _load(row)
    h, check = probes.column("h").to_numpy(), probes.column("check").to_numpy()
    slot = slots(h.view(np.uint64), levels)
    known = slot >= 0
    known[known] = checks[slot[known]] == check[known]
    found, keeper = np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
    found[known], keeper[known] = counts[slot[known]], keepers[slot[known]]
    if row["spilled"]:
        beside = {(x["h"], x["check"]): (x["n_docs"], x["keeper"]) for x in row["spilled"]}
        for k in np.flatnonzero(~known & np.isin(h, [x["h"] for x in row["spilled"]])):
            found[k], keeper[k] = beside.get((int(h[k]), int(check[k])), (0, 0))
    own = probes.column("key_id")
    lose = (keeper != own.fill_null(0).to_numpy()) | own.is_null().to_numpy()
    return probes.select(names).filter(pa.array(lose & (found >= min_docs)))


def line_hashes(docs: DataFrame, id: str, text: str, min_chars: int) -> DataFrame:
    """(key_id, key_hash, line_no, h, check) of each line whose key is long enough."""
    lines = carried(docs, id, text).select(
        "key_id", "key_hash", F.posexplode(line_array(F.col("body"))).alias("line_no", "line")
    )
    key = lower_ascii(F.btrim("line", F.lit(BLANK_CHARS)))
    return (
        lines.withColumn("line", key)
        .filter(F.length("line") >= min_chars)
        .select(
            "key_id",
            "key_hash",
            "line_no",
            F.xxhash64("line").alias("h"),
            F.xxhash64(F.lit(1), "line").alias("check"),
        )
    )


def key_counts(lines: DataFrame) -> DataFrame:
    """(h, check, n_docs, keeper) of each distinct key."""
    return (
        lines.select("h", "check", "key_id")
        .distinct()
        .groupBy("h", "check")
        .agg(F.count("*").cast("int").alias("n_docs"), F.max("key_id").alias("keeper"))
        .withColumn("keeper", F.coalesce("keeper", F.lit(0)))
    )


def build_index(keys: DataFrame, shards: int) -> DataFrame:
    """One row per shard: the cascade and its arrays.

    Keys that share ``h`` but not ``check`` cannot both be slots.  The one in more documents takes
    the slot, the others go to the list ``spilled``; two keys that agree in both, 128 bits, count as one.
    """
    return (
        keys.withColumn("shard", F.pmod("h", F.lit(shards)))
        .groupBy("shard")
        .applyInArrow(_build, INDEX)
    )


def dropped_lines(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    min_chars: int = 20,
    min_docs: int = 3,
    keys_per_shard: int = 1 << 16,
    probes_per_group: int = 1 << 18,
) -> DataFrame:
    """(key_id, key_hash, line_no): the lines that documents lose."""
    lines = cut_lineage(line_hashes(docs, id, text, min_chars))
    keys = cut_lineage(key_counts(lines))
    shards = max(1, -(-keys.count() // keys_per_shard))
    index = build_index(keys, shards)
    probes = lines.withColumn("shard", F.pmod("h", F.lit(shards)))
    parts = probes.groupBy("shard").agg(
        F.ceil(F.count("*") / probes_per_group).cast("int").alias("parts")
    )
    dealt = probes.join(parts, "shard").select(
        "key_id", "key_hash", "line_no", "h", "check", "shard",
        F.pmod(F.xxhash64("key_id", "key_hash", "line_no"), F.col("parts").cast("long")).alias("part"),
    )
    copies = index.join(parts, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1)).alias("part"),
        *_ARRAYS,
    )

    def probe(some: pa.Table, arrays: pa.Table) -> pa.Table:
        return _probe(some, arrays, min_docs)

    return (
        dealt.groupBy("shard", "part")
        .cogroup(copies.groupBy("shard", "part"))
        .applyInArrow(probe, "key_id long, key_hash long, line_no int")
    )


def dedup_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """(row, key_id, n_lines, n_dropped, kept_text) per row of ``docs``."""
    rows = carried(docs, id, text)
    drops = dropped_lines(docs, id, text, **how)
    lists = drops.groupBy("key_id", "key_hash").agg(F.collect_set("line_no").alias("drop"))
    joined = rows.join(lists, same_key(rows, lists), "left").select(
        "row", rows["key_id"], "body", "drop", line_array(F.col("body")).alias("lines")
    )
    # Positions are subtracted as sets, so a document of many lines costs time in proportion.
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drop"))
    kept = F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n")
    untouched = F.col("drop").isNull()
    return joined.select(
        "row",
        "key_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.when(untouched, 0).otherwise(F.size("drop")).cast("long").alias("n_dropped"),
        F.when(untouched, F.coalesce("body", F.lit(""))).otherwise(kept).alias("kept_text"),
    )


def drop_repeated_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` with the remaining text; a row without dropped lines keeps its text, null too."""
    found = dedup_lines(docs, id, text, **how)
    new = F.when(F.col("n_dropped") > 0, F.col("kept_text")).otherwise(F.col(f"row.`{text}`"))
    return found.select(replace_text(text, new).alias("row")).select("row.*")
