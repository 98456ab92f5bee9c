"""URL filters: a memory-mapped sorted array of 64-bit digests, probed by binary search.

A rule is a host and the beginning of a path; it fits its host and all subdomains.  The strings of
the rules and of a list of blocked hosts are digested by XXH64; digests are sorted by Spark and
written by its tasks, each range as plain arrays beside the full strings; the driver sees one row per range.  ``SparkContext.addFile`` brings the files to every
executor once, where workers map them into memory.  A URL is probed with each of its host suffixes
times each length that any rule's path has; hits of the binary search are confirmed on the full
string, so that colliding digests do no harm.  The longest fitting rule decides, of equally long
ones that with the longer host; without a rule, a URL on a blocked host is blocked and any other
allowed.

Null URLs and those without ``://`` have an empty host and path, which no rule fits.  Rules given
twice count once, the stricter verdict first.  Repeated pages have equal rows, a very long URL is
read whole.  Without rules and hosts every URL is allowed; without pages there are no rows.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zephyrine.llm.text import lower_ascii
from zephyrine.session import cut_lineage, scratch_path

ALLOW, BLOCK, LISTED = 0, 1, 2
_NAMES = ("digests", "kinds", "ends", "strings")


def host_and_path(url: Column) -> tuple[Column, Column]:
    begin = F.instr(url, "://")
    rest = F.coalesce(F.when(begin > 0, F.substr(url, begin + 3)), F.lit(""))
    return (
        lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)),
        F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
    )


class UrlIndex:
    """The rules' arrays as files; ``parts`` names one set of files per sorted range of digests.

    ``firsts`` are the ranges' smallest digests, ascending; equal digests share a range.
    """

    def __init__(self, parts: list[str], firsts: list[int], lengths: list[int]):
        self.parts, self.firsts, self.lengths = parts, np.array(firsts, np.uint64), lengths


def build_index(rules: DataFrame, blocked_hosts: DataFrame, rows_per_part: int = 1 << 20) -> UrlIndex:
    """Index of rules (host, path, verdict) and hosts (host).

    Spark digests, deduplicates and sorts the rules; every task writes its range of about
    ``rows_per_part`` digests into the shared folder.
    """
    spark = rules.sparkSession
    kind = F.when(F.col("verdict") == "block", BLOCK).otherwise(ALLOW)
    listed = blocked_hosts.select(F.col("host").alias("name"), F.lit(LISTED).alias("kind"), F.lit(0).alias("size"))
    named = rules.select(
        F.concat("host", "path").alias("name"), kind.alias("kind"), F.length("path").alias("size")
    ).unionByName(listed)
    named = cut_lineage(
        named.filter("name is not null")
        .groupBy("name", F.expr(f"kind = {LISTED}").alias("listed"))
        .agg(F.max("kind").alias("kind"), F.max("size").alias("size"))
        .withColumn("digest", F.xxhash64("name"))
    )
    lengths = [r[0] for r in named.select("size").distinct().collect()]
    order = F.col("digest").bitwiseXOR(F.lit(-(1 << 63)))  # unsigned order
    sorted_rows = named.repartitionByRange(max(1, -(-named.count() // rows_per_part)), order).sortWithinPartitions(order, "name", "kind")
    folder = scratch_path(spark, "urls")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches) if (batches := [b for b in batches if b.num_rows]) else None
        if rows is not None:
            part, first = _write_part(folder, rows)
            yield pa.RecordBatch.from_pydict({"part": [part], "first": pa.array([first], pa.int64())})

    written = sorted_rows.select("digest", "kind", "name").mapInArrow(write, "part string, first long").collect()
    ranges = sorted((r["first"] % (1 << 64), r["part"]) for r in written)
    for _, part in ranges:
        for name in _NAMES:
            spark.sparkContext.addFile(f"{folder}/{part}-{name}.npy")
    return UrlIndex([part for _, part in ranges], [first for first, _ in ranges], sorted(lengths))


def _write_part(folder: str, rows: pa.Table) -> tuple[str, int]:
    """Write one range; its name is new, so that a repeated attempt never meets its files."""
    strings = [s.encode() for s in rows.column("name").to_pylist()]
    digests = rows.column("digest").to_numpy()
    arrays = (
        digests.view(np.uint64),
        rows.column("kind").to_numpy().astype(np.uint8),
        np.cumsum([len(s) for s in strings], dtype=np.int64),
        np.frombuffer(b"".join(strings), np.uint8),
    )
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    part = f"urls-{uuid.uuid4().hex}"
    for name, array in zip(_NAMES, arrays, strict=True):
        with store.open_output_stream(f"{root}/{part}-{name}.npy") as out:
            np.lib.format.write_array(_Writer(out), array)
    return part, int(digests[0])


class _Writer:
    """The little of a file that numpy needs to write an array."""

    def __init__(self, out):
        self.out = out

    def write(self, data) -> int:
        self.out.write(bytes(data))
        return len(data)


@functools.lru_cache(maxsize=64)
def _mapped(part: str) -> tuple[np.ndarray, ...]:
    return tuple(np.load(SparkFiles.get(f"{part}-{name}.npy"), mmap_mode="r") for name in _NAMES)


def _found(part: str, digests: np.ndarray, strings: list[bytes]) -> Iterator[tuple[int, int]]:
    """(probe, kind) of the probes whose full string is in the part."""
    keys, kinds, ends, text = _mapped(part)
    low = np.searchsorted(keys, digests, "left")
    high = np.searchsorted(keys, digests, "right")
    for probe in np.flatnonzero(high > low):
        for at in range(low[probe], high[probe]):  # more than one only if digests collide
            begin = ends[at - 1] if at else 0
            if text[begin : ends[at]].tobytes() == strings[probe]:
                yield int(probe), int(kinds[at])


def _hits(index: UrlIndex, digests: np.ndarray, strings: list[bytes]) -> Iterator[tuple[int, int]]:
    """(probe, kind) of all probes in the index; a probe is searched in the one range it may be in."""
    if not len(index.firsts) or not strings:
        return
    within = np.searchsorted(index.firsts, digests, "right") - 1
    order = np.argsort(within, kind="stable")
    edges = np.searchsorted(within[order], np.arange(len(index.firsts) + 1))
    for number in np.unique(within[within >= 0]):
        some = order[edges[number] : edges[number + 1]]
        for k, kind in _found(index.parts[number], digests[some], [strings[i] for i in some]):
            yield int(some[k]), kind


def _suffixes(host: str) -> list[str]:
    labels = host.split(".")
    return [".".join(labels[k:]) for k in range(len(labels))]


def _verdicts(index: UrlIndex, hosts: list[str], paths: list[str]) -> tuple[list, list]:
    probes: list[bytes] = []
    of: list[tuple[int, int]] = []  # the row, and the length of the host's suffix
    for row, (host, path) in enumerate(zip(hosts, paths, strict=True)):
        if host:
            for suffix in _suffixes(host):
                for size in index.lengths:
                    if size <= len(path):
                        probes.append((suffix + path[:size]).encode())
                        of.append((row, len(suffix)))
    digests = np.array([xxhash.xxh64_intdigest(p, 42) for p in probes], np.uint64)
    best: dict[int, tuple[int, int, str, int]] = {}
    listed = set()
    for probe, kind in _hits(index, digests, probes):
        row, width = of[probe]
        name = probes[probe].decode()
        if kind == LISTED:
            if len(name) == width:
                listed.add(row)
        else:
            best[row] = max(best.get(row, (-1, 0, "", 0)), (len(name), width, name, kind))
    rules = [best[r][2] if r in best else None for r in range(len(hosts))]
    verdicts = [
        ("block" if best[r][3] == BLOCK else "allow") if r in best else "block" if r in listed else "allow"
        for r in range(len(hosts))
    ]
    return rules, verdicts


def judge_urls(pages: DataFrame, index: UrlIndex, id: str = "page_id", url: str = "url") -> DataFrame:
    """(key_id, host, path, rule, verdict) per row of ``pages``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rules, verdicts = _verdicts(index, b.column("host").to_pylist(), b.column("path").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(rules, pa.string()), pa.array(verdicts, pa.string())],
                ["key_id", "host", "path", "rule", "verdict"],
            )

    plain = pages.select(F.col(f"`{id}`").cast("long").alias("key_id"), F.col(f"`{url}`").alias("url"))
    host, path = host_and_path(F.col("url"))
    return plain.select("key_id", host.alias("host"), path.alias("path")).mapInArrow(
        scan, "key_id long, host string, path string, rule string, verdict string"
    )
