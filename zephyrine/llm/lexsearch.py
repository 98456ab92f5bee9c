"""Ranked lexical search: posting lists cut into geometric blocks with coordinatewise-maximum summaries.

A document is the vector of its terms' contributions ``1e9 * tf div (1000 * tf + 8 * m)``, where m follows
from the document's length; a query weighs each of its terms once, and a score is the inner product, in whole
numbers.  The search is exact:

* Queries are taken in blocks of at most about ``block_terms`` terms.  Per block one pass splits every whole
  document and keeps the terms that some query of the block has (stored); corpus counts follow from it.
* Every document gets a 64-bit geometric code, the signs of its weighted vector's products with random
  directions, so similar documents have close codes.  All documents are sorted by code (a range shuffle; equal
  codes, as of copies, are dealt out by a row number).  Each term's posting list thereby is in the order of
  document similarity, and is cut into blocks of at most ``BLOCK_DOCS`` neighbours (``CHUNK_DOCS`` for a term that
  shares queries with very many others).
* Per block the index stores the maximum of every coordinate that a query asks for along with the term.
  Rows of the index are bounded: ``CHUNK_DOCS`` documents, ``CHUNK_CELLS`` cells of documents by terms.
* A query visits the lists of its essential terms only: those left when the terms of the smallest maxima are
  taken away as long as they cannot reach the threshold together.  A block is skipped only if its summary's
  score stays below the threshold, which is the lowest of ``top`` scores that documents have already.  A first
  round over every ``SEED_SHARE``-th index row finds a threshold per query, a second one visits all rows.

Documents without terms (null, empty) are not counted; a term's weight may be 0, and scores of 0 are left out.  A
repeated document row ranks once per row.  Equal scores rank by ascending id, a null id first.  Query rows of
equal id and terms are searched once and returned once per row; a query of a repeated id is ranked by itself, null ids
are ids; a query without terms has no rows.  Very long documents take an index row of their own.  Without documents
or queries there are no rows.  Columns besides id and text are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zephyrine.llm import text as words
from zephyrine.session import scratch_path

BLOCK_DOCS = 32
CHUNK_DOCS = 256
CHUNK_CELLS = 1 << 23
SEED_SHARE = 16
#: Index rows per file: readers hold the arrays of so many rows at once.
FILE_ROWS = 16
#: A term with more partners than this in the queries has one block per index row, with a summary over all terms.
MOST_PARTNERS = 1 << 10

#: Bytes to lower case; ASCII that is no part of a term becomes a space.
_TO_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))

INDEX = (
    "chunk long, ids array<long>, ends array<int>, terms array<int>, impacts array<int>, "
    "list_terms array<int>, list_ends array<int>, block_docs array<int>, members array<int>, "
    "summary_ends array<int>, summary_terms array<int>, maxima array<int>"
)
_FIELDS = [part.split()[0] for part in INDEX.split(", ")]
_COUNTED = "key_id long, n long, terms array<int>, tfs array<int>"


def split_terms(text: bytes | None) -> list[bytes]:
    """The terms of a whole UTF-8 text in order: runs of ASCII letters, digits and non-ASCII, in lower case."""
    return (text or b"").translate(_TO_TERMS).split()


def _lists(parts: list, kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    flat = np.concatenate([np.asarray(p) for p in parts]) if parts else np.array([])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat).cast(kind))


def count_terms(docs: DataFrame, vocabulary, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(key_id, n, terms, tfs) per document with a term; ``vocabulary`` is a broadcast {term: number}."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for b in batches:
            keys, sizes, terms, tfs = [], [], [], []
            for key, body in zip(b.column("key_id").to_pylist(), b.column("body"), strict=True):
                found = split_terms(body.as_py())
                if found:
                    picked = sorted((known[w], times) for w, times in Counter(found).items() if w in known)
                    keys.append(key)
                    sizes.append(len(found))
                    terms.append([t for t, _ in picked])
                    tfs.append([times for _, times in picked])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(terms, pa.list_(pa.int32())),
                    pa.array(tfs, pa.list_(pa.int32())),
                ],
                ["key_id", "n", "terms", "tfs"],
            )

    rows = docs.select(
        F.col(f"`{id}`").cast("long").alias("key_id"), F.col(f"`{text}`").cast("binary").alias("body")
    )
    return rows.mapInArrow(scan, _COUNTED)


def _flat(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False)


def _ends(batch: pa.RecordBatch, name: str) -> np.ndarray:
    offsets = batch.column(name).offsets.to_numpy()
    return offsets - offsets[0]


def place_documents(counted: DataFrame, n_docs: int, n_terms: int, weights: np.ndarray, seed: int = 1) -> DataFrame:
    """(key_id, terms, impacts, code): contributions and geometric code of documents with a query term."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions = np.random.default_rng(seed).choice(np.array([-1, 1], np.float32), (len(weights), 64))
        bits = np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64)
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                b = whole.slice(k, 256)
                terms, tfs, ends = _flat(b, "terms"), _flat(b, "tfs").astype(np.int64), _ends(b, "terms")
                m = 10 + (90 * b.column("n").to_numpy() * n_docs) // n_terms
                impacts = (1_000_000_000 * tfs) // (1000 * tfs + 8 * np.repeat(m, np.diff(ends)))
                codes = []
                for a, z in zip(ends[:-1], ends[1:], strict=True):
                    side = (weights[terms[a:z]] * impacts[a:z]).astype(np.float32) @ directions[terms[a:z]]
                    codes.append(int(bits[side > 0].sum(dtype=np.uint64)) - (1 << 63))
                made = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(impacts.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [b.column("key_id"), b.column("terms"), made, pa.array(codes, pa.int64())],
                    ["key_id", "terms", "impacts", "code"],
                )

    return counted.filter(F.size("terms") > 0).mapInArrow(
        scan, "key_id long, terms array<int>, impacts array<int>, code long"
    )


class _Partners:
    """Which terms share a query with a term; None for every term."""

    def __init__(self, queries: list[np.ndarray]):
        self.queries, self.having, self.known = queries, {}, {}
        for number, terms in enumerate(queries):
            for t in terms.tolist():
                self.having.setdefault(t, []).append(number)

    def of(self, term: int) -> np.ndarray | None:
        if term not in self.known:
            shared = [self.queries[q] for q in self.having.get(term, [])]
            wide = sum(map(len, shared)) > MOST_PARTNERS
            self.known[term] = None if wide else np.unique(np.concatenate(shared)) if shared else np.array([], np.int32)
        return self.known[term]


def _places(local: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """Where those of ``terms`` that ``local`` has stand there; both are in order."""
    at = np.searchsorted(local, terms)
    return at[(at < len(local)) & (local[np.minimum(at, len(local) - 1)] == terms)]


def _dense(docs: list) -> tuple[np.ndarray, np.ndarray]:
    """(terms, cells): the terms of the documents in order, and every document's contributions to them."""
    local, column = np.unique(np.concatenate([terms for _, terms, _ in docs]), return_inverse=True)
    cells = np.zeros((len(docs), len(local)), np.int32)
    row = np.repeat(np.arange(len(docs)), [len(terms) for _, terms, _ in docs])
    cells[row, column] = np.concatenate([impacts for _, _, impacts in docs])
    return local, cells


def _index_row(number: int, docs: list, partners: _Partners) -> dict:
    """One row of the index: the documents, each term's list, and the summaries of the list's blocks."""
    local, cells = _dense(docs)
    members, block_docs, summary_terms, maxima = [], [], [], []
    for column, term in enumerate(local.tolist()):
        holding = np.flatnonzero(cells[:, column])
        near = partners.of(term)
        wanted = np.arange(len(local)) if near is None else _places(local, near)
        block_docs.append(CHUNK_DOCS if near is None else BLOCK_DOCS)
        starts = np.arange(0, len(holding), block_docs[-1])
        tops = np.maximum.reduceat(cells[np.ix_(holding, wanted)], starts, axis=0)
        used = tops.any(axis=0)
        members.append(holding)
        summary_terms.append(local[wanted[used]])
        maxima.append(tops[:, used].ravel())
    return {
        "chunk": number,
        "ids": [key for key, _, _ in docs],
        "ends": np.cumsum([len(terms) for _, terms, _ in docs]),
        "terms": np.concatenate([terms for _, terms, _ in docs]),
        "impacts": np.concatenate([impacts for _, _, impacts in docs]),
        "list_terms": local,
        "list_ends": np.cumsum([len(x) for x in members]),
        "block_docs": block_docs,
        "members": np.concatenate(members),
        "summary_ends": np.cumsum([len(x) for x in summary_terms]),
        "summary_terms": np.concatenate(summary_terms),
        "maxima": np.concatenate(maxima),
    }


def build_index(placed: DataFrame, queries) -> DataFrame:
    """Rows of ``INDEX`` over all documents of ``placed``; ``queries`` broadcasts the term numbers of each."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partners = _Partners(queries.value)
        number = TaskContext.get().partitionId() << 40
        held, size = [], 0

        def row(docs: list) -> pa.RecordBatch:
            made = _index_row(number, docs, partners)
            arrays = [pa.array([made["chunk"]], pa.int64()), pa.array([made["ids"]], pa.list_(pa.int64()))]
            arrays += [_lists([made[name]], pa.int32()) for name in _FIELDS[2:]]
            return pa.RecordBatch.from_arrays(arrays, _FIELDS)

        for b in batches:
            keys, terms, impacts = b.column("key_id").to_pylist(), _flat(b, "terms"), _flat(b, "impacts")
            ends = _ends(b, "terms")
            for k, key in enumerate(keys):
                own = slice(ends[k], ends[k + 1])
                grown = size + int(ends[k + 1] - ends[k])
                if held and (len(held) >= CHUNK_DOCS or (len(held) + 1) * grown > CHUNK_CELLS):
                    yield row(held)
                    number += 1
                    held, grown = [], int(ends[k + 1] - ends[k])
                held.append((key, terms[own].copy(), impacts[own].copy()))
                size = grown
        if held:
            yield row(held)

    # A number per stored row deals out the rows of one code, however many copies a document has.
    numbered = placed.withColumn("deal", F.monotonically_increasing_id())
    ordered = numbered.repartitionByRange("code", "deal").sortWithinPartitions("code", "deal")
    return ordered.drop("code", "deal").mapInArrow(scan, INDEX)


def _essential(reach: np.ndarray, least: int) -> np.ndarray:
    """Places of the terms whose lists have to be visited: the others cannot reach ``least`` together."""
    order = np.argsort(reach, kind="stable")
    return order[np.searchsorted(np.cumsum(reach[order]), least, side="left") :]


def _survivors(row: dict, places: np.ndarray, weights: np.ndarray, lists: np.ndarray, least: int) -> np.ndarray:
    """Documents of an index row in a block whose summary reaches ``least``."""
    found = []
    for place in lists.tolist():
        begin, end, width = row["list_begins"][place], row["list_ends"][place], row["block_docs"][place]
        first, last = row["summary_begins"][place], row["summary_ends"][place]
        blocks = -(-(end - begin) // width)
        asked = row["list_terms"][places]
        held = row["summary_terms"][first:last]
        at = np.searchsorted(held, asked)
        known = (at < len(held)) & (held[np.minimum(at, len(held) - 1)] == asked)
        start = row["maxima_begins"][place]
        tops = row["maxima"][start : start + blocks * len(held)].reshape(blocks, len(held))
        bounds = tops[:, at[known]].astype(np.int64) @ weights[known]
        for block in np.flatnonzero(bounds >= least).tolist():
            found.append(row["members"][begin + block * width : min(end, begin + (block + 1) * width)])
    return np.unique(np.concatenate(found)) if found else np.array([], np.int64)


def _opened(batch: pa.RecordBatch, k: int) -> dict:
    """An index row as arrays, with where each list, summary and its maxima begin."""
    row = {name: batch.column(name)[k].values.to_numpy(zero_copy_only=False) for name in _FIELDS[2:]}
    row["ids"] = batch.column("ids")[k].as_py()
    for name in ("list", "summary"):
        row[f"{name}_begins"] = np.concatenate([[0], row[f"{name}_ends"][:-1]])
    blocks = -(-(row["list_ends"] - row["list_begins"]) // row["block_docs"])
    sizes = blocks * (row["summary_ends"] - row["summary_begins"])
    row["maxima_begins"] = np.concatenate([[0], np.cumsum(sizes.astype(np.int64))[:-1]])
    return row


def visit(index: DataFrame, queries, weights, floors, top: int) -> DataFrame:
    """(query, key_id, score): per task the ``top`` best documents of every query that reach its floor.

    ``queries`` broadcasts the term numbers of each query, ``weights`` all terms' weights, ``floors`` a lower bound
    of each query's ``top``-th score (1 without one).
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weight = queries.value, weights.value
        least = np.maximum(floors.value, 1)
        best: list[list] = [[] for _ in asked]
        for b in batches:
            for k in range(b.num_rows):
                row = _opened(b, k)
                local = row["list_terms"]
                docs = np.split(row["terms"], row["ends"][:-1]), np.split(row["impacts"], row["ends"][:-1])
                _, cells = _dense(list(zip(row["ids"], *docs, strict=True)))
                tops = cells.max(axis=0).astype(np.int64)
                for q, terms in enumerate(asked):
                    places = _places(local, terms)
                    w = weight[local[places]]
                    reach = w * tops[places]
                    if reach.sum() < least[q]:
                        continue
                    rows = _survivors(row, places, w, places[_essential(reach, least[q])], least[q])
                    if not len(rows):
                        continue
                    scores = cells[np.ix_(rows, places)].astype(np.int64) @ w
                    new = [
                        (-int(s), row["ids"][d] is not None, row["ids"][d])
                        for s, d in zip(scores, rows.tolist(), strict=True)
                        if s >= least[q]
                    ]
                    best[q] = heapq.nsmallest(top, best[q] + new, key=lambda x: (x[0], x[1], x[2] or 0))
                    if len(best[q]) == top:
                        least[q] = max(least[q], -best[q][-1][0])
        found = [(q, key, -score) for q, held in enumerate(best) for score, _, key in held]
        kinds = (pa.int32(), pa.int64(), pa.int64())
        arrays = [pa.array([f[c] for f in found], kind) for c, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(arrays, ["query", "key_id", "score"])

    return index.mapInArrow(scan, "query int, key_id long, score long")


def _best(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("key_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _search_block(docs: DataFrame, block: list, id: str, text: str, top: int) -> DataFrame | None:
    """(query, key_id, score, rank) for a block of queries (number, terms); None if there are no documents."""
    spark = docs.sparkSession
    context = spark.sparkContext
    terms = sorted({t for _, own in block for t in own})
    number = {t: k for k, t in enumerate(terms)}
    asked = [np.array(sorted(number[t] for t in own), np.int32) for _, own in block]
    vocabulary = context.broadcast({t.encode(): k for t, k in number.items()})

    folder = scratch_path(spark, "lexical-search")
    count_terms(docs, vocabulary, id, text).write.parquet(f"{folder}/counted")
    counted = spark.read.parquet(f"{folder}/counted")
    n_docs, n_terms = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_docs:
        return None
    weights = np.zeros(len(terms), np.int64)
    holding = counted.select(F.explode("terms").alias("term")).groupBy("term").count()
    for term, df in holding.collect():  # one number per term of the block
        weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))

    queries, weighed = context.broadcast(asked), context.broadcast(weights)
    placed = place_documents(counted, n_docs, n_terms, weights)
    placed.write.parquet(f"{folder}/placed")
    built = build_index(spark.read.parquet(f"{folder}/placed"), queries)
    built.write.option("maxRecordsPerFile", FILE_ROWS).parquet(f"{folder}/index")
    index = spark.read.parquet(f"{folder}/index")
    floors = np.zeros(len(asked), np.int64)
    seeds = visit(
        index.filter(F.pmod(F.xxhash64("chunk"), F.lit(SEED_SHARE)) == 0),
        queries, weighed, context.broadcast(floors), top,
    )
    for row in _best(seeds, top).filter(F.col("rank") == top).select("query", "score").collect():
        floors[row["query"]] = row["score"]
    return _best(visit(index, queries, weighed, context.broadcast(floors), top), top)


def search(
    docs: DataFrame,
    items: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    top: int = 10,
    block_terms: int = 100_000,
) -> DataFrame:
    """(item_id, rank, key_id, score): the ``top`` documents of every row of ``items``."""
    spark = docs.sparkSession
    body = F.array_sort(F.array_distinct(words.word_array(F.col(f"`{item_text}`"))))
    asked = items.select(F.col(f"`{item_id}`").alias("item_id"), body.alias("terms")).filter(F.size("terms") > 0)
    asked = asked.groupBy("item_id", "terms").count()
    folder = scratch_path(spark, "lexical-queries")
    asked.write.parquet(folder)
    asked = spark.read.parquet(folder)
    total = asked.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_terms))
    results = []
    for k in range(blocks):
        of_block = F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)) == k
        rows = asked.filter(of_block).collect()  # about block_terms terms
        found = _search_block(docs, [(n, r["terms"]) for n, r in enumerate(rows)], id, text, top) if rows else None
        if found is not None:
            names = spark.createDataFrame(
                [(n, r["item_id"], r["count"]) for n, r in enumerate(rows)],
                f"query int, item_id {asked.schema['item_id'].dataType.simpleString()}, copies long",
            )
            results.append(found.join(names, "query"))
    if not results:
        kind = asked.schema["item_id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, key_id long, score long")
    whole = results[0]
    for more in results[1:]:
        whole = whole.unionByName(more)
    return whole.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(
        "item_id", "rank", "key_id", "score"
    )
