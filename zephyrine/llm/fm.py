"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

    logit(x) = b + w.x + 1/2 * sum_f ((x.v_f)^2 - x^2.v_f^2)

The last term is the sum of all pairwise interactions <v_i, v_j> x_i x_j, in time linear in the
features (Rendle 2010).  Features are a document's hashed word frequencies, shares that describe
its structure, and the size class recorded in its metadata; never labels, language, source or id.

Training takes labelled rows outside the held-out fold, at most about ``sample_rows`` of them,
chosen by a hash of the id.  One Spark task fits the bounded sample; the model (a few thousand
numbers) comes back and scores all documents in Arrow batches.

Conflicting labels of an id are averaged.  Of documents with equal ids one is learned from, so that a
repeated id adds nothing to the sample.  Without labels every score is the prior 0.5.  Empty and
null texts have the features of an empty text and get its score.  Null ids are never held out.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 10
STRUCTURE = 16
SIZES = 24  # classes of the recorded size, the last one for none
WIDTH = BUCKETS + STRUCTURE + SIZES
FACTORS = 8
_SIGNS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_DIGIT = bytes(range(48, 58))
_STOPS = b".,;:!?"


def _share(part: float, whole: float) -> float:
    return part / whole if whole else 0.0


def features(text: bytes | None, size: int | None) -> np.ndarray:
    """The feature vector of one whole text; ``size`` is the recorded number of characters."""
    text = text or b""
    x = np.zeros(WIDTH, np.float32)
    words = text.split()
    n = len(words)
    counts = Counter(words)
    for word, times in counts.items():
        x[zlib.crc32(word) % BUCKETS] += times
    norm = float(np.sqrt((x * x).sum()))
    if norm:
        x /= norm
    lines = text.split(b"\n")
    full = [line for line in lines if line.strip()]
    chars = len(text)

    def removed(signs: bytes) -> int:
        return chars - len(text.translate(None, signs))

    x[BUCKETS : BUCKETS + STRUCTURE] = (
        1.0,
        min(np.log1p(n) / 10, 2),
        n < 50,
        min(_share(removed(_SIGNS), n), 3),
        _share(removed(_UPPER), chars),
        _share(removed(_DIGIT), chars),
        min(_share(removed(_STOPS), n), 2),
        min(_share(text.count(b"!"), n), 2),
        min(_share(text.count(b"|"), n), 2),
        _share(len(counts), n),
        _share(sum(a == b for a, b in zip(words, words[1:], strict=False)), n),
        _share(max(counts.values(), default=0), n),
        _share(len(full) - len(set(full)), len(full)),
        min(_share(n, len(full)) / 100, 3),
        min(_share(chars, n) / 10, 3),
        _share(sum(line.rstrip().endswith((b".", b"!", b"?")) for line in full), len(full)),
    )
    known = size is not None and size >= 0
    x[BUCKETS + STRUCTURE + (min(int(size).bit_length(), SIZES - 2) if known else SIZES - 1)] = 1
    return x


def logits(x: np.ndarray, b: float, w: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Scores of a batch by the sum-of-squares identity."""
    mixed = x @ v
    return b + x @ w + 0.5 * ((mixed * mixed) - (x * x) @ (v * v)).sum(axis=1)


def fit(x: np.ndarray, y: np.ndarray, epochs: int = 40, batch: int = 256, rate: float = 0.05, decay: float = 1e-5):
    """(b, w, v) by Adagrad on the logistic loss."""
    rng = np.random.default_rng(7)
    w, v = np.zeros(x.shape[1], np.float32), rng.normal(0, 0.05, (x.shape[1], FACTORS)).astype(np.float32)
    if not len(y):
        return 0.0, w, v * 0
    rate_of_ones = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    b = float(np.log(rate_of_ones / (1 - rate_of_ones)))
    gb, gw, gv = 1e-8, np.full_like(w, 1e-8), np.full_like(v, 1e-8)
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(y)), -(-len(y) // batch)):
            part = x[rows]
            error = (_probability(logits(part, b, w, v)) - y[rows]).astype(np.float32) / len(rows)
            mixed = part @ v
            db, dw = float(error.sum()), part.T @ error + decay * w
            dv = part.T @ (error[:, None] * mixed) - v * ((part * part).T @ error)[:, None] + decay * v
            gb, gw, gv = gb + db * db, gw + dw * dw, gv + dv * dv
            b -= rate * db / gb**0.5
            w -= rate * dw / np.sqrt(gw)
            v -= rate * dv / np.sqrt(gv)
    return b, w, v


def _probability(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def held_out(id: Column, folds: int = 5) -> Column:
    """Whether crc32 of the id as text leaves no remainder."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def _matrix(batch) -> np.ndarray:
    texts, sizes = batch.column("body").to_pylist(), batch.column("size").to_pylist()
    return np.stack([features(t, s) for t, s in zip(texts, sizes, strict=True)])


def _inputs(docs: DataFrame, id: str, text: str, size: str) -> DataFrame:
    recorded = F.col(f"`{size}`").cast("long") if size in docs.columns else F.lit(None).cast("long")
    return docs.select(
        F.col(f"`{id}`").cast("long").alias("key_id"),
        F.col(f"`{text}`").cast("binary").alias("body"),
        recorded.alias("size"),
    )


def train(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    size: str = "n_chars",
    label: str = "quality",
    sample_rows: int = 16_000,
) -> tuple[float, np.ndarray, np.ndarray]:
    """The model (b, w, v) from about ``sample_rows`` labelled rows outside the held-out fold."""
    known = (
        labels.select(F.col(f"`{id}`").cast("long").alias("key_id"), F.col(f"`{label}`").alias("y"))
        .filter("key_id is not null and y is not null")
        .filter(~held_out(F.col("key_id")))
        .groupBy("key_id")
        .agg((F.avg("y") >= 0.5).cast("int").alias("y"))
    )
    total = known.count()
    if total > sample_rows:
        known = known.filter(F.pmod(F.xxhash64("key_id"), F.lit(1 << 20)) < (1 << 20) * sample_rows // total)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                made = pa.array([row.tobytes() for row in _matrix(b).astype(np.float16)], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column("key_id"), b.column("y"), made], ["key_id", "y", "x"])

    def fitted(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("key_id", "ascending"), ("x", "ascending")])
        x = np.stack([np.frombuffer(r, np.float16) for r in rows.column("x").to_pylist()]).astype(np.float32)
        b, w, v = fit(x, rows.column("y").to_numpy().astype(np.float32))
        flat = np.concatenate([[b], w, v.ravel()]).astype(np.float64)
        return pa.table({"model": pa.array([flat.tolist()], pa.list_(pa.float64()))})

    rows = _inputs(docs, id, text, size).join(known, "key_id")
    sample = rows.mapInArrow(vectors, "key_id long, y int, x binary")
    sample = sample.groupBy("key_id").agg(F.max("y").alias("y"), F.min("x").alias("x"))
    model = sample.withColumn("one", F.lit(0)).groupBy("one").applyInArrow(fitted, "model array<double>").collect()
    flat = np.array(model[0]["model"] if model else np.zeros(1 + WIDTH * (1 + FACTORS)), np.float32)
    return float(flat[0]), flat[1 : 1 + WIDTH], flat[1 + WIDTH :].reshape(WIDTH, FACTORS)


def score_quality(docs: DataFrame, model, id: str = "doc_id", text: str = "text", size: str = "n_chars") -> DataFrame:
    """(key_id, held_out, score) per row of ``docs``; ``score`` is the probability of label 1."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 512):
                part = b.slice(k, 512)
                z = logits(_matrix(part), *model)
                score = pa.array(_probability(z.astype(np.float64)), pa.float64())
                yield pa.RecordBatch.from_arrays([part.column("key_id"), score], ["key_id", "score"])

    scored = _inputs(docs, id, text, size).mapInArrow(scan, "key_id long, score double")
    return scored.select("key_id", held_out(F.col("key_id")).alias("held_out"), "score")
