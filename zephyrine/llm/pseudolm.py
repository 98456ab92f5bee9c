"""Masked pseudo-likelihood: a bidirectional window network predicts every token from both sides.

A token is a word, lower-cased.  The most frequent words of the whole corpus have numbers of their
own, all others share hashed numbers.  For each position the embeddings of the tokens on both sides
(the position itself is masked) pass a hidden layer; the number is predicted in two halves, the
high one first and the low one given the high one, each by a softmax.  A number that words share is
only a class: the word has its share of the class's count in the corpus.  One more unit of the count
is left to words the corpus doesn't have, divided by their spelling, so that the probabilities of all
words at a position sum to 1 at most.  The document's score is the sum of the conditional
log-probabilities of all its tokens.

The counts of all words are a stored table.  The most frequent of them go to the tasks, where most
tokens are looked up; all other words meet the table in a shuffled join.

Training covers all positions of all documents: the rounds share the positions of each document among
them, beginning at a hash, so that each is masked in exactly one round.  Every task trains a numpy copy
of the network on its positions by Adagrad; Spark averages the copies, weighted by positions, and the
next round begins at the average.  What comes back to the driver
is one model.  Scoring covers every token of every text.

Texts without words have no tokens and a log-likelihood of 0.  Without any token the untrained
network scores.  Repeated rows train twice and score alike.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import compress, pairwise, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zephyrine.llm.text import blank_word_array, carried, lower_ascii
from zephyrine.session import scratch_path

HALF = 32
VOCABULARY = HALF * HALF  # numbers of tokens; one more stands for the edge of the text
OWN = VOCABULARY // 2  # numbers kept for the most frequent words
NEAR = 1 << 16  # words of shared numbers whose counts go to the tasks; the others are joined
SIDE = 2  # tokens seen on each side
EMBED, HIDDEN = 8, 16
_SHIFTS = [k for k in range(2 * SIDE + 1) if k != SIDE]
_BESIDE = np.array(_SHIFTS) - SIDE
_SHAPES = {
    "embed": (VOCABULARY + 1, EMBED),
    "inner": (2 * SIDE * EMBED, HIDDEN),
    "inner_bias": (HIDDEN,),
    "high": (HIDDEN, HALF),
    "high_bias": (HALF,),
    "given": (HALF, HIDDEN),
    "low": (HIDDEN, HALF),
    "low_bias": (HALF,),
}
_GROUP = 1 << 20  # bytes of texts split and looked up at once, besides the last text's
_STEP = 1 << 10  # positions scored at once: their arrays stay in a core's cache


def new_model(seed: int = 5) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    return {
        k: np.zeros(s, np.float32) if k.endswith("bias") else rng.normal(0, 0.1, s).astype(np.float32)
        for k, s in _SHAPES.items()
    }


def _flat(model: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([model[k].ravel() for k in _SHAPES])


def _shaped(flat: np.ndarray) -> dict[str, np.ndarray]:
    cuts = np.cumsum([np.prod(s) for s in _SHAPES.values()])[:-1]
    parts = np.split(np.asarray(flat, np.float32), cuts)
    return {k: p.reshape(s) for (k, s), p in zip(_SHAPES.items(), parts, strict=True)}


def _looked_up(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    """What ``known`` has for each word, -1 for the others."""
    return np.fromiter(map(known.get, words, repeat(-1)), np.int64, len(words))


def _shared_numbers(words: list[bytes]) -> np.ndarray:
    return OWN + np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % (VOCABULARY - OWN)


def word_numbers(words: list[bytes], own: dict[bytes, int]) -> np.ndarray:
    numbers = _looked_up(words, own)
    others = numbers < 0
    numbers[others] = _shared_numbers([*compress(words, others.tobytes())])
    return numbers


def groups(texts: pa.Array) -> Iterator[slice]:
    """Texts in a row that are split together."""
    reach = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy().astype(np.int64)) // _GROUP
    cuts = [0, *(np.flatnonzero(np.diff(reach)) + 1).tolist(), len(texts)]
    return (slice(a, b) for a, b in pairwise(cuts) if b > a)


def words_in(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in order, and for each word the place of its text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    words = lists.flatten().cast(pa.binary())
    of = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy())
    kept = pc.binary_length(words).to_numpy() > 0  # blanks at the ends of a text leave empty words there
    return words.filter(pa.array(kept)), of[kept]


def _as_list(words: pa.Array) -> list[bytes]:
    return words.to_numpy(zero_copy_only=False).tolist()  # many times as fast as to_pylist


def _ends(of: np.ndarray, count: int) -> np.ndarray:
    """Where the items of each of ``count`` rows end, in a list of all; a 0 before."""
    return np.concatenate([[0], np.cumsum(np.bincount(of, minlength=count))]).astype(np.int32)


def token_numbers(text: bytes | None, own: dict[bytes, int]) -> np.ndarray:
    """Numbers of all words of a text."""
    return word_numbers((text or b"").lower().split(), own)


def windows(numbers: np.ndarray, chosen: slice = slice(None)) -> np.ndarray:
    """The tokens on both sides of the chosen positions, the edge's number beyond the ends."""
    n = len(numbers)
    padded = np.full(n + 2 * SIDE, VOCABULARY, np.int64)
    padded[SIDE : SIDE + n] = numbers
    return np.stack([padded[k : k + n][chosen] for k in _SHIFTS], axis=1)


def _below_largest(z: np.ndarray) -> np.ndarray:
    """``z`` less the largest of its column, in place."""
    z -= z.max(axis=0)
    return z


def _column_sums(z: np.ndarray) -> np.ndarray:
    """Sums of columns of ``HALF`` numbers, by eighths and then by pairs: more exact than one after the other."""
    sums = z.reshape(-1, 8, z.shape[1]).sum(axis=0)
    while len(sums) > 1:
        sums = sums[::2] + sums[1::2]
    return sums[0]


def _log_softmax(z: np.ndarray) -> np.ndarray:
    """Logarithms of the softmax of the columns, in place."""
    _below_largest(z)
    z -= np.log(_column_sums(np.exp(z)))
    return z


def _forward(m, around, numbers):
    """What the layers see and put out; the last two are the halves before their softmax, a column a position.

    Long rows: numpy takes several times as long for many short ones.
    """
    seen = m["embed"].take(around, axis=0).reshape(len(around), -1)
    hidden = seen @ m["inner"]
    hidden += m["inner_bias"]
    np.tanh(hidden, out=hidden)
    first = numbers // HALF
    told = m["given"].take(first, axis=0)
    told += hidden
    high, low = m["high"].T @ hidden.T, m["low"].T @ told.T
    high += m["high_bias"][:, None]
    low += m["low_bias"][:, None]
    return seen, hidden, told, first, high, low


def log_probabilities(m: dict[str, np.ndarray], around: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    *_, first, high, low = _forward(m, around, numbers)
    n = len(numbers)

    def picked(z: np.ndarray, at: np.ndarray) -> np.ndarray:
        held = _below_largest(z).take(at * n + np.arange(n))
        return held - np.log(_column_sums(np.exp(z, out=z)))

    return picked(high, first) + picked(low, numbers % HALF)


def _sums_by(at: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
    """Sums of the rows that go to each of ``count`` places."""
    wide = rows.shape[1]
    flat = np.arange(count * wide).reshape(count, wide).take(at, axis=0).ravel()
    return np.bincount(flat, rows.ravel(), count * wide).reshape(count, wide).astype(rows.dtype)


def _gradient(m, around, numbers) -> dict[str, np.ndarray]:
    n = len(numbers)
    seen, hidden, told, first, high, low = _forward(m, around, numbers)

    def slope(z: np.ndarray, at: np.ndarray) -> np.ndarray:
        np.exp(_log_softmax(z), out=z)
        z.reshape(-1)[at * n + np.arange(n)] -= 1
        z /= n
        return np.ascontiguousarray(z.T)

    dh, dl = slope(high, first), slope(low, numbers % HALF)
    dtold = dl @ m["low"].T
    inner = dh @ m["high"].T
    inner += dtold
    inner *= 1 - hidden * hidden
    given = _sums_by(first, dtold, HALF)
    embed = _sums_by(around.ravel(), (inner @ m["inner"].T).reshape(-1, EMBED), VOCABULARY + 1)
    return {
        "embed": embed, "inner": seen.T @ inner, "inner_bias": inner.sum(axis=0),
        "high": hidden.T @ dh, "high_bias": dh.sum(axis=0), "given": given,
        "low": told.T @ dl, "low_bias": dl.sum(axis=0),
    }


class Trainer:
    """Adagrad on masked positions, in steps of ``batch`` positions."""

    def __init__(self, model: dict[str, np.ndarray], rate: float, batch: int = 1024):
        self.flat = _flat(model)
        self.model = _shaped(self.flat)  # views of the flat model
        self.past = np.full(self.flat.shape, 1e-6, np.float32)
        self.rate, self.batch, self.positions = rate, batch, 0
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, around: np.ndarray, numbers: np.ndarray) -> None:
        self.held.append((around, numbers))
        self.waiting += len(numbers)
        self.positions += len(numbers)
        if self.waiting >= self.batch:
            self.step()

    def step(self) -> None:
        if not self.waiting:
            return
        around, numbers = (np.concatenate(x) for x in zip(*self.held, strict=True))
        self.held, self.waiting = [], 0
        for k in range(0, len(numbers), self.batch):
            part = slice(k, k + self.batch)
            g = _flat(_gradient(self.model, around[part], numbers[part]))
            self.past += g * g
            self.flat -= self.rate * g / np.sqrt(self.past)


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, count) of every word of all documents, stored."""
    words = docs.select(F.explode(blank_word_array(lower_ascii(F.col(f"`{text}`")))).alias("word"))
    path = scratch_path(docs.sparkSession, "words")
    words.groupBy("word").count().write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def frequent_words(
    docs: DataFrame, text: str = "text", count: int = OWN, counts: DataFrame | None = None
) -> dict[bytes, int]:
    """Numbers of the ``count`` most frequent words, counted over all documents."""
    counts = word_counts(docs, text) if counts is None else counts
    top = counts.orderBy(F.desc("count"), "word").limit(count).collect()
    return {r["word"].encode(): n for n, r in enumerate(top)}


def unseen_log_share(size: int) -> float:
    """Logarithm of an unseen word's part of the unit left to all of them; ``size`` is in bytes.

    Every byte and the end are one of 257 signs, so the parts of all spellings sum to 1.
    """
    return -(size + 1) * math.log(257)


def count_beyond(counts: DataFrame, most: int) -> int:
    """The smallest count that at most ``most`` words exceed, from histograms of the counts.

    Bins are eighths of a power of two; the one the limit falls into is then split by its single counts.
    """
    bin_ = F.floor(F.log2(F.col("count").cast("double")) * 8).alias("value")

    def reach(rows: DataFrame, value, room: int) -> tuple[int | None, int]:
        """The largest value whose words do not fit in any more, and the room left before it."""
        for r in sorted(rows.groupBy(value).agg(F.count("*").alias("n")).collect(), reverse=True):
            if r["n"] > room:
                return r["value"], room
            room -= r["n"]
        return None, room

    place, room = reach(counts, bin_, most)
    if place is None:
        return 0
    exact, _ = reach(counts.filter(bin_ == place), F.col("count").alias("value"), room)
    return exact


def shared_counts(
    counts: DataFrame, own: dict[bytes, int], near: int = NEAR
) -> tuple[DataFrame, np.ndarray, dict[bytes, int], bool]:
    """Counts of the words that share numbers: (word, count), the sum of each shared number, the largest counts, and
    whether these are all of them."""
    spread = VOCABULARY - OWN
    shared = counts.filter(~F.col("word").isin([w.decode() for w in own])) if own else counts
    totals = np.zeros(spread)
    number = (F.crc32(F.col("word").cast("binary")) % spread).alias("number")
    for r in shared.groupBy(number).agg(F.sum("count").alias("n")).collect():
        totals[r["number"]] = r["n"]
    cut = count_beyond(shared, near)
    top = shared.filter(F.col("count") > cut).collect()
    return shared, totals, {r["word"].encode(): r["count"] for r in top}, cut == 0


def positions_of_round(hash_: int, turn: int, rounds: int) -> slice:
    """The positions of a text that are masked in round ``turn``; the rounds together have them all."""
    return slice((hash_ + turn) % rounds, None, rounds)


def train(
    docs: DataFrame,
    own: dict[bytes, int],
    id: str = "doc_id",
    text: str = "text",
    rounds: int = 2,
    rate: float = 0.1,
) -> dict[str, np.ndarray]:
    """The averaged network; every position of every document is trained in one of the rounds.

    The texts become numbers once; the rounds read these from the cluster's disks.
    """
    rows = carried(docs, id, text).select("key_hash", "body")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in groups(b.column("body")):
                hashes, texts = b.column("key_hash")[part], b.column("body")[part]
                words, of = words_in(texts)
                coded = words.dictionary_encode()
                numbers = word_numbers(_as_list(coded.dictionary), own).astype(np.uint16)[coded.indices.to_numpy()]
                buffers = [None, pa.py_buffer(_ends(of, len(texts)) * 2), pa.py_buffer(numbers)]
                held = pa.Array.from_buffers(pa.binary(), len(texts), buffers)
                yield pa.RecordBatch.from_arrays([hashes, held], ["key_hash", "numbers"])

    numbered = rows.mapInArrow(number, "key_hash long, numbers binary").persist(StorageLevel.DISK_ONLY)
    try:
        numbered.count()  # a round beside the numbering would have two Python workers in each task
        return _trained(numbered, rounds, rate)
    finally:
        numbered.unpersist()


def _trained(numbered: DataFrame, rounds: int, rate: float) -> dict[str, np.ndarray]:
    model = new_model()
    for turn in range(rounds):

        def scan(batches: Iterator[pa.RecordBatch], begin=model, turn=turn) -> Iterator[pa.RecordBatch]:
            trainer = Trainer(begin, rate)
            for b in batches:
                for held, hash_ in zip(b.column("numbers"), b.column("key_hash").to_pylist(), strict=True):
                    numbers = np.frombuffer(held.as_buffer(), np.uint16).astype(np.int64)
                    chosen = positions_of_round(hash_, turn, rounds)
                    if len(numbers[chosen]):
                        trainer.add(windows(numbers, chosen), numbers[chosen])
            trainer.step()
            if trainer.positions:
                made = [[trainer.positions], [trainer.flat.astype(np.float64).tolist()]]
                kinds = [pa.int64(), pa.list_(pa.float64())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, k) for v, k in zip(made, kinds, strict=True)], ["n", "model"]
                )

        copies = numbered.mapInArrow(scan, "n long, model array<double>")
        mean = (
            copies.select("n", F.posexplode("model").alias("at", "value"))
            .groupBy("at")
            .agg((F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("value"))
            .collect()
        )
        if mean:
            flat = np.zeros(len(mean))
            for r in mean:
                flat[r["at"]] = r["value"]
            model = _shaped(flat)
    return model


def score_documents(
    docs: DataFrame,
    model: dict[str, np.ndarray],
    own: dict[bytes, int],
    id: str = "doc_id",
    text: str = "text",
    counts: DataFrame | None = None,
    near: int = NEAR,
) -> DataFrame:
    """(key_id, n_tokens, log_likelihood) per row of ``docs``.

    ``counts`` are the word counts of the corpus, by default of ``docs``.
    """
    shared, totals, top, all_known = shared_counts(word_counts(docs, text) if counts is None else counts, own, near)
    # A class without any word is left to unseen words as a whole.
    scale = np.concatenate([np.zeros(OWN), np.log(totals + 1)])
    # Words the tasks know: by their places, their numbers and the logarithms of their counts.
    listed = [w for w in top if w not in own]
    known = pa.array([*own, *listed], pa.binary())
    number_at = np.array([*own.values(), *_shared_numbers(listed)], np.int64)
    share_at = np.array([*repeat(0.0, len(own)), *(math.log(top[w]) for w in listed)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in groups(b.column("body")):
                ids, texts = b.column("key_id")[part], b.column("body")[part]
                words, of = words_in(texts)
                places = pc.index_in(words, value_set=known).fill_null(-1).to_numpy()
                other = places < 0
                others = words.filter(pa.array(other))
                numbers, shares = np.empty(len(words), np.int64), np.zeros(len(words))
                numbers[~other], shares[~other] = number_at[places[~other]], share_at[places[~other]]
                numbers[other] = _shared_numbers(_as_list(others))
                if all_known:
                    shares[other] = (pc.binary_length(others).to_numpy() + 1) * unseen_log_share(0)
                # Two texts have the edges between them in common.
                at = np.arange(len(words)) + SIDE * (of + 1)
                padded = np.full(len(words) + SIDE * (len(texts) + 1), VOCABULARY, np.int64)
                padded[at] = numbers
                sums = np.zeros(len(texts))
                for k in range(0, len(words), _STEP):
                    step = slice(k, k + _STEP)
                    around = padded.take(at[step, None] + _BESIDE)
                    logs = log_probabilities(model, around, numbers[step]) - scale[numbers[step]] + shares[step]
                    sums += np.bincount(of[step], logs, minlength=len(texts))
                sizes = np.bincount(of, minlength=len(texts))
                made = {"key_id": ids, "n_tokens": pa.array(sizes), "log_likelihood": pa.array(sums)}
                if not all_known:
                    made["rare"] = pa.ListArray.from_arrays(pa.array(_ends(of[other], len(texts))), others)
                yield pa.RecordBatch.from_pydict(made)

    rows = carried(docs, id, text).select("key_id", "body")
    kinds = "key_id long, n_tokens long, log_likelihood double"
    if all_known:
        return rows.mapInArrow(scan, kinds)
    found = rows.mapInArrow(scan, f"{kinds}, rare array<binary>")
    lone = found.withColumn("row_no", F.monotonically_increasing_id()).select(
        "row_no", "key_id", "n_tokens", "log_likelihood", F.explode_outer("rare").alias("word")
    )
    # Rows without a rare word are dealt by a key no word equals, since words have no blanks.
    key = F.coalesce("word", F.concat(F.lit(" "), F.col("row_no").cast("string")).cast("binary"))
    table = shared.select(F.col("word").cast("binary").alias("key"), "count")
    unseen = (F.octet_length("word") + 1) * unseen_log_share(0)
    share = F.when(F.col("word").isNull(), 0.0).otherwise(F.coalesce(F.log("count"), unseen))
    return (
        lone.withColumn("key", key)
        .join(table, "key", "left")
        .groupBy("row_no")
        .agg(
            F.first("key_id").alias("key_id"),
            F.first("n_tokens").alias("n_tokens"),
            (F.first("log_likelihood") + F.sum(share)).alias("log_likelihood"),
        )
        .drop("row_no")
    )
