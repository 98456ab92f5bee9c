"""Spelling variants: words one edit apart, found by pivotal grams.

Every word has the bigrams at all its places.  With all bigrams ordered by rarity, its prefix is the three
rarest (and all others as frequent as the third).  Among the prefix, dynamic programming picks the two disjoint
bigrams that the fewest words should share at their places, its pivots.  One edit leaves at least one of two disjoint bigrams as it is; so for
two words one edit apart, a pivot of the word whose prefix ends rarer is in the prefix of the other word.

Position limit: the edit lies on one side of the common bigram, so the bigram stands equally far from the word's other
end in both words, and what lies between is equal as well.  A pivot therefore meets prefix bigrams by the word's
beginning up to the bigram, or its end from the bigram on.  Lengths differ by one at most.  On the side that may hold the
edit, the letter next to the bigram or the two at the word's other end are equal, since the edit is not at both.  What
is left is verified by edit distance.  No bigram, key or word is left out; keys that very many prefixes share are dealt out
over parts, and the pivots of such a key are copied to all its parts.

Words: maximal runs of ASCII letters and the characters from U+00C0 to U+00FF of whole texts, A-Z in lower case.  If
``noise`` divides the CRC-32 of "<id>:<run>", the run loses a character (planted misspellings).  Words have at least
``least_length`` characters and ``least_count`` occurrences.  A null text has no words, a null id counts as an empty
one.  Repeated rows count each.  Ties of the most frequent near word go to the smallest in code-point order.  Empty
tables give no rows; columns besides id and text are ignored, whatever their names.  Very long texts are split
whole; a task hands its counts on whenever it holds ``HELD_WORDS`` distinct words.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zephyrine.session import cut_lineage, scratch_path

HELD_WORDS = 200_000
#: Prefixes of one key that a task meets at most, about.
KEY_ROWS = 20_000
SPREAD = 4.0

#: Latin-1 to lower case; what is no letter of a run becomes a space.
_TO_RUNS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256)
)


def split_runs(text: str | None) -> list[bytes]:
    """The runs of a whole text in order, in lower case, as Latin-1; other characters end a run."""
    return (text or "").encode("latin-1", "replace").translate(_TO_RUNS).split()


def misspelt(key: int | None, runs: Counter, noise: int) -> Counter:
    """Counts after the planted deletions of the document ``key``."""
    start = zlib.crc32(f"{'' if key is None else key}:".encode())
    made: Counter = Counter()
    for run, times in runs.items():
        mark = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if mark % noise == 0:
            place = mark % len(run)
            run = run[:place] + run[place + 1 :]
        made[run] += times
    return made


def word_counts(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    least_length: int = 5,
    least_count: int = 3,
    noise: int = 97,
) -> DataFrame:
    """(word, n) of all words of ``docs``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def batch() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in held], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for b in batches:
            for key, body in zip(b.column("key_id").to_pylist(), b.column("body"), strict=True):
                found = misspelt(key, Counter(split_runs(body.as_py())), noise)
                for word, times in found.items():
                    if len(word) >= least_length:
                        held[word] += times
                if len(held) >= HELD_WORDS:
                    yield batch()
                    held.clear()
        yield batch()

    rows = docs.select(F.col(f"`{id}`").cast("long").alias("key_id"), F.col(f"`{text}`").alias("body"))
    counted = rows.mapInArrow(scan, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= least_count)


def prefix_places(word: str, frequency: dict[str, int]) -> tuple[list[int], int]:
    """Places of the word's three rarest bigrams and of all as frequent as the third, and that frequency."""
    weighed = sorted((frequency[word[p : p + 2]], p) for p in range(len(word) - 1))
    last = weighed[min(2, len(weighed) - 1)][0]
    return sorted(p for f, p in weighed if f <= last), last


def expected_meetings(word: str, p: int, frequency: dict[str, int]) -> float:
    """About how many words share the bigram at ``p`` along with the beginning before it or the end behind it.

    Every letter of these divides the bigram's words by about ``SPREAD``.
    """
    return frequency[word[p : p + 2]] * (SPREAD**-p + SPREAD ** (p + 2 - len(word)))


def pivot_places(word: str, places: list[int], frequency: dict[str, int]) -> list[int]:
    """The two disjoint places of the fewest expected meetings; ``places`` are in order.

    ``one`` is the best single place so far with room before the next bigram, ``two`` the best pair.
    """
    one: tuple | None = None
    two: tuple | None = None
    waiting: list[tuple] = []
    for p in places:
        while waiting and waiting[0][1] <= p - 2:
            ahead = waiting.pop(0)
            one = ahead if one is None else min(one, ahead)
        weight = expected_meetings(word, p, frequency)
        if one is not None:
            pair = (one[0] + weight, one[1], p)
            two = pair if two is None else min(two, pair)
        waiting.append((weight, p))
    return list(two[1:]) if two else places


def _bigram_counts(words: DataFrame) -> dict[str, int]:
    """In how many words each bigram is; the alphabet has 90 letters, so there are 8,100 bigrams at most."""
    places = F.sequence(F.lit(1), F.length("word") - 1)
    grams = words.select(F.explode(F.array_distinct(F.transform(places, lambda p: F.substring("word", p, 2)))))
    return {gram: n for gram, n in grams.groupBy("col").count().collect()}


def _sides(word: str, p: int) -> Iterator[tuple[str, str, str | None]]:
    """(key, letter next to it, far end) of the bigram at ``p`` for an edit behind it and for one before it.

    The far end is the two last letters on the side of the edit, or null if that side has fewer than three.
    """
    yield "<" + word[: p + 2], word[p + 2 : p + 3], word[-2:] if len(word) - p - 2 > 2 else None
    yield ">" + word[p:], word[max(p - 1, 0) : p], word[:2] if p > 2 else None


_KEY_ROWS = "pivot boolean, key string, beside string, far string, word string, size int, n long, last long"


def _keys(words: DataFrame, frequency) -> DataFrame:
    """Rows of ``_KEY_ROWS``: one per side of every prefix bigram and of every pivot."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = frequency.value
        for whole in batches:
            for k in range(0, whole.num_rows, 4096):
                b = whole.slice(k, 4096)
                made: list[tuple] = []
                for word, n in zip(b.column("word").to_pylist(), b.column("n").to_pylist(), strict=True):
                    places, last = prefix_places(word, known)
                    for pivot, chosen in ((False, places), (True, pivot_places(word, places, known))):
                        for p in chosen:
                            made += [(pivot, *side, word, len(word), n, last) for side in _sides(word, p)]
                kinds = (pa.bool_(), *[pa.string()] * 4, pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([m[c] for m in made], kind) for c, kind in enumerate(kinds)],
                    [part.split()[0] for part in _KEY_ROWS.split(", ")],
                )

    return words.mapInArrow(scan, _KEY_ROWS)


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every pair of words one edit apart, in both directions."""
    spark = words.sparkSession
    frequency = spark.sparkContext.broadcast(_bigram_counts(words))
    keys = cut_lineage(_keys(words, frequency))
    prefixes, pivots = keys.filter("not pivot"), keys.filter("pivot")
    hot = prefixes.groupBy("key", "size").count().filter(F.col("count") > KEY_ROWS)
    path = scratch_path(spark, "hot-keys")  # a table, so that its size tells Spark how to join it
    hot.select("key", "size", F.ceil(F.col("count") / KEY_ROWS).cast("int").alias("parts")).write.parquet(path)
    parts = spark.read.parquet(path)

    def dealt(rows: DataFrame, part) -> DataFrame:
        return rows.join(parts, ["key", "size"], "left").withColumn("part", part)

    every = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))
    own = F.pmod(F.xxhash64("word"), F.coalesce("parts", F.lit(1))).cast("int")
    lengths = F.explode(F.array(F.col("size") - 1, F.col("size"), F.col("size") + 1))
    left = dealt(pivots.withColumn("size", lengths), every).drop("pivot", "parts").alias("l")
    right = dealt(prefixes, own).drop("pivot", "parts").alias("r")
    met = left.join(right, ["key", "size", "part"]).filter(
        (F.col("r.last") >= F.col("l.last"))
        & ((F.col("l.beside") == F.col("r.beside")) | F.coalesce(F.col("l.far") == F.col("r.far"), F.lit(True)))
        & (F.col("l.word") != F.col("r.word"))
        & (F.levenshtein("l.word", "r.word", 1) == 1)
    )
    one, other = (F.struct(F.col(f"{x}.word").alias("word"), F.col(f"{x}.n").alias("n")) for x in "lr")
    both = F.explode(F.array(F.struct(one.alias("a"), other.alias("b")), F.struct(other.alias("a"), one.alias("b"))))
    return (
        met.select(both.alias("pair"))
        .select("pair.a.word", "pair.a.n", F.col("pair.b.word").alias("near"), F.col("pair.b.n").alias("near_n"))
        .distinct()
    )


def variant_forms(words: DataFrame) -> DataFrame:
    """(word, n, form, n_near, form_n) per row of ``words`` (word, n)."""
    first = F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near")))
    best = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), first.alias("best"))
    kept = (-F.col("best.order")) >= 2 * F.col("n")
    return words.join(best, "word", "left").select(
        "word",
        "n",
        F.when(kept, F.col("best.near")).alias("form"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(kept, -F.col("best.order")).alias("form_n"),
    )


def follow_forms(forms: DataFrame) -> DataFrame:
    """``forms`` with ``root``: the last word reached from a word by its forms.

    Every form is at least twice as frequent as its word, so chains end.  Pointers are doubled until no word's
    pointer has one of its own: a chain of k steps takes about log2(k) rounds.
    """
    steps = cut_lineage(forms.filter("form is not null").select("word", F.col("form").alias("root")))
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = steps.join(onward, "root", "left")
        steps = cut_lineage(
            moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("open"))
        )
        if steps.filter("open").isEmpty():
            break
        steps = steps.select("word", "root")
    ends = steps.select("word", "root")
    return forms.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def group_variants(docs: DataFrame, id: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """(word, n, form, n_near, form_n, root) of all words of ``docs``; ``limits`` as of ``word_counts``."""
    words = cut_lineage(word_counts(docs, id, text, **limits))
    return follow_forms(cut_lineage(variant_forms(words)))
