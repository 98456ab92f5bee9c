"""Line-first quality rules, whole texts.

Each line with a word is judged by itself; lines that fail are removed, and a document that loses
too much of its text, or that breaks a rule on the whole text, is rejected.

* punctuation: too many of the line's words carry a symbol or repeated exclamation marks;
* navigation: the line's pieces between bars or arrows are a few words long, and few of its words hold
  a digit, so that rows of figures in a table stay;
* boilerplate: whole phrases that pages repeat (policies, sharing, subscriptions) make up most of
  the line's words;
* repetition: a run of words repeats itself through the line.  Few distinct words alone are no fault,
  since their share falls with the length of any text; most words must also lie in windows that
  occur again within ``repeat_reach`` words, which is as likely in a long line as in a short one.

Null and empty texts have no words and are rejected for length.  Repeated rows and other columns
do not matter; a very long text is judged whole, and an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add, or_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zephyrine.llm.text import BLANK_CHARS, blank_word_array, carried, let, line_array, lower_ascii, replace_text, word_array

SYMBOLS = b"#*$%&|<>"
#: What makes a word noisy: a pair of symbols or of exclamation marks.
NOISY = r"[#*$%&<>]{2}|!!"
#: A bar or arrow that ends a piece of a navigation line.
PIECE_END = r"[|»›>](?:[\x20\x09]|\z)"
#: What makes a word a figure.
FIGURE = r"[0-9]"
#: Phrases of page furniture, matched in lower-cased lines of at most ``boilerplate_words`` words.
BOILERPLATE = (
    "all rights reserved",
    "accept cookies",
    "cookie policy",
    "privacy policy",
    "terms of service",
    "terms of use",
    "subscribe to our newsletter",
    "sign up for our newsletter",
    "click here",
    "read more",
    "share this",
    "skip to content",
    "powered by",
)


@dataclass(frozen=True)
class Rules:
    """Limits; shares are of the line's words, losses of the document's words."""

    noisy_words: float = 0.5
    bar_pieces: int = 4
    piece_words: float = 4.0
    figure_words: float = 0.25
    boilerplate_words: int = 30
    boilerplate_share: float = 0.5
    repeat_words: int = 12
    distinct_share: float = 0.3
    repeated_share: float = 0.5
    repeat_reach: int = 1000
    max_loss: float = 0.3
    min_words: int = 50
    max_repeat_percent: int = 50


def _furniture_words(words: Column) -> Column:
    """How many of the alphanumeric words belong to a phrase; no phrase overlaps another."""
    joined = F.concat(F.lit("  "), F.array_join(words, "  "), F.lit("  "))
    counts = (
        F.regexp_count(joined, F.lit(f"  {p.replace(' ', '  ')}(?=  )")) * len(p.split(" ")) for p in BOILERPLATE
    )
    return reduce(add, counts)


def _failing(text: Column, words: Column, repeats: Column, rules: Rules) -> Column:
    """Whether a line breaks a rule; a line without words breaks none.  ``repeats``: it breaks the last rule."""
    n = F.size(words)
    noisy = F.size(F.filter(words, lambda w: w.rlike(NOISY)))
    pieces = F.regexp_count(text, F.lit(PIECE_END)) + 1
    figures = F.size(F.filter(words, lambda w: w.rlike(FIGURE)))
    navigation = (
        (pieces >= rules.bar_pieces) & (n / pieces <= rules.piece_words) & (figures < n * rules.figure_words)
    )
    furniture = let(
        lower_ascii(text),
        lambda folded: reduce(or_, (folded.contains(p) for p in BOILERPLATE))
        & let(word_array(folded), lambda w: _furniture_words(w) >= F.size(w) * rules.boilerplate_share),
    )
    return (n > 0) & (
        (noisy >= F.greatest(n * rules.noisy_words, F.lit(2)))
        | navigation
        | ((n <= rules.boilerplate_words) & furniture)
        | repeats
    )


def repeated_window_words(words: list[bytes], width: int = 3, reach: int | None = None) -> int:
    """Words inside windows of ``width`` words that occur more than once in the text.

    With ``reach`` the nearest other occurrence is at most so many words away.
    """
    last = len(words) - width + 1
    if last < 2:
        return 0
    codes: dict[bytes, int] = {}
    word = np.array([codes.setdefault(w, len(codes)) for w in words], np.int64)
    # Windows are renumbered after each word, so the numbers stay exact and small.
    window = word[:last]
    for k in range(1, width):
        _, window = np.unique(window * len(codes) + word[k : last + k], return_inverse=True)
    if reach is None:
        again = np.bincount(window)[window] > 1
    else:
        order = np.argsort(window, kind="stable")
        near = (np.diff(window[order]) == 0) & (np.diff(order) <= reach)
        again = np.zeros(last, bool)
        again[order[:-1][near]] = again[order[1:][near]] = True
    step = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(again)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + width, -1)
    return int((np.cumsum(step[:-1]) > 0).sum())


def text_counts(text: bytes) -> tuple[int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_repeat_words) of a whole text."""
    words = text.split()
    blanks = len(text) - len(text.translate(None, BLANK_CHARS.encode()))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    return len(words), len(text.decode()) - blanks, symbols, repeated_window_words(words)


def repeating_lines(text: bytes, rules: Rules = Rules()) -> list[int]:
    """Numbers of the lines, from 0, that break the repetition rule."""
    found = []
    for number, line in enumerate(text.split(b"\n")):
        words = line.split()
        n = len(words)
        if n >= rules.repeat_words and len(set(words)) < n * rules.distinct_share:
            if repeated_window_words(words, reach=rules.repeat_reach) > n * rules.repeated_share:
                found.append(number)
    return found


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_repeat_words")
_COUNTED = T.StructType(
    [T.StructField(name, T.LongType()) for name in _COUNTS]
    + [T.StructField("repeating", T.ArrayType(T.IntegerType()))]
)


def _text_counts(rules: Rules):
    @F.pandas_udf(_COUNTED)
    def counted(texts: pd.Series) -> pd.DataFrame:
        found = pd.DataFrame([text_counts(t) for t in texts], columns=_COUNTS, dtype="int64")
        found["repeating"] = [repeating_lines(t, rules) for t in texts]
        return found

    return counted


def judge_quality(
    docs: DataFrame, id: str = "doc_id", text: str = "text", rules: Rules = Rules()
) -> DataFrame:
    """One row per document: the carried row, counts, the cleaned text and the verdict.

    (row, key_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    n_failed_lines, n_lost_words, cleaned_text, kept)
    """
    base = carried(docs, id, text).select(
        "row", "key_id", F.coalesce("body", F.lit("")).alias("body")
    )
    split = base.select(
        "*",
        _text_counts(rules)(F.col("body").cast("binary")).alias("counts"),
        F.transform(
            line_array(F.col("body")),
            lambda x: F.struct(x.alias("line"), blank_word_array(x).alias("words")),
        ).alias("lines"),
    )
    judged = split.withColumn(
        "lines",
        F.transform(
            "lines",
            lambda x, number: F.struct(
                x["line"].alias("line"),
                F.size(x["words"]).alias("n"),
                _failing(
                    x["line"], x["words"], F.array_contains("counts.repeating", number), rules
                ).alias("fails"),
            ),
        ),
    )
    worded = F.filter("lines", lambda x: x["n"] > 0)["line"]
    failed = F.filter("lines", lambda x: x["fails"])
    lost = F.aggregate(failed, F.lit(0).cast("long"), lambda total, x: total + x["n"])
    too_few = F.col("counts.n_words") < rules.min_words
    repeats = 100 * F.col("counts.n_repeat_words") > rules.max_repeat_percent * F.col("counts.n_words")
    counted = judged.select(
        "row",
        "key_id",
        "counts.n_words",
        "counts.word_chars",
        "counts.n_symbols",
        (F.size(worded) - F.size(F.array_distinct(worded))).cast("long").alias("n_dup_lines"),
        "counts.n_repeat_words",
        (too_few | repeats).alias("base_failed"),
        F.size(failed).cast("long").alias("n_failed_lines"),
        lost.alias("n_lost_words"),
        F.array_join(F.filter("lines", lambda x: ~x["fails"])["line"], "\n").alias("cleaned_text"),
    )
    much = F.col("n_lost_words") > F.col("n_words") * rules.max_loss
    return counted.withColumn("kept", ~F.col("base_failed") & ~much)


def keep_quality(
    docs: DataFrame, id: str = "doc_id", text: str = "text", rules: Rules = Rules()
) -> DataFrame:
    """``docs`` without the rejected rows, their failing lines removed."""
    kept = judge_quality(docs, id, text, rules).filter("kept")
    new = F.when(F.col("n_failed_lines") > 0, F.col("cleaned_text")).otherwise(F.col(f"row.`{text}`"))
    return kept.select(replace_text(text, new).alias("row")).select("row.*")
