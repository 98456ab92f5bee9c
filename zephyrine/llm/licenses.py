"""License scans as an exact set-similarity join of text blocks with license templates.

A template matches a text where ``SPREAD`` times its length of consecutive words hold a share of at
least ``threshold`` of its distinct words, so a few words said far apart are no notice.

1. A text's words are cut into overlapping blocks, across its lines, so a wrapped notice lies in one;
   a block and a template are sets of words.  Only template words can match, so a block is reduced
   to those it has.  Blocks are long enough for every such stretch to lie whole in one.
2. Template words are ordered by how many blocks of the whole corpus hold them, rarest first.
3. A block holds a share of at least ``threshold`` of a template only if it has ``needed`` =
   ceil(threshold * size) of its words.  Then the first ``size - needed + 1`` words of the
   template and the like prefix of the block share a word (prefix filter), the block has at least
   ``needed`` template words (length filter), and behind the shared word both sides have enough
   words left (positional filter).
4. Blocks are joined with the templates by prefix word under these conditions, and survivors
   verified by their exact overlap, then by the best overlap of a stretch.

The template side is a parameter: its rows are the templates' words, so the broadcast is bounded by
the caller's list, and nothing else is broadcast or collected but one count per template word.
Texts without words, null texts and empty tables match nothing; repeated rows have equal results.
Template words found in equally many blocks are ordered by spelling; of several matches a label counts
once and the best share is the score.  A very long text is cut into blocks whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zephyrine.llm.text import NON_WORD, carried, same_key, word_array

#: Fixed phrases and their labels; a phrase is found where its words stand consecutively.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
#: Notices of common licenses, as they are usually written.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files",
    ),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("gpl-3", "licensed under the GNU General Public License, version 3"),
    ("gpl-2", "licensed under the GNU General Public License, version 2"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    ("all-rights-reserved", "All rights reserved."),
)


#: Words a template's words may be spread over, in lengths of the template.
SPREAD = 2


def all_words(text: str) -> list[str]:
    """Words of a template, as documents have them."""
    folded = "".join(c.lower() if c.isascii() else c for c in text)
    return [w for w in re.split(NON_WORD, folded) if w]


def template_words(text: str) -> list[str]:
    """Distinct words of a template."""
    return list(dict.fromkeys(all_words(text)))


def stretch(text: str) -> int:
    """Consecutive words within which a template's words count."""
    return SPREAD * len(all_words(text))


def block_length(templates: Sequence[tuple[str, str]]) -> int:
    """Half overlapping blocks of this length hold every stretch of each template whole."""
    return 2 * max((stretch(t) for _, t in templates), default=1)


def needed_words(size: int, threshold: float) -> int:
    return max(1, math.ceil(round(size * threshold, 9)))


def blocks(docs: DataFrame, id: str, text: str, block_words: int) -> DataFrame:
    """(key_id, key_hash, first, words): runs of a text's words, half overlapping."""
    words = carried(docs, id, text).select("key_id", "key_hash", word_array(F.col("body")).alias("all"))
    step = block_words // 2
    # The last run begins where no more than a whole block is left.
    last = F.greatest(F.ceil((F.size("all") - block_words) / step), F.lit(0)).cast("int")
    cut = F.transform(
        F.sequence(F.lit(0), last),
        lambda n: F.struct(
            (n * step).alias("first"), F.slice("all", n * step + 1, F.lit(block_words)).alias("words")
        ),
    )
    return (
        words.filter(F.size("all") > 0)
        .select("key_id", "key_hash", F.explode(cut).alias("block"))
        .select("key_id", "key_hash", "block.first", "block.words")
    )


def _words(values: Sequence[str]) -> Column:
    return F.array(*(F.lit(v) for v in values)).cast("array<string>")


def matching_blocks(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: float = 0.9,
) -> DataFrame:
    """(key_id, key_hash, first, template, label, containment) of every matching block."""
    spark = docs.sparkSession
    sets = [(label, template_words(t), stretch(t)) for label, t in templates]
    sets = [s for s in sets if s[1]]
    vocabulary = sorted({w for _, words, _ in sets for w in words})
    cut = blocks(docs, id, text, max(2, block_length(templates)))
    counts = {
        r["word"]: r["n"]
        for r in cut.select(F.explode(F.array_intersect(_words(vocabulary), "words")).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .collect()
    }
    order = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    rank = {w: n for n, w in enumerate(order)}
    rows = []
    for number, (label, words, span) in enumerate(sets):
        ordered = sorted(words, key=rank.get)
        needed = needed_words(len(ordered), threshold)
        for at, word in enumerate(ordered[: len(ordered) - needed + 1]):
            rows.append((word, at, number, label, ordered, needed, span))
    schema = "word string, at int, template int, label string, template_words array<string>, needed int, span int"
    index = F.broadcast(spark.createDataFrame(rows, schema))
    least = min((r[5] for r in rows), default=1)
    # The intersection keeps the order of its first argument: rarest words first.
    reduced = (
        cut.withColumnRenamed("words", "text_words")
        .withColumn("words", F.array_intersect(_words(order), "text_words"))
        .withColumn("size", F.size("words"))
    )
    probes = reduced.filter(F.col("size") >= least).select(
        "*", F.posexplode(F.slice("words", 1, F.col("size") - least + 1)).alias("pos", "word")
    )
    wide = F.size("template_words")
    left = 1 + F.least(wide - F.col("at"), F.col("size") - F.col("pos")) - 1
    overlap = F.size(F.array_intersect("template_words", "words"))
    # The best stretch, only for the few blocks that hold enough of the words at all.
    starts = F.sequence(F.lit(1), F.greatest(F.size("text_words") - F.col("span") + 1, F.lit(1)))
    within = F.array_max(
        F.transform(
            starts,
            lambda n: F.size(F.array_intersect("template_words", F.slice("text_words", n, F.col("span")))),
        )
    )
    return (
        probes.join(index, "word")
        .filter(
            (F.col("size") >= F.col("needed"))  # length
            & (F.col("pos") <= F.col("size") - F.col("needed"))  # prefix of the block
            & (left >= F.col("needed"))  # position
        )
        .withColumn("overlap", overlap)
        .filter("overlap >= needed")
        .withColumn("within", within)
        .filter("within >= needed")
        .select(
            "key_id", "key_hash", "first", "template", "label",
            (F.col("within") / wide).alias("containment"),
        )
        .distinct()
    )


def phrase_places(words: str, phrase: str) -> Column:
    """Word positions at which the phrase begins in the array column."""
    parts = phrase.split(" ")
    last = F.size(words) - len(parts)
    whole = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    places = F.filter(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: F.slice(F.col(words), i + 1, F.lit(len(parts))) == _words(parts),
    )
    return F.when(whole.contains(f" {phrase} "), places).otherwise(F.array().cast("array<int>"))


def scan_licenses(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    phrases: Sequence[tuple[str, str]] = PHRASES,
    **how,
) -> DataFrame:
    """One row per document: phrases, labels of phrases and templates, best containment.

    (key_id, n_words, places, base_labels, labels, score); labels are sorted arrays, ``score`` is 1
    with a phrase, else the largest containment of a matched template, else 0.
    """
    words = carried(docs, id, text).select("key_id", "key_hash", word_array(F.col("body")).alias("words"))
    found = words.select(
        "key_id",
        "key_hash",
        F.size("words").cast("long").alias("n_words"),
        *(phrase_places("words", p).alias(f"p{n}") for n, (p, _) in enumerate(phrases)),
    )
    names = F.array(*(F.when(F.size(f"p{n}") > 0, F.lit(label)) for n, (_, label) in enumerate(phrases)))
    base = found.select(
        "key_id",
        "key_hash",
        "n_words",
        F.concat(*(F.col(f"p{n}") for n in range(len(phrases)))).alias("places"),
        F.array_sort(F.array_distinct(F.array_compact(names))).alias("base_labels"),
    )
    hits = (
        matching_blocks(docs, id, text, **how)
        .groupBy("key_id", "key_hash")
        .agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"))
    )
    return base.join(hits, same_key(base, hits), "left").select(
        base["key_id"],
        "n_words",
        "places",
        "base_labels",
        F.array_sort(
            F.array_union("base_labels", F.coalesce("more", F.array().cast("array<string>")))
        ).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
