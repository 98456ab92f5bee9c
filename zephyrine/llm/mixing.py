"""Mixing sources by temperature.

1. Token shares of the sources are raised to an exponent and normalised.  The exponent is bisected
   until the weights meet a target: an entropy (share of the largest possible one), or the
   largest number of times any source may be repeated.
2. A source's weight times the budget is its token quota: whole epochs of the source, then part of
   one.  Each epoch is a permutation of the source's documents by a hash of seed, epoch and id; where the
   id is null or repeated, also of the text.
3. The part is cut by blocks: documents fall into blocks by the leading digits of that hash, block
   token sums are added up per source, and only the one block the quota ends in is looked at
   document by document.  No source is sorted or gathered, however large.
4. The mixed stream is cut into blocks of about ``block_tokens``; each source spreads its
   documents evenly over all blocks, so that every block holds the weights.

A document is taken while the tokens before it are below the quota, so a source exceeds it by less
than one document.  Tokens are words between ASCII white space.  A null source is a source of its
own; documents without tokens are placed for free (in every whole epoch).  Rows equal in id and text are
repeated documents in the same place, of which the cut takes as many as the quota needs.  An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zephyrine.llm.text import blank_word_array, stored
from zephyrine.session import cut_lineage

#: Digits of the document hash, in base 16; the first ``_HIGH`` name a block's row of sums.
_DIGITS, _HIGH, _LOW = 13, 3, 3


def entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w > 0)


def tempered(shares: list[float], exponent: float) -> list[float]:
    raised = [s**exponent for s in shares]
    total = math.fsum(raised)
    return [r / total for r in raised]


def fit_exponent(
    shares: list[float],
    entropy_share: float | None = None,
    max_repeats: float | None = None,
    budget_share: float = 1.0,
    rounds: int = 60,
) -> float:
    """The exponent in [0, 1] closest to 0 that meets the limits, by bisection.

    Weights move from the sources' own shares (1) towards equal ones (0).  Entropy grows on the
    way, and so does the repetition of the smallest source; the entropy target is the least
    flattening wanted, the repetition limit the most allowed, and the limit wins.
    """
    top = math.log(len(shares)) if len(shares) > 1 else 1.0

    def bisect(fits) -> float:
        """Largest exponent with ``fits`` true at 0 side; 0 if never, 1 if always."""
        if fits(1.0):
            return 1.0
        low, high = 0.0, 1.0
        for _ in range(rounds):
            middle = (low + high) / 2
            low, high = (middle, high) if fits(middle) else (low, middle)
        return low

    exponent = 1.0
    if entropy_share is not None:
        exponent = bisect(lambda x: entropy(tempered(shares, x)) >= entropy_share * top)
    if max_repeats is not None:

        def repeats(x: float) -> float:
            return max(w * budget_share / s for w, s in zip(tempered(shares, x), shares, strict=True))

        if repeats(exponent) > max_repeats:
            low, high = exponent, 1.0
            for _ in range(rounds):
                middle = (low + high) / 2
                low, high = (low, middle) if repeats(middle) <= max_repeats else (middle, high)
            exponent = high
    return exponent


def source_quotas(
    tokens: DataFrame, budget_share: float, entropy_share: float | None, max_repeats: float | None
) -> tuple[DataFrame, int]:
    """(source, source_tokens, weight, quota) of each source with tokens, and the budget.

    The sources' sums come to the driver: one number per source.
    """
    spark = tokens.sparkSession
    sums = tokens.groupBy("source").agg(F.sum("n_tokens").alias("t")).filter("t > 0").collect()
    sums.sort(key=lambda r: (r["source"] is not None, r["source"] or ""))
    total = sum(r["t"] for r in sums)
    budget = int(total * budget_share)
    rows = []
    if sums:
        shares = [r["t"] / total for r in sums]
        exponent = round(fit_exponent(shares, entropy_share, max_repeats, budget_share), 9)
        for r, w in zip(sums, tempered(shares, exponent), strict=True):
            weight = round(w, 9)
            rows.append((r["source"], r["t"], weight, int(weight * budget)))
    schema = "source string, source_tokens long, weight double, quota long"
    return spark.createDataFrame(rows, schema), budget


def _order(seed: int) -> Column:
    """Hash digits that order a document within its epoch; ``text_hash`` is null where the id suffices."""
    parts = (F.col(c).cast("string") for c in ("epoch", "key_id", "text_hash"))
    name = F.concat_ws(":", F.lit(str(seed)), *parts)
    return F.substring(F.md5(name), 1, _DIGITS)


def mix(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    budget_share: float = 1.0,
    entropy_share: float | None = 0.98,
    max_repeats: float | None = 4.0,
    block_tokens: int = 1 << 17,
    seed: int = 17,
    broadcast_rows: int = 1 << 20,
) -> DataFrame:
    """(key_id, source, n_tokens, weight, epoch, block, place) per placed copy of a document."""
    tokens = cut_lineage(_tokens(docs, id, text, source).drop("row"))
    quotas, budget = source_quotas(tokens, budget_share, entropy_share, max_repeats)
    blocks = max(1, -(-budget // block_tokens))
    return _placed(_copies(tokens, quotas, seed, broadcast_rows), blocks).select(
        "key_id", "source", "n_tokens", "weight", "epoch", "block", F.col("order").alias("place")
    )


#: What the mixture adds to a document; columns of these names that documents have already are replaced.
MIXED = ("mix_weight", "mix_epoch", "mix_block", "mix_place")


def mix_rows(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    budget_share: float = 1.0,
    entropy_share: float | None = 0.98,
    max_repeats: float | None = 4.0,
    block_tokens: int = 1 << 17,
    seed: int = 17,
    broadcast_rows: int = 1 << 20,
) -> DataFrame:
    """The documents themselves, a row per placed copy, with the columns ``MIXED``; places are those of ``mix``.

    Where a source's last epoch ends is one row per source.  Every document is tested against it where it is read, so
    no text is shuffled.  Only where the cut leaves out some of several equal rows are these numbered.
    """
    tokens = cut_lineage(_tokens(docs, id, text, source).drop("row"))
    quotas, budget = source_quotas(tokens, budget_share, entropy_share, max_repeats)
    blocks = max(1, -(-budget // block_tokens))
    copies = _copies(tokens, quotas, seed, broadcast_rows)
    partial = _placed(copies, blocks).filter("epoch = whole and source_tokens > 0")
    last = partial.groupBy("source", "order").count().groupBy("source").agg(F.max(F.struct("order", "count")).alias("x"))
    named = F.col("source").alias("e"), F.col("x.order").alias("end"), F.col("x.count").alias("taken")
    ends = cut_lineage(last.select(*named))
    few = ends.count() <= broadcast_rows  # one row per source

    def cut(rows: DataFrame) -> DataFrame:
        limits = F.broadcast(ends) if few else ends
        found = rows.join(limits, F.col("source").eqNullSafe(F.col("e")), "left").drop("e")
        inside = (F.col("epoch") < F.col("whole")) | F.coalesce(F.col("order") <= F.col("end"), F.lit(False))
        edge = (F.col("epoch") == F.col("whole")) & (F.col("order") == F.col("end"))
        return found.filter(inside).withColumn("edge", edge)

    there = cut(copies).filter("edge").groupBy("source").agg(F.count("*").alias("n"), F.max("taken").alias("taken"))
    split = cut_lineage(there.filter("n > taken").select(F.col("source").alias("s")))
    rows = cut(_copies(_tokens(docs, id, text, source), quotas, seed, broadcast_rows))
    if not split.isEmpty():
        left_out = F.broadcast(split) if few else split
        marked = rows.join(left_out.withColumn("some", F.lit(True)), F.col("source").eqNullSafe(F.col("s")), "left")
        some = F.col("edge") & F.coalesce("some", F.lit(False))
        number = F.row_number().over(Window.partitionBy("source").orderBy(F.xxhash64("row")))
        numbered = marked.filter(some).withColumn("number", number).filter("number <= taken")
        rows = marked.filter(~some).select(rows.columns).unionByName(numbered.select(rows.columns))
    added = [F.col(c).alias(name) for c, name in zip(("weight", "epoch", "block", "order"), MIXED, strict=True)]
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in MIXED]
    return _blocked(rows, blocks).select(*kept, *added)


def _tokens(docs: DataFrame, id: str, text: str, source: str) -> DataFrame:
    """(row, key_id, source, n_tokens, text_hash); the hash is null where the id suffices to tell rows apart."""
    tokens = docs.select(
        F.struct("*").alias("row"),
        F.col(f"`{id}`").cast("long").alias("key_id"),
        F.col(f"`{source}`").cast("string").alias("source"),
        F.size(blank_word_array(F.col(f"`{text}`"))).cast("long").alias("n_tokens"),
        F.xxhash64(F.col(f"`{text}`")).alias("text_hash"),
    )
    ids = docs.select(F.col(f"`{id}`").cast("long").alias("again"))
    repeated = ids.groupBy("again").count().filter("count > 1 and again is not null").select("again")
    again = stored(repeated, "repeated-ids")
    return tokens.join(again, F.col("key_id") == F.col("again"), "left").withColumn(
        "text_hash", F.when(F.col("key_id").isNull() | F.col("again").isNotNull(), F.col("text_hash"))
    ).drop("again")


def _copies(tokens: DataFrame, quotas: DataFrame, seed: int, broadcast_rows: int) -> DataFrame:
    """A row per document and epoch, whole ones and the last, with the order of documents in it."""
    quotas = quotas.withColumnRenamed("source", "s")
    if quotas.count() <= broadcast_rows:  # one row per source
        quotas = F.broadcast(quotas)
    known = tokens.join(quotas, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    whole = F.floor(F.col("quota") / F.col("source_tokens"))
    known = known.fillna({"source_tokens": 0, "quota": 0, "weight": 0.0}).withColumn(
        "whole", F.when(F.col("source_tokens") > 0, whole).otherwise(1)
    )
    rest = F.col("quota") - F.col("whole") * F.col("source_tokens")
    return known.select(
        "*", rest.alias("rest"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole"))).alias("epoch")
    ).withColumn("order", _order(seed))


def _placed(copies: DataFrame, blocks: int) -> DataFrame:
    """The copies up to where the quotas end, with their blocks."""
    full = copies.filter("epoch < whole")
    part = _cut(copies.filter("epoch = whole and rest > 0"))
    columns = ["key_id", "source", "n_tokens", "weight", "epoch", "order", "quota", "source_tokens", "whole"]
    return _blocked(full.select(columns).unionByName(part.select(columns)), blocks)


def _blocked(rows: DataFrame, blocks: int) -> DataFrame:
    # How far along its source's stream of epochs a document stands, from 0 to 1.
    along = (F.col("epoch") + _number(F.col("order"), _DIGITS) / 16.0**_DIGITS) / F.greatest(
        F.col("quota") / F.col("source_tokens"), F.lit(1e-9)
    )
    along = F.when(F.col("source_tokens") > 0, along).otherwise(
        _number(F.col("order"), _DIGITS) / 16.0**_DIGITS
    )
    return rows.withColumn("block", F.least(F.floor(along * blocks), F.lit(blocks - 1)).cast("long"))


def _number(digits: Column, count: int) -> Column:
    return F.conv(F.substring(digits, 1, count), 16, 10).cast("long")


def _cut(rows: DataFrame) -> DataFrame:
    """The rows of one epoch whose preceding tokens, in the order of their hash, are below ``rest``."""
    high, low = F.substring("order", 1, _HIGH), F.substring("order", _HIGH + 1, _LOW)
    named = rows.withColumns({"high": high, "low": low})
    sums = named.groupBy("source", "high", "low").agg(F.sum("n_tokens").alias("t"))
    tall = sums.groupBy("source", "high").agg(F.sum("t").alias("t"))
    before_high = F.sum("t").over(Window.partitionBy("source").orderBy("high")) - F.col("t")
    before_low = F.sum("t").over(Window.partitionBy("source", "high").orderBy("low")) - F.col("t")
    tall = tall.select(F.col("source").alias("s"), F.col("high").alias("h"), before_high.alias("base"))
    starts = (
        sums.withColumn("inside", before_low)
        .join(tall, F.col("source").eqNullSafe(F.col("s")) & (F.col("high") == F.col("h")))
        .select(
            F.col("source").alias("s"), F.col("high").alias("h"), F.col("low").alias("l"),
            (F.col("base") + F.col("inside")).alias("before"), "t",
        )
    )
    placed = named.join(
        starts,
        F.col("source").eqNullSafe(F.col("s")) & (F.col("high") == F.col("h")) & (F.col("low") == F.col("l")),
    ).filter("before < rest")
    inside = placed.filter("before + t <= rest")
    edge = placed.filter("before + t > rest")
    # Equal rows are one row with their number; the quota ends after some of the copies.
    copies = edge.groupBy(*(c for c in edge.columns if c not in ("h", "l", "s"))).agg(F.count("*").alias("n"))
    order = Window.partitionBy("source").orderBy("order", F.col("key_id").asc_nulls_first(), "text_hash", "n_tokens")
    size = F.col("n") * F.col("n_tokens")
    left = F.col("rest") - F.col("before") - (F.sum(size).over(order) - size)
    needed = F.when(F.col("n_tokens") > 0, F.ceil(F.col("left") / F.col("n_tokens"))).otherwise(F.col("n"))
    edge = (
        copies.withColumn("left", left)
        .filter("left > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least("n", needed))))
    )
    return inside.select(rows.columns).unionByName(edge.select(rows.columns))
