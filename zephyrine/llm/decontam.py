"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

1. Every item is cut into windows of consecutive words (a shorter item is one window); a window is
   the set of its short shingles with their offsets.
2. One pass over the documents keeps the places of shingles that any item has; their counts over
   the whole corpus order the shingles by rarity.
3. A window that is contained exactly needs every one of its shingles, so its necessary prefix is
   the rarest alone.  Places of prefix shingles are joined; a place must leave room for the
   window before and after it (positional and length bounds).
4. Surviving places are verified word by word on the document's text.
5. Places that agree on where an item begins are counted over the item-sized window there:
   ``containment`` is the share of the item's windows found in it.

Item shingles and prefixes are broadcast only if they are counted at ``broadcast_rows`` or fewer and
``broadcast_bytes`` or less; beyond that the joins are shuffled ones, where adaptive execution splits hot
shingles.  A window's uses in the items stay rows of their own, however many items share it.  Texts move
for documents with a surviving place only: the keys of these are a written table, which Spark broadcasts while it is
small.

Null texts have no words; items without words have no window and match nothing.  Items with equal
ids count once, items without id mark words but are not counted.  Repeated rows have equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zephyrine.llm.text import carried, let, same_key, stored, word_array
from zephyrine.session import cut_lineage


def _runs(words: str, width: int) -> Column:
    """All runs of ``width`` words of the array column, as structs; none if it is shorter."""
    count = F.greatest(F.size(words) - width + 1, F.lit(0))
    return F.arrays_zip(*(F.slice(words, k + 1, count).alias(f"w{k}") for k in range(width)))


def _run_hash(run: str, width: int) -> Column:
    return F.xxhash64(F.lit(width), *(F.col(run)[f"w{k}"] for k in range(width)))


def item_windows(items: DataFrame, id: str, text: str, window: int) -> DataFrame:
    """(item, n_windows, at, win): the windows of all items, one row per place."""
    words = items.select(F.col(f"`{id}`").alias("item"), word_array(F.col(f"`{text}`")).alias("words"))
    cut = words.filter(F.size("words") > 0).withColumn(
        "n_windows", F.greatest(F.size("words") - window, F.lit(0)) + 1
    )
    return cut.select(
        "item", "words", "n_windows", F.explode(F.sequence(F.lit(0), F.col("n_windows") - 1)).alias("at")
    ).select("item", "n_windows", "at", F.slice("words", F.col("at") + 1, F.lit(window)).alias("win"))


def _sized(side: DataFrame, limit: int, limit_bytes: int, row_bytes: Column) -> DataFrame:
    """With a broadcast hint if ``side`` is counted small enough."""
    n, total = side.agg(F.count("*"), F.coalesce(F.sum(row_bytes), F.lit(0))).first()
    return F.broadcast(side) if n <= limit and total <= limit_bytes else side


def shingle_places(
    docs: DataFrame, id: str, text: str, wanted: DataFrame, widths: list[int], limit: int, limit_bytes: int
) -> DataFrame:
    """(key_id, key_hash, n_words, pos, shingle) wherever a document has a wanted shingle."""
    words = carried(docs, id, text).select(
        "key_id", "key_hash", word_array(F.col("body")).alias("words")
    )
    wanted = _sized(wanted, limit, limit_bytes, F.lit(8))
    found = None
    for width in widths:
        places = (
            words.select(
                "key_id", "key_hash", F.size("words").alias("n_words"),
                F.posexplode(_runs("words", width)).alias("pos", "run"),
            )
            .select("key_id", "key_hash", "n_words", "pos", _run_hash("run", width).alias("shingle"))
            .join(wanted, "shingle")
        )
        found = places if found is None else found.unionByName(places)
    return found


def contaminated_places(
    docs: DataFrame,
    items: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    shingle: int = 3,
    broadcast_rows: int = 2_000_000,
    broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """(key_id, key_hash, start, width, item, at, n_windows): verified windows in documents."""
    uses = cut_lineage(item_windows(items, item_id, item_text, window))
    windows = cut_lineage(uses.select("win").distinct())
    widths = [r[0] for r in windows.select(F.least(F.size("win"), F.lit(shingle))).distinct().collect()]
    parts = [
        windows.filter(F.least(F.size("win"), F.lit(shingle)) == w)
        .select("win", F.posexplode(_runs("win", w)).alias("offset", "run"))
        .select("win", "offset", _run_hash("run", w).alias("shingle"))
        for w in sorted(widths)
    ]
    if not parts:  # no item has a word
        parts = [windows.select("win", F.lit(0).alias("offset"), F.lit(0).cast("long").alias("shingle"))]
    shingles = parts[0]
    for part in parts[1:]:
        shingles = shingles.unionByName(part)
    places = cut_lineage(
        shingle_places(
            docs, id, text, shingles.select("shingle").distinct(), sorted(widths) or [shingle], broadcast_rows,
            broadcast_bytes,
        )
    )
    counts = places.groupBy("shingle").agg(F.count("*").alias("n"))
    prefixes = (
        shingles.join(counts, "shingle", "left")
        .withColumn("n", F.coalesce("n", F.lit(0)))
        .groupBy("win")
        .agg(F.min(F.struct("n", "offset", "shingle")).alias("rarest"))
        .filter("rarest.n > 0")
        .select("win", "rarest.offset", "rarest.shingle", F.size("win").alias("width"))
    )
    win_bytes = F.octet_length(F.array_join("win", " ")) + 16 * (F.size("win") + 1)
    prefixes = _sized(cut_lineage(prefixes), broadcast_rows, broadcast_bytes, win_bytes)
    candidates = (
        places.join(prefixes, "shingle")
        .withColumn("start", F.col("pos") - F.col("offset"))
        .filter((F.col("start") >= 0) & (F.col("start") + F.col("width") <= F.col("n_words")))
        .groupBy("key_id", "key_hash")
        .agg(F.collect_set(F.struct("start", "win")).alias("places"))
    )
    candidates = stored(candidates, "decontamination-places")
    named = stored(candidates.select("key_id", "key_hash"), "decontamination-candidates")
    texts = carried(docs, id, text).select("key_id", "key_hash", "body")
    # The candidates' keys alone are few enough to be broadcast mostly; other texts stay where they are read.
    texts = texts.join(named, same_key(texts, named), "left_semi")
    joined = texts.join(candidates, same_key(texts, candidates))
    real = let(
        word_array(F.col("body")),
        lambda words: F.filter(
            "places", lambda p: F.slice(words, p["start"] + 1, F.size(p["win"])) == p["win"]
        ),
    )
    verified = (
        joined.select(texts["key_id"], texts["key_hash"], real.alias("places"))
        .dropDuplicates(["key_id", "key_hash"])
        .select("key_id", "key_hash", F.explode("places").alias("p"))
        .select("key_id", "key_hash", "p.start", "p.win")
    )
    return verified.join(uses, "win").select(
        "key_id", "key_hash", "start", F.size("win").alias("width"), "item", "at", "n_windows"
    )


def contamination(
    docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", **how
) -> DataFrame:
    """(key_id, key_hash, spans, hit_words, items, containment) of documents with a hit.

    ``spans`` are the places (start, width) in words, ``items`` the distinct ids as text in order,
    ``containment`` the largest share of an item's windows found in one item-sized window.
    """
    places = cut_lineage(contaminated_places(docs, items, id, text, **how))
    aligned = (
        places.groupBy("key_id", "key_hash", "item", (F.col("start") - F.col("at")).alias("begin"), "n_windows")
        .agg(F.countDistinct("at").alias("found"))
        .groupBy("key_id", "key_hash")
        .agg(F.max(F.col("found") / F.col("n_windows")).alias("containment"))
    )
    spans = places.groupBy("key_id", "key_hash").agg(
        F.collect_set(F.struct("start", "width")).alias("spans"),
        F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"),
    )
    covered = F.array_distinct(
        F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["width"] - 1)))
    )
    return spans.join(aligned, same_key(spans, aligned)).select(
        spans["key_id"], spans["key_hash"], "spans", F.size(covered).alias("hit_words"), "items", "containment"
    )


def judge_contamination(
    docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", **how
) -> DataFrame:
    """(key_id, n_words, n_hit, items, containment) per row of ``docs``; no items if clean."""
    rows = carried(docs, id, text).select(
        "key_id", "key_hash", F.size(word_array(F.col("body"))).cast("long").alias("n_words")
    )
    hits = contamination(docs, items, id, text, **how)
    return rows.join(hits, same_key(rows, hits), "left").select(
        rows["key_id"],
        "n_words",
        F.coalesce("hit_words", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("containment", F.lit(0.0)).alias("containment"),
    )


def drop_contaminated(
    docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", **how
) -> DataFrame:
    """``docs`` without the rows that hold any window of an item."""
    places = contaminated_places(docs, items, id, text, **how)
    hits = stored(places.select("key_id", "key_hash").distinct(), "decontamination-hits")
    rows = carried(docs, id, text).drop("body")
    return rows.join(hits, same_key(rows, hits), "left_anti").select("row.*")
