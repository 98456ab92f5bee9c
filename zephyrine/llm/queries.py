"""The registered queries of the text operators, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zephyrine.llm import (
    bpe,
    decontam,
    fm,
    lexsearch,
    licenses,
    linededup,
    linerules,
    mixing,
    pseudolm,
    simhash,
    spelling,
    urls,
    warc,
)

#: Fixed rules of the URL query: host, path, verdict.
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: Hosts that are blocked, with their subdomains, where no rule fits.
BLOCKED_HOSTS = tuple(
    f"{name}.example.{end}" for name in ("ads-track", "free-bets", "spam-farm") for end in ("com", "net", "org")
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("key_id").alias("doc_id"),
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("key_id").alias("doc_id"),
        "n_lines",
        "n_dropped",
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"),
    )


def op3_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fm.train(docs, table(spark, sf_dir, "labels"))
    return fm.score_quality(docs, model).select(
        F.col("key_id").alias("doc_id"),
        "held_out",
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.judge_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("key_id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "containment",
    )


def op5_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linerules.judge_quality(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("key_id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "n_failed_lines",
        "n_lost_words",
    )


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    blocked = spark.createDataFrame([(h,) for h in BLOCKED_HOSTS], "host string")
    index = urls.build_index(rules, blocked)
    found = urls.judge_urls(table(spark, sf_dir, "pages"), index)
    return found.withColumnRenamed("key_id", "page_id")


def op7_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.withColumnRenamed("key_id", "doc_id")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_records(index, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact"
    )


def op9_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counts = pseudolm.word_counts(docs)
    own = pseudolm.frequent_words(docs, counts=counts)
    found = pseudolm.score_documents(docs, pseudolm.train(docs, own), own, counts=counts)
    return found.select(
        F.col("key_id").alias("doc_id"),
        "n_tokens",
        "log_likelihood",
        F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")).alias("mean_log_probability"),
    )


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("key_id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lexsearch.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("key_id", "doc_id")


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe.load_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    pattern = public_tokenizers.PATTERN
    coded = bpe.decode_ids(bpe.encode_texts(table(spark, sf_dir, "documents"), ranks, pattern), ranks, pattern)
    return coded.select(
        F.col("key_id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.group_variants(table(spark, sf_dir, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


QUERIES = {
    f.__name__: f
    for f in (
        op1_license_scan,
        op2_line_dedup,
        op3_quality_fm,
        op4_decontamination,
        op5_line_rules,
        op6_url_filter,
        op7_temperature_mix,
        op8_warc,
        op9_pseudo_likelihood,
        op10_simhash,
        op11_lexical_search,
        op12_byte_bpe,
        op13_spelling_variants,
    )
}
