"""Registered queries against plain Python, on tables with the awkward cases."""

import hashlib
from itertools import pairwise

import brute
import duckdb
import pytest
from small_tables import benchmark, documents, pages

from zephyrine.llm import licenses, linerules, mixing
from zephyrine.llm.oracles import ORACLES
from zephyrine.llm.queries import BLOCKED_HOSTS, QUERIES, URL_RULES


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expect_licenses():
    for id_, text in documents():
        n, places, base = brute.phrase_counts(text, licenses.PHRASES)
        more = brute.template_labels(text, licenses.TEMPLATES, 0.9, 2)
        score = 1.0 if places else max(more.values(), default=0.0)
        first, last = min(places, default=None), max(places, default=None)
        yield id_, n, len(places), first, last, ",".join(sorted(base)), ",".join(sorted(base | set(more))), score


def expect_lines():
    for id_, lines, dropped, kept in brute.kept_lines(documents()):
        yield id_, lines, dropped, sha(kept)


def expect_contamination():
    for id_, text in documents():
        n, hit, ids = brute.contamination(text, benchmark())
        yield id_, n, hit, len(ids), sha(",".join(ids)), hit > 0


def expect_quality():
    for id_, text in documents():
        kept, _ = brute.cleaned(text, linerules.Rules(), linerules.BOILERPLATE)
        yield id_, *brute.quality_counts(text), kept


def expect_urls():
    for id_, url, _ in pages():
        yield id_, *brute.url_verdict(url, URL_RULES, BLOCKED_HOSTS)


def expect_warc():
    for row in brute.warc_rows([(id_, html) for id_, _, html in pages()]):
        yield *row, True


def expect_simhash():
    for id_, print_, component in brute.components(documents()):
        yield id_, f"{print_:016x}", component


def expect_search():
    yield from brute.ranked(documents(), benchmark())


def expect_bpe():
    import base64

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for id_, text in documents():
        ids = coder.encode_ordinary(text or "")
        yield id_, len(ids), sha(" ".join(map(str, ids))), sha(text or "")


def expect_variants():
    yield from brute.variants(brute.spelling_counts(documents()))


CASES = {
    "op1_license_scan": (expect_licenses, "doc_id n_words n_base first_word last_word base_labels labels score"),
    "op2_line_dedup": (expect_lines, "doc_id n_lines n_dropped kept_sha256"),
    "op4_decontamination": (expect_contamination, "doc_id n_words n_hit n_items items_sha256 contaminated"),
    "op5_line_rules": (
        expect_quality,
        "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    ),
    "op6_url_filter": (expect_urls, "page_id host path rule verdict"),
    "op8_warc": (expect_warc, "page_id payload_bytes payload_digest record_type refers_to intact"),
    "op10_simhash": (expect_simhash, "doc_id fingerprint component_id"),
    "op11_lexical_search": (expect_search, "item_id rank doc_id score"),
    "op12_byte_bpe": (expect_bpe, "doc_id n_tokens ids_sha256 decoded_sha256"),
    "op13_spelling_variants": (expect_variants, "word form root n n_near form_n"),
}


@pytest.mark.parametrize("name", CASES)
def test_query_equals_plain_python(spark, tables, name):
    expected, columns = CASES[name]
    rows = QUERIES[name](spark, tables).select(*columns.split()).collect()
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, expected()))


@pytest.mark.parametrize("name", QUERIES)
def test_empty_tables_give_no_rows(spark, tables, empty_tables, name):
    found = QUERIES[name](spark, empty_tables)
    assert found.collect() == []


AWKWARD = [
    'Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated '
    'documentation files (the "Software")',
    "All passengers who board early have certain rights, and seats by the window stay reserved for them.",
    "\n".join(["She liked to read more books.", "Read more", "Read more, read more", "(c) Ex. All rights reserved."]),
    " ".join(["on", "and", "on"] * 30) + "\n" + " ".join(f"v{n}" for n in range(80)),
    " ".join(f"v{n % 90}" for n in range(2000)) + "\n" + " ".join(f"u{n * n % 1009}" for n in range(5000)),
    "\n".join(["Name | Mass | Radius | Days", *(f"Planet {n} | {n}.5 | {n * 7} | 36{n}" for n in range(12))])
    + "\n" + " ".join(f"p{n}" for n in range(70)),
    "\n".join(["Home | News | Sport | More"] * 3) + "\n" + " ".join(f"q{n}" for n in range(70)),
]


@pytest.mark.parametrize("name", ["op1_license_scan", "op2_line_dedup", "op4_decontamination", "op5_line_rules", "op6_url_filter"])
def test_sql_twin_on_awkward_rows(spark, tables, tmp_path, name):
    from workload.check import compare

    for table in ("pages", "benchmark", "documents"):
        rows = spark.read.parquet(f"{tables}/{table}.parquet")
        if table == "documents":
            more = spark.createDataFrame(list(enumerate(AWKWARD, 9000)), "doc_id long, text string")
            rows = rows.unionByName(more, allowMissingColumns=True)
        rows.coalesce(1).write.parquet(str(tmp_path / f"{table}.parquet"))
    con = duckdb.connect()
    for table in ("pages", "benchmark", "documents"):
        con.execute(f"create view {table} as select * from read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    verdict = compare(QUERIES[name](spark, str(tmp_path)), con, ORACLES[name])
    assert verdict.startswith("exact"), verdict


def test_tables_of_figures_stay(spark):
    docs = spark.createDataFrame(list(enumerate(AWKWARD)), "doc_id long, text string")
    found = {r.key_id: (r.n_failed_lines, r.kept) for r in linerules.judge_quality(docs).collect()}
    assert found[5] == (1, True) and found[6] == (3, True)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql_twin(spark, name):
    from workload.check import compare, connect

    folder = "/root/testdata/sf0.001"
    verdict = compare(QUERIES[name](spark, folder), connect(folder), ORACLES[name])
    assert verdict.startswith(("exact", "close")), verdict


def test_scores_do_not_depend_on_labels_of_the_row(spark, tables):
    rows = QUERIES["op3_quality_fm"](spark, tables).collect()
    assert len(rows) == len(documents())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_pseudo_likelihood_counts_every_word(spark, tables):
    rows = QUERIES["op9_pseudo_likelihood"](spark, tables).select("doc_id", "n_tokens", "log_likelihood").collect()
    expected = sorted((repr(i), len(brute.blank_words(t))) for i, t in documents())
    assert sorted((repr(r.doc_id), r.n_tokens) for r in rows) == expected
    assert all((r.log_likelihood < 0) == (r.n_tokens > 0) for r in rows)


def test_pipeline_stages(spark, tables, tmp_path):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns, held = docs.columns, [docs]
    for number, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, held[-1], tables).write.parquet(f"{tmp_path}/{number}")
        held.append(spark.read.parquet(f"{tmp_path}/{number}"))
    assert all(d.columns == columns for d in held[1:-1])
    texts = [sorted(((r.doc_id, r.text) for r in d.collect()), key=repr) for d in held[:-1]]
    rules = linerules.Rules(), linerules.BOILERPLATE

    def cleaned(text):
        kept, clean = brute.cleaned(text, *rules)
        return kept, text if clean == (text or "") else clean

    judged = [(i, *cleaned(t)) for i, t in texts[0]]
    assert texts[1] == sorted(((i, t) for i, kept, t in judged if kept), key=repr)
    lines = [(i, kept) for i, _, _, kept in brute.kept_lines(texts[1])]
    assert texts[2] == sorted(lines, key=repr)
    groups = {}
    for (i, t), (_, _, component) in zip(texts[2], brute.components(texts[2]), strict=True):
        groups.setdefault(component, set()).add(i)
    assert sorted(i for i, _ in texts[3]) == sorted(map(min, groups.values()))
    assert set(texts[3]) <= set(texts[2])
    clean = [(i, t) for i, t in texts[3] if not brute.contamination(t, benchmark())[1]]
    assert texts[4] == clean
    assert set(columns) | set(mixing.MIXED) == set(held[5].columns)
    mixed = [((r.doc_id, r.text), r.mix_epoch, r.mix_block, r.mix_place) for r in held[5].collect()]
    assert {row for row, *_ in mixed} <= set(clean)  # every mixed row is a whole document of the stage before
    placed = [(r.key_id, r.epoch, r.block, r.place) for r in mixing.mix(held[4]).collect()]
    assert sorted(((row[0], *at) for row, *at in mixed), key=repr) == sorted(placed, key=repr)
    sizes = {r.doc_id: r.n_chars for r in held[4].collect()}
    assert all(sizes[i] == len(t) for i, t in texts[4])
    assert len(held) == 6 and all(len(a) >= len(b) for a, b in pairwise(texts))


@pytest.mark.parametrize(("budget", "entropy"), [(1.0, 0.98), (0.4, None), (0.03, None)])
def test_mixed_rows_are_those_of_the_mixture(spark, tables, budget, entropy):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    docs = docs.unionByName(docs.filter("doc_id is null or doc_id < 8")).unionByName(docs.filter("doc_id = 20"))
    options = {"budget_share": budget, "entropy_share": entropy, "block_tokens": 300}
    rows = mixing.mix_rows(docs.withColumn("mix_block", docs.text), **options).collect()
    found = [(r.doc_id, r.source, r.mix_weight, r.mix_epoch, r.mix_block, r.mix_place) for r in rows]
    expected = [(r.key_id, r.source, r.weight, r.epoch, r.block, r.place) for r in mixing.mix(docs, **options).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    texts = {(r.doc_id, r.text, r.lang, r.h) for r in docs.collect()}
    assert {(r.doc_id, r.text, r.lang, r.h) for r in rows} <= texts


def test_a_cut_among_equal_rows_takes_some_of_them(spark):
    docs = spark.range(40).selectExpr("cast(null as long) doc_id", "'one two three' text", "'a' source")
    rows = mixing.mix_rows(docs, budget_share=0.5, entropy_share=None, max_repeats=None).collect()
    assert len(rows) == 20 and {r.text for r in rows} == {"one two three"}
