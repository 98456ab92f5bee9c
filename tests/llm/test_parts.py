"""The operators' inner parts by themselves."""

import os
from pydoc_data.topics import topics
from unittest import mock

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import brute
from zephyrine.llm import decontam, fm, licenses, linededup, linerules, mixing, pseudolm, simhash, urls, warc

NUMBERS = st.integers(0, 2**64 - 1)


@settings(max_examples=60, deadline=None)
@given(st.sets(NUMBERS, min_size=1, max_size=300), st.sets(NUMBERS, max_size=50))
def test_perfect_hash_is_minimal(keys, others):
    h = np.array(sorted(keys), np.uint64)
    levels = linededup.build_levels(h)
    assert sorted(linededup.slots(h, levels)) == list(range(len(h)))
    found = linededup.slots(np.array(sorted(others - keys), np.uint64), levels)
    assert (found < len(h)).all()


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abC \n\t\x0b|é\x85", max_size=60), st.integers(1, 5))
def test_fingerprint(text, shingle):
    assert simhash.fingerprint(text.encode(), shingle) % 2**64 == brute.simhash(text, shingle)


@settings(max_examples=60, deadline=None)
@given(NUMBERS, st.lists(st.lists(st.integers(0, 63), max_size=4), min_size=2, max_size=40), st.integers(0, 3))
def test_pivots_lose_no_link(center, flips, max_bits):
    prints = {center}
    for bits in flips:
        made = center
        for b in bits:
            made ^= 1 << b
        prints.add(made)
    fp = np.array(sorted(prints), np.uint64)
    table, keys, _ = simhash.pivot_rows(fp, max_bits, 16)
    labels = list(range(len(fp)))
    for k in range(keys.shape[1]):
        order = np.lexsort((table[:, 0], keys[:, k]))
        u, v = simhash.joining_links(keys[order, k].view(np.int64), fp[order], table[order].view(np.int8), max_bits)
        for a, b in zip(np.searchsorted(fp, u), np.searchsorted(fp, v), strict=True):
            assert (int(fp[a]) ^ int(fp[b])).bit_count() <= max_bits
            old, new = labels[a], labels[b]
            labels = [new if x == old else x for x in labels]
    for i in range(len(fp)):
        for j in range(i):
            if (int(fp[i]) ^ int(fp[j])).bit_count() <= max_bits:
                assert labels[i] == labels[j]


def test_a_large_group_makes_few_links():
    rng = np.random.default_rng(1)
    fp = np.unique(np.uint64(1) << rng.integers(0, 20, 4000).astype(np.uint64))
    wide = np.unique(fp[:, None] ^ fp[None, :])
    table, keys, _ = simhash.pivot_rows(wide, 2, 16)
    order = np.lexsort((table[:, 0], keys[:, 0]))
    u, _ = simhash.joining_links(keys[order, 0], wide[order], table[order].view(np.int8), 2)
    assert len(u) < 20 * len(wide)


def near_components(fp, max_bits):
    """{fingerprint: smallest of its component}, by trying every change of up to two bits."""
    label = {int(x): int(x) for x in fp}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    flips = [1 << a for a in range(64)]
    flips += [a ^ b for n, a in enumerate(flips) for b in flips[:n]] if max_bits == 2 else []
    for x in list(label):
        for flip in flips:
            if x ^ flip in label:
                a, b = root(x), root(x ^ flip)
                label[max(a, b)] = min(a, b)
    return {x: root(x) for x in label}


def test_hot_keys_are_split_without_losing_a_link(spark):
    rng = np.random.default_rng(3)
    free = rng.integers(0, 1 << 26, 6000, np.uint64)
    base = np.uint64(0x5A5A1234DEADBEEF) >> np.uint64(26) << np.uint64(26)
    fp = np.unique(np.concatenate([base | free, free[:900] << np.uint64(30), base | np.arange(700, dtype=np.uint64)]))
    prints = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp long").repartition(4)
    table = simhash.pivot_table(prints, 2, rows_per_key=64)
    assert table.groupBy("key").count().agg({"count": "max"}).first()[0] <= 64
    links = simhash.linked(prints, 2, rows_per_key=64).collect()
    expected = near_components(fp, 2)
    label = {int(x): int(x) for x in fp}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for u, v in ((r.u % 2**64, r.v % 2**64) for r in links):
        assert (u ^ v).bit_count() <= 2
        a, b = root(u), root(v)
        label[max(a, b)] = min(a, b)
    assert {x: root(x) for x in label} == expected


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "é#", "$", "\x85\U0001f600"]), max_size=40))
def test_repeated_window_words(words):
    text = " ".join(words)
    n, chars, symbols, _, repeats, _ = brute.quality_counts(text)
    assert linerules.text_counts(text.encode()) == (n, chars, symbols, repeats)


@settings(max_examples=40, deadline=None)
@given(st.one_of(st.none(), st.integers(-5, 10**18)), st.text(max_size=40), st.binary(max_size=200), st.booleans())
def test_warc_record_round_trip(page, url, payload, revisit):
    digest = warc.base32_sha1(payload)
    data = warc.record(page, url, payload, digest, 3 if revisit else None, "2024-01-01T00:00:00Z")
    found = warc.parse_record(warc._packed(data))
    assert found["page_id"] == page and found["intact"]
    assert found["payload_bytes"] == len(payload) and found["payload_digest"] == digest
    assert found["payload"] == (None if revisit else payload)
    assert found["refers_to"] == (3 if revisit else None)


def test_ranges_are_coalesced_up_to_the_gap():
    assert warc.coalesced([(0, 10), (10, 5), (20, 5), (100, 1)], 5) == [
        (0, 25, [(0, 10), (10, 5), (20, 5)]),
        (100, 101, [(100, 1)]),
    ]


def test_reading_selected_records(spark, tables):
    index = warc.write_archives(spark.read.parquet(f"{tables}/pages.parquet"), archive_bytes=100)
    assert index.select("archive").distinct().count() > 1
    rows = warc.read_records(index.filter("page_id = 8 or page_id = 6"), segment_bytes=64).collect()
    assert {(r.page_id, r.record_type) for r in rows} == {(8, "revisit"), (6, "response")}
    assert next(r.payload for r in rows if r.page_id == 6) == b"<p>three</p>\r\n\r\nmore"


def test_small_payloads_are_responses(spark, tables):
    index = warc.write_archives(spark.read.parquet(f"{tables}/pages.parquet"), min_bytes=11)
    kinds = {(r.page_id, r.record_type) for r in warc.read_records(index).collect()}
    assert (2, "response") in kinds and (8, "revisit") in kinds


def test_sum_of_squares_identity():
    rng = np.random.default_rng(0)
    x, w, v = rng.normal(size=(5, 12)), rng.normal(size=12), rng.normal(size=(12, 3))
    pairs = [
        0.5 + row @ w + sum(v[i] @ v[j] * row[i] * row[j] for i in range(12) for j in range(i)) for row in x
    ]
    assert np.allclose(fm.logits(x, 0.5, w, v), pairs)


def test_machine_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2, (2000, 6)).astype(np.float32)
    y = (x[:, 0] != x[:, 1]).astype(np.float32)
    model = fm.fit(x, y)
    assert ((fm.logits(x, *model) > 0) == y).mean() > 0.95


def test_held_out_quality(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = fm.train(docs, labels)
    found = fm.score_quality(docs, model).join(labels, F.col("key_id") == F.col("doc_id")).filter("held_out").collect()
    assert len(found) > 50
    assert np.mean([(r.score >= 0.3) == (r.quality == 1) for r in found]) >= 0.95
    other = docs.selectExpr("doc_id + 1000000 as doc_id", "text", "'xx' as lang", "'s' as source", "n_chars")
    scores = [sorted(r.score for r in fm.score_quality(d, model).collect()) for d in (docs, other)]
    assert scores[0] == scores[1]


def test_repeated_documents_are_learned_from_once(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    some = docs.filter("doc_id % 3 = 0")
    once, often = (fm.train(d, labels) for d in (docs, docs.unionByName(some).unionByName(some)))
    assert once[0] == often[0]
    assert all((a == b).all() for a, b in zip(once[1:], often[1:], strict=True))


def test_no_labels_give_the_prior(spark, tables, empty_tables):
    docs, labels = spark.read.parquet(f"{tables}/documents.parquet"), spark.read.parquet(f"{empty_tables}/labels.parquet")
    rows = fm.score_quality(docs, fm.train(docs, labels)).collect()
    assert {r.score for r in rows} == {0.5}


def test_exponent_meets_the_entropy():
    shares = [0.7, 0.2, 0.07, 0.03]
    x = mixing.fit_exponent(shares, entropy_share=0.9)
    assert 0 < x < 1 and mixing.entropy(mixing.tempered(shares, x)) == pytest.approx(0.9 * np.log(4))
    assert mixing.fit_exponent(shares, entropy_share=0.1) == 1.0


def test_repetition_limit_wins():
    shares = [0.9, 0.09, 0.01]
    x = mixing.fit_exponent(shares, entropy_share=1.0, max_repeats=4.0)
    repeats = [w / s for w, s in zip(mixing.tempered(shares, x), shares, strict=True)]
    assert max(repeats) == pytest.approx(4.0)


@pytest.mark.parametrize(("budget", "entropy", "limit"), [(1.0, 0.98, 4.0), (0.3, None, None), (2.5, 1.0, 20.0)])
def test_mixture_meets_its_quotas(spark, budget, entropy, limit):
    rows = [(n, " ".join(["w"] * (n % 7)), "hot" if n % 3 else f"s{n % 4}") for n in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(docs, budget_share=budget, entropy_share=entropy, max_repeats=limit, block_tokens=200)
    found = mixed.collect()
    total = sum(n % 7 for n in range(600))
    sums, size = {}, {}
    for n, _, source in rows:
        size[source] = size.get(source, 0) + n % 7
    for r in found:
        sums[r.source] = sums.get(r.source, 0) + r.n_tokens
    weights = {r.source: r.weight for r in found}
    assert sum(weights.values()) == pytest.approx(1, abs=1e-6)
    for source, tokens in sums.items():
        quota = int(weights[source] * int(total * budget))
        assert quota <= tokens < quota + 7
        copies = [r.epoch for r in found if r.source == source]
        whole = quota // size[source]
        docs_of = sum(s == source for _, _, s in rows)
        assert all(copies.count(e) == docs_of for e in range(whole)) and max(copies, default=0) <= whole
    per_block = {}
    for r in found:
        per_block[r.block] = per_block.get(r.block, 0) + r.n_tokens
    assert set(per_block) == set(range(-(-int(total * budget) // 200)))


@pytest.mark.parametrize("same", [None, 7])
def test_rows_of_one_id_are_cut_one_by_one(spark, same):
    rows = [(same if n % 3 == 0 else n, f"t{n} " + "w " * 4, "a") for n in range(8, 308)]
    rows += [(same, "copy " * 5, "b")] * 100  # fully equal
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix(docs, budget_share=0.5, entropy_share=None, max_repeats=None, block_tokens=50).collect()
    sums = {}
    for r in found:
        sums[r.source] = sums.get(r.source, 0) + r.n_tokens
    weights = {r.source: r.weight for r in found}
    for source, tokens in sums.items():
        quota = int(weights[source] * 1000)
        assert quota <= tokens < quota + 5
    assert len({r.place for r in found if r.source == "a" and r.key_id == same}) > 10
    assert len({r.block for r in found if r.source == "a" and r.key_id == same}) > 5


def test_window_network_probabilities_sum_to_one():
    model = pseudolm.new_model()
    around = pseudolm.windows(np.array([5, 9, 1000, 7, 7]))[2:3]
    everything = np.arange(pseudolm.VOCABULARY)
    logs = pseudolm.log_probabilities(model, np.repeat(around, len(everything), axis=0), everything)
    assert np.exp(logs).sum() == pytest.approx(1, abs=1e-4)


def test_window_network_gradient():
    model = {k: v.astype(np.float64) for k, v in pseudolm.new_model().items()}
    numbers = np.array([5, 9, 1000, 7, 7, 3])
    around = pseudolm.windows(numbers)
    gradient = pseudolm._gradient(model, around, numbers)
    for name, place in (("embed", (7, 2)), ("inner", (3, 4)), ("given", (0, 1)), ("low", (2, 9)), ("high_bias", (0,))):
        loss = []
        for step in (1e-5, -1e-5):
            moved = {k: v.copy() for k, v in model.items()}
            moved[name][place] += step
            loss.append(-pseudolm.log_probabilities(moved, around, numbers).mean())
        assert gradient[name][place] == pytest.approx((loss[0] - loss[1]) / 2e-5, abs=1e-6)


def test_training_raises_the_likelihood(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    own = pseudolm.frequent_words(docs)

    def mean(model):
        row = pseudolm.score_documents(docs, model, own).selectExpr("sum(log_likelihood) / sum(n_tokens)").first()
        return row[0]

    assert mean(pseudolm.train(docs, own)) > mean(pseudolm.new_model()) + 0.3


def test_every_position_is_trained_once(spark, monkeypatch, tmp_path):
    seen = tmp_path / "seen"
    seen.mkdir()

    class Recorder(pseudolm.Trainer):
        def add(self, around, numbers):
            super().add(around, numbers)
            with open(seen / str(os.getpid()), "a") as out:
                out.writelines(f"{n}\n" for n in numbers)

    monkeypatch.setattr(pseudolm, "Trainer", Recorder)
    texts = ["a", "b c", "d e f g h i j k l m n o p", None, "q r s", "q r s"]
    own = {w.encode(): n for n, w in enumerate("abcdefghijklmnopqrs")}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for rounds in (1, 2, 5):
        for f in seen.iterdir():
            f.write_text("")
        pseudolm.train(docs, own, rounds=rounds)
        found = sorted(int(x) for f in seen.iterdir() for x in f.read_text().split())
        assert found == sorted([*range(19), 16, 17, 18])


def test_training_splits_each_text_once(spark, monkeypatch, tmp_path):
    seen = tmp_path / "seen"
    seen.mkdir()
    split = pseudolm.words_in

    def recorded(texts):
        with open(seen / str(os.getpid()), "a") as out:
            out.write("x" * len(texts))
        return split(texts)

    monkeypatch.setattr(pseudolm, "words_in", recorded)
    docs = spark.createDataFrame([*((n, f"a b{n} C  d") for n in range(7)), (7, None)], "doc_id long, text string")
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    pseudolm.train(docs, {b"a": 0}, rounds=4)
    assert sum(len(f.read_text()) for f in seen.iterdir()) == 8
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.none() | st.text(alphabet="abC \n\t\x0b\x0c\r\x1f\x85é|", max_size=30), max_size=12),
    st.integers(1, 40),
)
def test_words_of_texts_split_together(texts, size):
    column, found = pa.array(texts, pa.string()), []
    with mock.patch.object(pseudolm, "_GROUP", size):
        parts = [*pseudolm.groups(column)]
    for part in parts:
        words, of = pseudolm.words_in(column[part])
        found += [[w for w, k in zip(words.to_pylist(), of, strict=True) if k == n] for n in range(len(column[part]))]
    assert found == [(t or "").encode().lower().split() for t in texts]


@pytest.mark.parametrize("near", [0, 3, 1000])
def test_word_probabilities_follow_the_corpus_counts(spark, near):
    text = "common " * 9 + "rare seen seen " + " ".join(f"w{n} w{n}" for n in range(30))
    docs = spark.createDataFrame([(1, text), (1, text), (2, None)], "doc_id long, text string")
    counts = pseudolm.word_counts(docs)
    own = pseudolm.frequent_words(docs, count=1, counts=counts)
    assert own == {b"common": 0}
    tally, model = {r.word: r["count"] for r in counts.collect()}, pseudolm.new_model()
    probes = ["rare", "seen", "Common", "never-seen-garbage", "", "w3 common rare rare", *(f"w{n}" for n in range(30))]
    asked = spark.createDataFrame(list(enumerate(probes)), "doc_id long, text string")
    rows = pseudolm.score_documents(asked, model, own, counts=counts, near=near).collect()
    found = {probes[r.key_id]: (r.n_tokens, r.log_likelihood) for r in rows}
    classes = {}
    for w, n in tally.items():
        if w != "common":
            number = int(pseudolm.token_numbers(w.encode(), own)[0])
            classes[number] = classes.get(number, 0) + n
    for probe in probes:
        numbers = pseudolm.token_numbers(probe.encode(), own)
        log = 0.0
        if len(numbers):
            log = float(pseudolm.log_probabilities(model, pseudolm.windows(numbers), numbers).sum())
        for w, number in zip(probe.lower().split(), numbers, strict=True):
            if w != "common":
                share = tally[w] if w in tally else 257.0 ** -(len(w) + 1)
                log += np.log(share / (classes.get(int(number), 0) + 1))
        assert found[probe] == (len(numbers), pytest.approx(log, abs=1e-4))
    assert len(rows) == len(probes)


def test_colliding_digests_are_confirmed_by_their_strings(monkeypatch):
    names = sorted([b"com/", b"net/", b"org/"])
    part = (
        np.full(3, 7, np.uint64),
        np.array([0, 1, 0], np.uint8),
        np.cumsum([len(n) for n in names]),
        np.frombuffer(b"".join(names), np.uint8),
    )
    monkeypatch.setattr(urls, "_mapped", lambda name: part)
    probes = [b"net/", b"xyz/", b"org/"]
    assert list(urls._found("p", np.full(3, 7, np.uint64), probes)) == [(0, 1), (2, 0)]


def test_url_index_in_several_parts(spark):
    rules = spark.createDataFrame([(f"h{n}.com", "/", "block") for n in range(50)], "host string, path string, verdict string")
    index = urls.build_index(rules, spark.createDataFrame([("bad.org",)], "host string"), rows_per_part=7)
    assert len(index.parts) > 7
    pages = spark.createDataFrame([(n, f"http://a.h{n}.com/x") for n in range(60)] + [(99, "http://x.bad.org")], "page_id long, url string")
    found = {r.key_id: r.verdict for r in urls.judge_urls(pages, index).collect()}
    assert all((found[n] == "block") == (n < 50) for n in range(60)) and found[99] == "block"


def test_template_threshold(spark):
    docs = spark.createDataFrame(
        [(1, "w1 w2 w3 w4 w5 w6 w7 w8 w9"), (2, "w1 w2 w3 w4 w5 w6 w7 w8"), (3, "W10 w9 w8 w7 w6 w5 w4 w3 w2")],
        "doc_id long, text string",
    )
    template = [("t", " ".join(f"w{n}" for n in range(1, 11)))]
    rows = licenses.matching_blocks(docs, templates=template, threshold=0.9).collect()
    assert {(r.key_id, r.containment) for r in rows} == {(1, 0.9), (3, 0.9)}


def test_a_wrapped_notice_is_found(spark):
    mit = (
        "Permission is hereby granted, free of charge, to any person obtaining a copy\n"
        "of this software and associated documentation files (the \"Software\"), to deal\n"
    )
    bsd = (
        " * Redistribution and use in source and binary forms, with or without\r\n"
        " * modification, are permitted provided that the following conditions\r\n * are met:\r\n"
    )
    far = "word\n" * 45
    texts = [mit, bsd, far + mit + far + bsd, far + "Licensed under\nCC BY-SA 4.0", far]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = licenses.scan_licenses(docs).collect()
    found = {r.key_id: (r.labels, r.score) for r in rows}
    assert found == {
        0: (["mit"], 1.0), 1: (["bsd"], 1.0), 2: (["bsd", "mit"], 1.0), 3: (["cc-by-sa"], 1.0), 4: ([], 0.0),
    }


def test_long_templates_match_their_copies(spark):
    long = " ".join(f"w{n}" for n in range(300))
    far = "other " * 137
    docs = spark.createDataFrame([(1, long), (2, far + long + " " + far), (3, far + long[:600] + " " + far)], "doc_id long, text string")
    templates = [("long", long), ("short", "All rights reserved.")]
    best = licenses.matching_blocks(docs, templates=templates).groupBy("key_id", "label").max("containment")
    assert sorted(map(tuple, best.collect())) == [(1, "long", 1.0), (2, "long", 1.0)]


def test_words_said_far_apart_are_no_notice(spark):
    seats = "All passengers who board early have certain rights, and seats by the window stay reserved for them."
    docs = spark.createDataFrame([(1, seats), (2, "(c) Ex. All\nrights reserved."), (3, None)], "doc_id long, text string")
    found = {r.key_id: (r.labels, r.score) for r in licenses.scan_licenses(docs).collect()}
    assert found == {1: ([], 0.0), 2: (["all-rights-reserved"], 1.0), 3: ([], 0.0)}


def test_only_lines_of_boilerplate_fail(spark):
    stay = [
        "The boat was powered by a diesel engine.",
        "She wanted to read more books.",
        "Spread more",
        "thread more!",
        "click hereafter",
        "Sourdough bread more often than rye",
        "Nobody could share this view of the privacy policy that the town had chosen",
    ]
    go = [
        "Read more",
        "READ MORE...",
        "Click here to read more",
        "(c) 2024 Ex. All rights reserved.",
        "Privacy Policy | Terms of Use",
        "Read more, read more",
        "Powered by WordPress",
    ]
    prose = " ".join(f"v{n}" for n in range(400))
    docs = spark.createDataFrame([(1, "\n".join([prose, *stay])), (2, "\n".join([*go, prose, *stay]))], "doc_id long, text string")
    rows = {r.key_id: r for r in linerules.judge_quality(docs).collect()}
    assert rows[1].n_failed_lines == 0 and rows[2].n_failed_lines == len(go)
    assert rows[1].cleaned_text == rows[2].cleaned_text == "\n".join([prose, *stay])


def test_a_long_clean_line_is_kept(spark):
    words = " ".join(topics.values()).split()
    clean = " ".join(words[:20_000])
    assert len(set(words[:20_000])) < 0.3 * 20_000
    assert linerules.repeating_lines(" ".join(words).encode()) == []
    spin = "buy these fine things from us now " * 10
    other = " ".join(f"v{n}" for n in range(400))
    texts = [clean, f"{other}\n{spin}", f"{clean}\n{spin}\n" + "go " * 11]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.key_id: (r.kept, r.n_failed_lines) for r in linerules.judge_quality(docs).collect()}
    assert found == {0: (True, 0), 1: (True, 1), 2: (True, 1)}


def test_shuffled_joins_give_the_same_contamination(spark, tables):
    docs, items = (spark.read.parquet(f"{tables}/{t}.parquet") for t in ("documents", "benchmark"))
    small, shuffled = (
        decontam.judge_contamination(docs, items, broadcast_rows=n).select("key_id", "n_words", "n_hit", "items")
        for n in (10**6, 0)
    )
    assert sorted(map(repr, small.collect())) == sorted(map(repr, shuffled.collect()))


def test_a_shared_preamble_stays_rows(spark):
    preamble = "answer the next question with one of the four given letters"
    items = spark.createDataFrame([(n, f"{preamble} q{n}") for n in range(50)], "item_id long, text string")
    uses = decontam.item_windows(items, "item_id", "text", 10)
    assert uses.count() == 150 and all(f.dataType.typeName() != "array" for f in uses.schema if f.name != "win")
    docs = spark.createDataFrame([(1, f"so {preamble} q7"), (2, "clean")], "doc_id long, text string")
    for limit in (0, 1 << 20):
        rows = decontam.judge_contamination(docs, items, broadcast_bytes=limit).collect()
        assert {r.key_id: (r.n_hit, len(r["items"]), r.containment) for r in rows} == {1: (12, 50, 1.0), 2: (0, 0, 0.0)}


def test_salted_shards_give_the_same_lines(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    plain, cut = (
        linededup.dropped_lines(docs, keys_per_shard=k, probes_per_group=p) for k, p in ((1 << 16, 1 << 18), (2, 3))
    )
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, cut.collect()))


def test_lines_of_equal_hash_are_told_apart(spark, tables, monkeypatch):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    before = sorted(map(repr, linededup.dropped_lines(docs).collect()))
    plain = linededup.line_hashes
    monkeypatch.setattr(linededup, "line_hashes", lambda *how: plain(*how).withColumn("h", F.pmod("h", F.lit(3))))
    assert before and sorted(map(repr, linededup.dropped_lines(docs, keys_per_shard=4).collect())) == before
