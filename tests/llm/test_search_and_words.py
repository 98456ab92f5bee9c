"""Ranked search, byte-level BPE and spelling variants beyond their contracts' small tables."""

import random
import re
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pytest

from zephyrine.llm import bpe, lexsearch, pseudolm, spelling


def some_texts(n, seed, vocabulary=60, most=40):
    draw = random.Random(seed)
    return [" ".join(f"w{int(draw.random() ** 2 * vocabulary)}" for _ in range(draw.randint(0, most))) for _ in range(n)]


def searched(spark, docs, items, **settings):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string")
    rows = lexsearch.search(frame, asked, **settings).select("item_id", "rank", "key_id", "score").collect()
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("block_terms", [100_000, 40])
def test_search_equals_brute_force(spark, block_terms):
    docs = list(enumerate(some_texts(700, 1)))
    items = list(enumerate(some_texts(12, 2, most=15)))
    expected = sorted(brute.ranked(docs, items, 7), key=repr)
    assert searched(spark, docs, items, top=7, block_terms=block_terms) == expected


def test_search_ranks_copies_by_id_and_repeats_items(spark):
    docs = [(n, "alpha beta gamma") for n in range(1200)] + [(None, "alpha beta gamma"), (5000, "alpha delta")]
    docs += [(6000 + n, f"other{n}") for n in range(30)]
    items = [(1, "Alpha, beta"), (1, "Alpha, beta"), (2, "delta"), (3, "unknown"), (None, "other3")]
    assert searched(spark, docs, items) == sorted(brute.ranked(docs, items), key=repr)


def test_summaries_bound_the_scores_of_their_blocks():
    draw = np.random.default_rng(5)
    queries = [np.sort(draw.choice(80, 12, replace=False)).astype(np.int32) for _ in range(9)]
    docs = []
    for n in range(200):
        terms = np.sort(draw.choice(80, draw.integers(1, 30), replace=False)).astype(np.int32)
        docs.append((n, terms, draw.integers(1, 1000, len(terms)).astype(np.int32)))
    made = lexsearch._index_row(0, docs, lexsearch._Partners(queries))
    lists = [made[name] for name in ("list_terms", "list_ends", "members", "summary_ends", "summary_terms", "maxima")]
    terms, ends, members, summary_ends, summary_terms, maxima = map(np.asarray, lists)
    start = 0
    for place, term in enumerate(terms.tolist()):
        begin, first = (ends[place - 1], summary_ends[place - 1]) if place else (0, 0)
        holding = members[begin : ends[place]]
        assert sorted(holding) == [n for n, own, _ in docs if term in own]
        named = summary_terms[first : summary_ends[place]].tolist()
        for at in range(0, len(holding), lexsearch.BLOCK_DOCS):
            block = holding[at : at + lexsearch.BLOCK_DOCS]
            tops = dict(zip(named, maxima[start : start + len(named)].tolist(), strict=True))
            start += len(named)
            for q in (q for q in queries if term in q):
                for u in q.tolist():
                    own = [dict(zip(docs[n][1].tolist(), docs[n][2].tolist(), strict=True)).get(u, 0) for n in block]
                    assert tops.get(u, 0) == max(own)


def test_terms_are_left_out_only_if_they_cannot_reach_the_threshold():
    reach = np.array([50, 5, 20, 100])
    assert sorted(lexsearch._essential(reach, 26)) == [0, 3]
    assert sorted(lexsearch._essential(reach, 25)) == [0, 2, 3]
    assert sorted(lexsearch._essential(reach, 1)) == [0, 1, 2, 3]
    assert sorted(lexsearch._essential(reach, 176)) == []


def coder():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        return bpe.encoding(file.read(), public_tokenizers.PATTERN)


def test_pieces_of_long_texts_have_the_ids_of_the_whole(monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 7)
    monkeypatch.setattr(bpe, "_RUN", re.compile(f"[{bpe.WHITE}]{{4,}}"))
    draw, own = random.Random(3), coder()
    signs = "ab'st 19 \n\t 　 \xa0\x85\x1c\x1d!é漢\U0001f600—  "
    for _ in range(3000):
        text = "".join(draw.choice(signs) for _ in range(draw.randint(0, 60)))
        ids = bpe.encode(own, text)
        assert ids.tolist() == own.encode_ordinary(text)
        assert bpe.decode(own, ids) == text.encode()
        assert "".join(piece for piece, _ in bpe.safe_pieces(text)) == text


@pytest.mark.parametrize("text", [" {}", " {}x", "a\n {}b", "x{}", "a{} b\n{}", "'t{}é"])
def test_very_long_runs_are_encoded(text):
    own, sign = coder(), text[text.index("{") - 1]
    long = text.format(*[sign * 100_000] * 2)
    assert bpe.encode(own, long).tolist() == own.encode_ordinary(long)
    beyond = text.format(*[sign * 900_000] * 2)  # the library alone overflows on white space of this length
    assert bpe.decode(own, bpe.encode(own, beyond)) == beyond.encode()


def test_ids_that_are_no_valid_text_decode_to_bytes(spark):
    ranks = bpe.load_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    own = bpe.encoding(ranks.value, public_tokenizers.PATTERN)
    half = [own.encode_single_token(b"\xe6")]
    frame = spark.createDataFrame([(1, half), (2, [])], "key_id long, ids array<int>")
    found = bpe.decode_ids(frame, ranks, public_tokenizers.PATTERN).orderBy("key_id").collect()
    assert [bytes(r.decoded) for r in found] == [b"\xe6", b""]


def test_rank_files_beyond_the_bound_are_refused(spark):
    with pytest.raises(ValueError, match="more than"):
        bpe.load_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), 1000)


def some_words(n, seed, letters="abcdé", most=9):
    draw = random.Random(seed)
    return sorted({"".join(draw.choice(letters) for _ in range(draw.randint(5, most))) for _ in range(n)})


@pytest.mark.parametrize(("letters", "key_rows"), [("abcdé", 20_000), ("ab", 3), ("aab", 20)])
def test_near_words_equal_brute_force(spark, monkeypatch, letters, key_rows):
    monkeypatch.setattr(spelling, "KEY_ROWS", key_rows)
    words = some_words(400, 4, letters)
    frame = spark.createDataFrame([(w, 3 + k % 50) for k, w in enumerate(words)], "word string, n long")
    found = sorted((r.word, r.near) for r in spelling.near_pairs(frame).collect())
    assert found == sorted((a, b) for a in words for b in words if brute.one_edit(a, b))


def test_pivots_are_the_cheapest_disjoint_bigrams_of_the_prefix():
    words = some_words(300, 6)
    frequency = Counter(g for w in words for g in {w[p : p + 2] for p in range(len(w) - 1)})
    for word in words:
        places, last = spelling.prefix_places(word, frequency)
        rarity = {p: frequency[word[p : p + 2]] for p in range(len(word) - 1)}
        assert len(places) >= 3 and places == [p for p in rarity if rarity[p] <= last]
        costs = {p: spelling.expected_meetings(word, p, frequency) for p in rarity}
        a, b = spelling.pivot_places(word, places, frequency)
        assert abs(a - b) >= 2
        assert costs[a] + costs[b] == min(costs[p] + costs[q] for p in places for q in places if q - p >= 2)


def test_roots_follow_long_chains(spark):
    words = [("abcdefghijk"[:k] + "z" * (11 - k), 3 * 2**k) for k in range(12)]
    frame = spark.createDataFrame(words, "word string, n long")
    found = {r.word: (r.form, r.root) for r in spelling.follow_forms(spelling.variant_forms(frame)).collect()}
    assert {root for _, root in found.values()} == {"abcdefghijk"}
    assert sum(form is None for form, _ in found.values()) == 1


def test_runs_are_latin_letters_only():
    assert spelling.split_runs("Éa×÷b1Œx ÀB-cıd\U0001f600E") == [
        w.encode("latin-1") for w in ("Éa×÷b", "x", "Àb", "c", "d", "e")
    ]
    assert spelling.split_runs(None) == []


@pytest.mark.parametrize("most", [0, 1, 5, 40, 99, 100, 1000])
def test_the_cut_leaves_as_many_words_as_fit(spark, most):
    counts = [1] * 60 + [2] * 20 + [7] * 10 + [1000 + k // 2 for k in range(9)] + [10**12]
    frame = spark.createDataFrame([(f"w{k}", n) for k, n in enumerate(counts)], "word string, count long")
    cut = pseudolm.count_beyond(frame, most)
    kept = sum(n > cut for n in counts)
    assert kept <= most
    assert cut == 0 or sum(n >= cut for n in counts) > most


def test_scores_do_not_depend_on_how_many_counts_go_to_the_tasks(spark):
    texts = some_texts(60, 9, vocabulary=2000)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counts = pseudolm.word_counts(docs)
    own = dict(list(pseudolm.frequent_words(docs, count=20, counts=counts).items()))
    model = pseudolm.train(docs, own)

    def scores(near):
        found = pseudolm.score_documents(docs, model, own, counts=counts, near=near).collect()
        return sorted((r.key_id, r.n_tokens, round(r.log_likelihood, 6)) for r in found)

    assert scores(1) == scores(30) == scores(300) == scores(1 << 16)
