"""Plain Python versions of the operators' contracts, for small inputs."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

UPPER = {c: c + 32 for c in range(65, 91)}
BLANKS = " \t\n\x0b\x0c\r"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def blank_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def phrase_counts(text, phrases):
    """(n_words, places, base labels)."""
    w, places, labels = words(text), [], set()
    for phrase, label in phrases:
        parts = phrase.split(" ")
        for i in range(len(w) - len(parts) + 1):
            if w[i : i + len(parts)] == parts:
                places.append(i)
                labels.add(label)
    return len(w), places, labels


def template_labels(text, templates, threshold, spread):
    """{label: best containment} over all stretches of ``spread`` template lengths."""
    found = defaultdict(float)
    w = words(text)
    for label, template in templates:
        t, span = set(words(template)), spread * len(words(template))
        for n in range(max(1, len(w) - span + 1)):
            share = len(t & set(w[n : n + span])) / len(t) if t else 0
            if t and share >= threshold - 1e-9 and share > 0:
                found[label] = max(found[label], share)
    return dict(found)


def line_key(line):
    return line.strip(BLANKS).translate(UPPER)


def kept_lines(docs):
    """[(id, n_lines, n_dropped, kept text)] of [(id, text)]."""
    holders = defaultdict(set)
    for id_, text in docs:
        for line in (text or "").split("\n"):
            holders[line_key(line)].add(id_)
    found = []
    for id_, text in docs:
        lines, kept = (text or "").split("\n"), []
        for line in lines:
            key = line_key(line)
            held = holders[key]
            known = [h for h in held if h is not None]
            lose = len(key) >= 20 and len(held) >= 3 and (id_ is None or id_ != max(known))
            if not lose:
                kept.append(line)
        found.append((id_, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return found


def contamination(text, items, width=10):
    """(n_words, n_hit, item ids as sorted text) for items [(id, text)]."""
    w, hit, ids = words(text), set(), set()
    for id_, item in items:
        iw = words(item)
        if not iw:
            continue
        size = min(width, len(iw))
        windows = {tuple(iw[i : i + size]) for i in range(len(iw) - size + 1)}
        for i in range(len(w) - size + 1):
            if tuple(w[i : i + size]) in windows:
                hit.update(range(i, i + size))
                if id_ is not None:
                    ids.add(str(id_))
    return len(w), len(hit), sorted(ids)


def quality_counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    w = blank_words(text)
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if blank_words(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = set()
    for i in range(len(w) - 2):
        if windows[tuple(w[i : i + 3])] > 1:
            covered.update((i, i + 1, i + 2))
    repeat = len(covered)
    failed = len(w) < 50 or 100 * repeat > 50 * len(w)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(w), sum(map(len, w)), symbols, dup, repeat, failed


def url_verdict(url, rules, blocked):
    """(host, path, rule, verdict)."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0].translate(UPPER)
        path = re.match(r"[^/?#]*([^?#]*)", rest)[1]
    fits = []
    for h, p, verdict in rules:
        if host and (host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((len(h + p), len(h), h + p, verdict))
    if fits:
        _, _, rule, verdict = max(fits)
        return host, path, rule, verdict
    listed = any(host == b or host.endswith("." + b) for b in blocked)
    return host, path, None, "block" if listed else "allow"


def warc_rows(pages):
    """[(page_id, bytes, digest, type, refers_to)] of [(page_id, html)]."""
    first = {}
    for id_, html in pages:
        body = (html or "").encode()
        known = first.get(body)
        if id_ is not None and (known is None or id_ < known):
            first[body] = id_
        else:
            first.setdefault(body, None)
    found = []
    for id_, html in pages:
        body = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        keeper = first[body]
        revisit = keeper is not None and id_ != keeper
        found.append((id_, len(body), digest, "revisit" if revisit else "response", keeper if revisit else None))
    return found


def simhash(text, shingle=3):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").translate(UPPER).encode())
    if not w:
        return 0
    size = min(shingle, len(w))
    grams = [b" ".join(w[i : i + size]) for i in range(len(w) - size + 1)]
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(docs, max_bits=2):
    """[(id, fingerprint, component)] of [(id, text)] by comparing all pairs."""
    prints = [simhash(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= max_bits:
                parent[root(i)] = root(j)
    least = {}
    for i, (id_, _) in enumerate(docs):
        known = [x for x in (least.get(root(i)), id_) if x is not None]
        least[root(i)] = min(known, default=None)
    return [(id_, prints[i], least[root(i)]) for i, (id_, _) in enumerate(docs)]


def phrase_words(line, boilerplate):
    w = words(line)
    found = 0
    for phrase in boilerplate:
        parts = phrase.split(" ")
        found += len(parts) * sum(w[i : i + len(parts)] == parts for i in range(len(w)))
    return found


def repeated_within(w, reach, width=3):
    """Words in windows of ``width`` words that occur again within ``reach`` words."""
    places = defaultdict(list)
    for i in range(len(w) - width + 1):
        places[tuple(w[i : i + width])].append(i)
    hit = set()
    for spots in places.values():
        for a, b in zip(spots, spots[1:], strict=False):
            if b - a <= reach:
                hit.update(range(a, a + width), range(b, b + width))
    return len(hit)


def line_fails(line, rules, boilerplate):
    w = blank_words(line)
    n = len(w)
    if not n:
        return False
    noisy = sum(1 for x in w if re.search(r"[#*$%&<>]{2}|!!", x))
    pieces = len(re.findall(r"[|»›>](?:[ \t]|\Z)", line)) + 1
    figures = sum(1 for x in w if re.search("[0-9]", x))
    furniture = any(p in line.translate(UPPER) for p in boilerplate)
    furniture = furniture and phrase_words(line, boilerplate) >= rules.boilerplate_share * len(words(line))
    repeats = n >= rules.repeat_words and len(set(w)) < n * rules.distinct_share
    return (
        noisy >= max(n * rules.noisy_words, 2)
        or (pieces >= rules.bar_pieces and n / pieces <= rules.piece_words and figures < n * rules.figure_words)
        or (n <= rules.boilerplate_words and furniture)
        or (repeats and repeated_within(w, rules.repeat_reach) > n * rules.repeated_share)
    )


def cleaned(text, rules, boilerplate):
    """(kept, cleaned text)."""
    lines = (text or "").split("\n")
    fails = [line_fails(line, rules, boilerplate) for line in lines]
    lost = sum(len(blank_words(line)) for line, f in zip(lines, fails, strict=True) if f)
    n, *_, failed = quality_counts(text)
    kept = not failed and lost <= n * rules.max_loss
    return kept, "\n".join(line for line, f in zip(lines, fails, strict=True) if not f)


def search_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def ranked(docs, items, top=10):
    """(item, rank, doc, score) rows of the ranked search over (id, text) lists."""
    found = [(i, Counter(search_terms(t))) for i, t in docs]
    found = [(i, c, sum(c.values())) for i, c in found if c]
    n_docs, n_terms = len(found), sum(n for _, _, n in found)
    df = Counter(t for _, c, _ in found for t in c)
    for item, text in items:
        scores = []
        for i, c, n in found:
            m = 10 + 90 * n * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                for t in set(search_terms(text)) & set(c)
            )
            if score > 0:
                scores.append((-score, i is not None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(scores)[:top], 1):
            yield item, rank, i, -score


def spelling_counts(docs, least_length=5, least_count=3, noise=97):
    """{word: n} with the planted deletions."""
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            mark = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if mark % noise == 0:
                run = run[: mark % len(run)] + run[mark % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= least_length and k >= least_count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def variants(n):
    """(word, form, root, n, n_near, form_n) of {word: n}."""
    forms, near = {}, {}
    for w in n:
        near[w] = [x for x in n if one_edit(w, x)]
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        forms[w] = best if best is not None and n[best] >= 2 * n[w] else None
    for w in n:
        root = w
        while forms[root] is not None:
            root = forms[root]
        yield w, forms[w], root, n[w], len(near[w]), n[forms[w]] if forms[w] else None
