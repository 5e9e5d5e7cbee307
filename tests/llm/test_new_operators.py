"""Ranked search, bit-plane clusters and license scans against brute force, and on awkward tables."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SMALL
from corpus_fixtures import LONG, NOISE, ROWS, awkward, docs_of, empty  # noqa: F401
from logweir.llm import bags, bitplanes, licenses, queries

# --- ranked search


def plain_search(docs, items, top):
    """Rows (item number, rank, key, score) by scoring every document for every item."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))

    held = [(k, Counter(terms(t))) for k, t in docs]
    held = [(k, c, c.total()) for k, c in held if c]
    n, length = len(held), sum(size for _, _, size in held)
    df = Counter(w for _, c, _ in held for w in c)
    found = []
    for item, text in enumerate(items):
        scored = []
        for k, c, size in held:
            m = 100 - 50 + 50 * size * n // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (1000000000 * c[w] // (1000 * c[w] + 20 * m)) for w in set(terms(text)) if w in c)
            if score > 0:
                scored.append((-score, k is None, k or 0, k))
        found += [(item, rank, k, -s) for rank, (s, _, _, k) in enumerate(sorted(scored, key=lambda x: x[:3])[:top], 1)]
    return found


@pytest.mark.parametrize("block_terms", [bags.BLOCK_TERMS, 9])
def test_search_against_scoring_everything(spark, docs_of, block_terms):
    rng = random.Random(block_terms)
    words = ["the", "of", *(f"w{i}" for i in range(30)), "Ünï", "日本"]
    texts = [" ".join(rng.choices(words, weights=[40, 30] + [1] * 32, k=rng.randrange(0, 30))) for _ in range(60)]
    # Groups of copies, repeated rows, no key, no words, and one group that holds a third of all rows.
    rows = [(rng.randrange(80), t) for t in texts + texts[:20] + texts[:20]] + [(None, texts[0]), (7, None), (8, ""), (9, "!?")] + [(i + 200, "The w1 of THE w2") for i in range(60)]
    items = ["w1 w2, the w3", "", None, "of the W4 Ünï", "unseen", "w1 w2, the w3", "日本 w29", " ".join(words)]
    docs = docs_of([(k, t, "en", "a") for k, t in rows])
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    got = bags.ranked(docs, frame, top=7, block_terms=block_terms).collect()
    assert sorted((r["own"], r["rank"], r["key"], r["score"]) for r in got) == plain_search(rows, items, 7)


def test_search_on_awkward_tables(spark, awkward, empty):
    items = spark.createDataFrame([(1, "alpha1 beta1 größe"), (1, "alpha1 beta1 größe"), (None, "w5x"), (2, None)], "item_id long, text string")
    got = bags.ranked(awkward, items).collect()
    expected = plain_search([r[:2] for r in ROWS], ["alpha1 beta1 größe"] * 2 + ["w5x", None], 50)
    assert sorted((r["own"] is None, r["own"], r["rank"], str(r["key"]), r["score"]) for r in got) == sorted(
        (i == 2, [1, 1, None, 2][i], rank, str(k), s) for i, rank, k, s in expected)
    assert bags.ranked(empty, items).count() == 0 and bags.ranked(awkward, items.limit(0)).count() == 0


def test_bags_differ_where_hashes_would_not(spark):
    block = bags.Block([(0, [b"a", b"b"]), (1, [b"b"])])
    assert block.bag([b"b", b"a", b"b", b"x"]) != block.bag([b"a", b"a", b"b"]) and block.bag([b"x"]) == b""
    big = np.array([1 << 40, 3], np.int64)
    scores = block.scores([block.bag([b"a", b"b"]), b""], [50, 50], big)
    part = 1000000000 // 2000
    assert scores.tolist() == [[((1 << 40) + 3) * part, 3 * part], [0, 0]]


# --- clusters


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-(1 << 27), (1 << 27) - 1) | st.integers(-200, 200), min_size=64, max_size=64), min_size=1, max_size=6), st.randoms())
def test_planes_give_exact_dot_products(rows, rng):
    a = np.array(rows, np.int64)
    b = np.array([[rng.randrange(-300, 300) for _ in range(64)] for _ in range(3)], np.int64)
    planes, other = bitplanes.planes_of(bitplanes.pack(a)), bitplanes.planes_of(bitplanes.pack(b))
    assert (bitplanes.numbers_of(planes) == a).all()
    assert bitplanes.dots(planes, other).tolist() == [[sum(x * y for x, y in zip(u, v)) for v in b.tolist()] for u in a.tolist()]
    cluster, distance = bitplanes.nearest(planes, b)
    plain = [[sum((x - y) ** 2 for x, y in zip(u, v)) for v in b.tolist()] for u in a.tolist()]
    assert cluster.tolist() == [d.index(min(d)) for d in plain] and distance.tolist() == list(map(min, plain))


def plain_clusters(rows, k, rounds):
    held = [(i, [max(-(1 << 27), min((1 << 27) - 1, math.floor(256 * x) if abs(x) < 1e300 else int(math.copysign(1 << 60, x)))) for x in v])
            for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(held, key=lambda r: hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest())
    centroids = [list(v) for _, v in order[:k]]

    def assigned():
        found = []
        for _, v in held:
            d = [sum((x - y) ** 2 for x, y in zip(v, c)) for c in centroids]
            found.append((d.index(min(d)), min(d)))
        return found

    for _ in range(rounds):
        at = assigned()
        for c in range(len(centroids)):
            mine = [v for (_, v), (a, _) in zip(held, at) if a == c]
            if mine:
                centroids[c] = [sum(x) // len(mine) for x in zip(*mine)]
    at = assigned()
    return sorted((str(i), c, d, sum(e for b, e in at if b == c), sum(e for _, e in at),
                   hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for (i, _), (c, d) in zip(held, at))


@pytest.mark.parametrize("k", [4, 500])
def test_clusters_against_plain_rounds(spark, k):
    rng = random.Random(k)
    near = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(3)]
    rows = [(i, [x + rng.gauss(0, 0.2) for x in near[i % 3]]) for i in range(90)]
    rows += [(i + 100, near[0]) for i in range(60)] + [(7, near[1]), (7, near[1]), (None, near[2])]  # one group of copies, repeated keys, no key
    rows += [(500, None), (501, []), (502, near[0][:63]), (503, near[0] + [0.0]), (504, [*near[0][:63], None]), (505, [*near[0][:63], math.nan]),
             (506, [*near[0][:63], -math.inf]), (507, [*near[0][:63], 1e308]), (508, [-3e6, *near[0][:63]])]
    frame = spark.createDataFrame([(i, v, "noise", "noise") for i, v in rows], "vec_id long, embedding array<double>, key string, cluster string").repartition(5)
    got, centroids = bitplanes.clusters(frame, k=k, rounds=3)
    found = sorted((str(r["key"]), r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in got.collect())
    if k == 4:
        assert found == plain_clusters(rows, k, 3)
    else:  # a centroid per vector
        assert len(centroids) == len(found) == 90 + 63 + 2 and all(r[2] == 0 for r in found)


def test_clusters_without_vectors(spark):
    frame = spark.createDataFrame([(1, None), (2, [1.0])], "vec_id long, embedding array<float>")
    for vectors in (frame, frame.limit(0)):
        got, centroids = bitplanes.clusters(vectors)
        assert got.count() == 0 and len(centroids) == 0
    assert got.columns == ["key", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


# --- licenses


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=9), min_size=1, max_size=4), st.lists(st.integers(0, 4), max_size=25))
def test_automaton_against_every_run(sequences, words):
    automaton = licenses.Automaton(sequences)
    assert len(automaton.size) <= 2 * sum(map(len, sequences)) + 1
    for at, (size, state) in enumerate(automaton.statistics(words), 1):
        def places(n):
            return [(s, e) for s, q in enumerate(sequences) for e in range(n, len(q) + 1) if n and q[e - n:e] == words[at - n:at]]

        longest = max(n for n in range(at + 1) if n == 0 or places(n))
        assert size == longest and (not size or list(automaton.ends[state]) == places(size))


def plain_scan(scanner, templates, words):
    """Base phrases, and spans by matches found by trying every run."""
    base = sorted((i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.encode().split())
    longest = []
    for at in range(1, len(words) + 1):
        n = 0
        for m in range(1, at + 1):
            if not any(t[i:i + m] == words[at - m:at] for t in [*templates, *(p.encode().split() for p in licenses.PHRASES)] for i in range(len(t))):
                break
            n = m
        longest.append(n)
    ends = [at for at in range(1, len(words) + 1) if longest[at - 1] >= scanner.min_match and (at == len(words) or longest[at] <= longest[at - 1])]
    spans = []
    for number, template in enumerate(templates):
        chains = []
        for stop in ends:
            n = longest[stop - 1]
            places = [e for e in range(n, len(template) + 1) if template[e - n:e] == words[stop - n:stop]]
            for e in places:
                if not chains:
                    break
                begin, upto, done, covered = chains[-1]
                gain = min(e - done, stop - max(stop - n, upto), n)
                if gain > 0 and e - gain - done <= scanner.gap and stop - gain - upto <= scanner.gap:
                    chains[-1] = (begin, stop, e, covered + gain)
                    break
            else:
                if places:
                    chains.append((stop - n, stop, places[0], n))
            if places and not chains:
                chains.append((stop - n, stop, places[0], n))
        spans += [(scanner.labels[number], b, u, c, len(template)) for b, u, _, c in chains if 100 * c >= scanner.covered * len(template)]
    return base, sorted(spans, key=lambda s: (s[1], s[2], s[0]))


@settings(max_examples=120, deadline=None)
@given(st.randoms())
def test_scan_against_trying_every_run(rng):
    words = "the license is granted under terms cc by general public all rights reserved x".split()
    templates = [("t" + str(i), " ".join(rng.choices(words, k=rng.randrange(1, 12)))) for i in range(4)]
    scanner = licenses.Scanner(templates, gap=3)
    text = []
    for _ in range(rng.randrange(0, 6)):
        text += rng.choices([*words, "other"], k=rng.randrange(0, 6))
        piece = rng.choice(templates)[1].split()
        if rng.random() < 0.5:
            piece[rng.randrange(len(piece))] = "changed"
        text += piece
    found = scanner.scan([w.encode() for w in text])
    assert (sorted(found[0]), found[1]) == plain_scan(scanner, [licenses.words_of(t.encode()) for _, t in templates], [w.encode() for w in text])


def test_notices_are_found_edited_and_clean_texts_are_not():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    for label, notice in licenses.TEMPLATES:
        words = licenses.words_of(f"Some words before. {notice}\nAnd some after".encode())
        size = len(licenses.words_of(notice.encode()))
        assert (label, 3, 3 + size, size, size) in scanner.scan(words)[1]
        if size > 40:  # a word in fifteen changed
            words[10::15] = [b"changed"] * len(words[10::15])
            assert label in {s[0] for s in scanner.scan(words)[1]}
    clean = "the license to copy and modify is a right of all under the terms of this work and the rights are reserved by law".encode()
    assert scanner.scan(licenses.words_of(clean)) == ([], [])


def test_license_scan_on_awkward_tables(spark, awkward, empty, docs_of):
    rows = licenses.licences(awkward).collect()
    assert len(rows) == len(ROWS) and {r["n_words"] for r in rows if r["key"] in (8, 9, 10)} == {0}
    assert all(r["base"] == [] and r["spans"] == [] for r in rows)
    assert licenses.licences(empty).count() == 0 and licenses.licences(awkward, templates=[("none", "!")]).count() == len(ROWS)
    long = docs_of([(1, LONG + " CC-BY " + LONG + " all RIGHTS  reserved.\nReleased under the MIT License.", "en", "a")])
    (r,) = licenses.licences(long).collect()
    n = len(licenses.words_of(LONG.encode()))
    assert [(b["start"], b["label"]) for b in r["base"]] == [(n, "cc-by"), (2 * n + 2, "reserved")]
    assert [(s["label"], s["start"], s["stop"]) for s in r["spans"]] == [("mit", 2 * n + 5, 2 * n + 10)] * len(r["spans"]) and r["spans"]


def test_license_query_against_plain_words(spark):
    import duckdb

    docs = duckdb.connect().execute(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    scanner = licenses.Scanner(licenses.TEMPLATES)
    templates = [licenses.words_of(t.encode()) for _, t in licenses.TEMPLATES]
    got = {r["doc_id"]: r for r in queries.op13_license_scan(spark, SMALL).collect()}
    assert len(got) == len(docs)
    for key, text in docs:
        words = licenses.words_of(text.encode())
        r, (base, _) = got[key], ([], [])
        base = [(i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.encode().split()]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (
            len(words), len(base), min((i for i, _ in base), default=None), max((i for i, _ in base), default=None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in base})) and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        if re.search(r"licen[sc]|rights reserved", text, re.I):
            lines = [licenses.words_of(x.encode()) for x in text.split("\n")]
            spans = [s for x in lines for s in plain_scan(scanner, templates, x)[1]] if len(words) < 400 else []
            assert {s[0] for s in spans} <= set(r["labels"].split(","))
        else:
            assert r["labels"] == "" and r["score"] == 0
