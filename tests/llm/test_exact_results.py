"""Operators against brute force: fingerprint links, components, piece segmentation, chunks, tokens, samples, trees."""

import itertools
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpus_fixtures import awkward, docs_of, empty  # noqa: F401
from conftest import SMALL
from logweir.llm import chunks, importance, secrets, simhash, tokens, warc
from logweir.llm import sentencepiece as sp
from logweir.llm.components import components
from logweir.llm.quality_rules import bucket, least_of, repeated_words

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def groups_of(n, pairs):
    label = list(range(n))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in pairs:
        a, b = sorted((root(i), root(j)))
        label[b] = a
    return [root(i) for i in range(n)]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("block", [simhash.BLOCK, 16])
def test_links_connect_what_is_near(spark, block, monkeypatch):
    """Random fingerprints, walks of small steps (chains) and one dense ball; small blocks cut the hot keys."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(block)
    fps = {rng.getrandbits(64) for _ in range(300)}
    for _ in range(30):
        x = rng.getrandbits(64)
        for _ in range(10):
            for b in rng.sample(range(64), rng.randint(1, 7)):
                x ^= 1 << b
            fps.add(x)
    centre = rng.getrandbits(64)
    fps |= {centre ^ sum(1 << b for b in rng.sample(range(64), 2)) for _ in range(400)}
    fps = sorted(fps)
    pairs = [(i, j) for i, j in itertools.combinations(range(len(fps)), 2) if (fps[i] ^ fps[j]).bit_count() <= 4]
    expected = groups_of(len(fps), pairs)
    frame = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    got = simhash.links(frame).collect()
    number = {signed(x): i for i, x in enumerate(fps)}
    assert all(((r["a"] ^ r["b"]) & (2 ** 64 - 1)).bit_count() <= 4 for r in got)
    assert groups_of(len(fps), [(number[r["a"]], number[r["b"]]) for r in got]) == expected
    assert len(got) < 40 * len(fps)  # links, not all pairs


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    names = rng.sample(range(10 ** 6), 700)
    edges = list(zip(names[:300], names[1:300])) + [(names[300], x) for x in names[301:500]] + [(names[i], names[rng.randrange(500, i)]) for i in range(501, 700)]
    number = {x: i for i, x in enumerate(sorted(names))}
    expected = groups_of(len(names), [(number[a], number[b]) for a, b in edges])
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert [number[got[x]] for x in sorted(got)] == [expected[number[x]] for x in sorted(got)]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_of_short_texts():
    import xxhash

    assert simhash.simhash(b"", 4) == simhash.simhash(b" \n", 4) == 0
    assert simhash.simhash(b"A b\tC", 4) == xxhash.xxh64_intdigest(b"a b c", 42)
    words = "a b c d e f".split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]).encode(), 42) for i in range(3)]
    assert simhash.simhash(b"a b c d e f", 4) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > 3)


@pytest.fixture(scope="module")
def model():
    import sentencepiece

    return sp.Encoder(sp.load_model(MODEL)), sentencepiece.SentencePieceProcessor(model_file=MODEL)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("theraninoséß\t\n  _0189(){}=."), st.characters(blacklist_categories=("Cs",), blacklist_characters="▁")), max_size=200))
def test_encoding_equals_the_library(model, text):
    ours, library = model
    ids, counts = ours.encode([text, "", text])
    assert ids[:counts[0]].tolist() == library.encode(text) and counts[1] == 0 and counts[2] == counts[0]
    assert ours.decode(ids, counts) == [text, "", text]


def test_encoding_of_long_words(model):
    ours, library = model
    rng = random.Random(5)
    texts = ["a" * 5000, " " * 777 + "x" + " " * 33, "".join(rng.choice("abcdefghinorst") for _ in range(20_000)), "é日" * 999]
    ids, counts = ours.encode(texts)
    ends = np.r_[0, np.cumsum(counts)]
    assert [ids[i:j].tolist() for i, j in zip(ends, ends[1:])] == library.encode(texts) and ours.decode(ids, counts) == texts


def test_encoding_of_the_documents_equals_the_library(spark, model):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(r["token_ids"] == model[1].encode(texts[r["doc_id"]]) and r["exact"] for r in sp.encoded(docs, MODEL).collect())


def test_unigram_scores_against_all_segmentations():
    rng = random.Random(9)
    pieces = ["▁", *"abc", "▁a", "ab", "bc", "abc", "▁ab", "ca", "cab"]
    scores = [round(-rng.uniform(1, 6), 3) for _ in pieces]
    byte = [f"<0x{b:02X}>" for b in range(256)]
    v = sp.vocabulary(byte + pieces, [0.0] * 256 + scores, ["byte"] * 256 + ["plain"] * len(pieces), bpe=False)
    ours, score = sp.Encoder(v), dict(zip(pieces, scores))

    def best(word):
        if not word:
            return 0.0, []
        return max(((score[word[:k]] + best(word[k:])[0], [word[:k], *best(word[k:])[1]]) for k in range(1, len(word) + 1) if word[:k] in score), default=(-1e9, []))

    for n in range(1, 7):
        for letters in itertools.product("abc", repeat=n):
            word = "".join(letters)
            assert [v.pieces[i] for i in ours.encode([word])[0]] == best("▁" + word)[1]
    assert [v.pieces[i] for i in ours.encode(["adb"])[0]] == ["▁a", "<0x64>", "b"]
    long = "".join(rng.choice("abc") for _ in range(300))
    groups = [ours.encode([long])[0].tolist(), sp.Encoder(v).viterbi(["▁" + long])[0].tolist()]
    assert abs(sum(score[v.pieces[i]] for i in groups[0]) - sum(score[v.pieces[i]] for i in groups[1])) < 1e-9


def test_unigram_with_characters_that_are_no_pieces():
    """A longer piece may end in a character that is no piece itself; short and long words agree with trying everything."""
    pieces, scores = ["▁", "a", "▁ab", "bc", "c", "xyz", "yx"], [-3.0, -2.0, -1.0, -4.0, -1.0, -2.5, -1.5]
    byte = [f"<0x{b:02X}>" for b in range(256)]
    v = sp.vocabulary(byte + pieces, [0.0] * 256 + scores, ["byte"] * 256 + ["plain"] * len(pieces), bpe=False)
    ours, score = sp.Encoder(v), dict(zip(pieces, scores))

    def best(word):
        if not word:
            return 0.0
        return max((score[word[:k]] if word[:k] in score else ours.unknown if k == 1 else -np.inf) + best(word[k:]) for k in range(1, len(word) + 1))

    def worth(parts):
        return sum(score[v.pieces[p]] if isinstance(p, int) and p >= 0 else ours.unknown for p in parts)

    assert [v.pieces[i] for i in ours.encode(["abc"])[0]] == ["▁ab", "c"]
    for n in range(1, 6):
        words = ["▁" + "".join(x) for x in itertools.product("abcxyz", repeat=n)]
        flat, counts, _ = ours.viterbi(words)
        ends = np.r_[0, np.cumsum(counts)]
        for word, i, j in zip(words, ends, ends[1:]):
            assert abs(worth(flat[i:j].tolist()) - best(word)) < 1e-9 and abs(worth(ours.viterbi_long(word)) - best(word)) < 1e-9


def rolled(data):
    h, out = 0, []
    for b in data:
        h = ((h << 1) + int(chunks.GEAR[b])) & 0xFFFFFFFF
        out.append(h)
    return out


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=2000))
def test_chunk_boundaries_against_the_rolling_hash(data):
    hashes, ends, start = rolled(data), [], 0
    while start < len(data):
        end = start
        while end < len(data):
            end += 1
            size = end - start
            mask = int(chunks.STRICT) if size < chunks.NORMAL else int(chunks.LOOSE)
            if size >= chunks.SMALLEST and hashes[end - 1] & mask == 0 or size == chunks.LARGEST:
                break
        ends.append(end)
        start = end
    assert chunks.boundaries(data) == ends


def test_moved_text_keeps_its_chunks():
    rng = random.Random(1)
    text = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(800))
    assert chunks.containment(chunks.chunk_set(text), chunks.chunk_set("Something new in front. " + text)) > 0.95
    assert chunks.containment(chunks.chunk_set(text), chunks.chunk_set(text[:2000] + "!" + text[2000:])) > 0.9
    assert chunks.containment(chunks.chunk_set(text), chunks.chunk_set(text[::-1])) < 0.05


@given(st.lists(st.sampled_from("abc"), max_size=60))
def test_repeated_words_against_a_plain_count(words):
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    assert repeated_words(words) == len(covered)


def test_sketch_buckets(spark):
    rows = spark.range(0, 100_000).select("id", bucket(F.col("id")).alias("b")).withColumn("low", least_of(F.col("b")))
    assert rows.where("low > id OR id - low > id / 16").count() == 0
    assert rows.groupBy("low").agg(F.countDistinct("b").alias("n")).where("n > 1").count() == 0
    assert rows.selectExpr("b >= lag(b) OVER (ORDER BY id) AS up").where("NOT up").count() == 0


def _encoders():
    import tiktoken

    ranks = tokens.load_ranks("/opt/tokenizers/byte_bpe_50k.tiktoken")
    return [tiktoken.Encoding("t", pat_str=p, mergeable_ranks=ranks, special_tokens={}).encode_ordinary for p in (tokens.PATTERN, r"(?s).+")]


_ENCODERS = _encoders()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([" ", "\n", "\t", "\u2003", "\x85", "\x1c", "\u200b", "a", "Zé", "12", "!?", "'s", "日本"]), max_size=40))
def test_runs_of_white_space_do_not_change_tokens(parts):
    encode, merge = _ENCODERS
    text = "".join(parts)
    assert all(tokens.encoded(text, encode, merge, least) == encode(text) for least in (2, 3, 1000))


def merged(data, ranks):
    """Byte pairs merged by rank, one by one."""
    parts = [bytes([b]) for b in data]
    while True:
        found = min(((ranks[x + y], i) for i, (x, y) in enumerate(zip(parts, parts[1:])) if x + y in ranks), default=None)
        if found is None:
            return [ranks[p] for p in parts]
        parts[found[1]:found[1] + 2] = [parts[found[1]] + parts[found[1] + 1]]


def test_very_long_runs_of_white_space(spark, docs_of):
    ranks = tokens.load_ranks("/opt/tokenizers/byte_bpe_50k.tiktoken")
    encode, merge = _ENCODERS
    mixed = "".join(random.Random(4).choice(" \n\t") for _ in range(700))
    assert tokens.encoded(mixed + " x", encode, merge, 100) == merged(mixed.encode(), ranks) + merged(b" x", ranks)
    million = 1_000_000
    texts = [" " * million, "\n" * million, " \n" * (million // 2), "a" + " " * million + "b", "a" + "\n" * million + "b"]
    got = {}
    for r in tokens.section_tokens(docs_of([(n, t, "en", "a") for n, t in enumerate(texts)]), "/opt/tokenizers/byte_bpe_50k.tiktoken").collect():
        n_tokens, n_chars = got.get(r["doc_id"], (0, 0))
        got[r["doc_id"]] = (n_tokens + r["n_tokens"], n_chars + r["n_chars"])
    assert [got[n][1] for n in range(5)] == list(map(len, texts))
    assert [got[n][0] for n in (0, 1, 2)] == [len(merge(t)) for t in texts[:3]]
    assert got[3][0] == 2 + len(merge(" " * (million - 1))) and got[4][0] == 3 + len(merge("\n" * (million - 1)))


def test_tokens_of_sections_against_offsets(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    tokenizer.encode_special_tokens = True
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(-1, "a\n\n\nb  \n \U0001F600é\n"), (-2, "x\n")], "doc_id long, text string")
    for rule in tokens.RULES:
        got = {}
        for r in tokens.section_tokens(docs.union(extra), "/opt/tokenizers/byte_bpe_50k.tiktoken", rule=rule).collect():
            got.setdefault(r["doc_id"], {})[r["section"]] = (r["start"], r["n_tokens"])
        for doc in docs.union(extra).collect():
            lines = doc["text"].splitlines(keepends=True) if "\r" not in doc["text"] else None
            lines = [x + "\n" for x in doc["text"].split("\n")[:-1]] + [doc["text"].split("\n")[-1]] * (not doc["text"].endswith("\n"))
            starts = list(itertools.accumulate(map(len, lines), initial=0))[:-1]
            section = [k for k, x in enumerate(lines) for _ in x]
            counts = [0] * len(lines)
            for i, j in tokenizer.encode(doc["text"], add_special_tokens=False).offsets:
                own = section[i:max(j, i + 1)]
                counts[own[0] if rule == "first" else max(sorted(set(own)), key=own.count)] += 1
            assert [got[doc["doc_id"]][k] for k in range(len(lines))] == list(zip(starts, counts))


def test_top_k_is_exact(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([rng.gauss(0, 5), 1.25, -3.0])) for i in range(500)]
    frame = spark.createDataFrame(rows, "key long, score double")
    for k in (0, 1, 37, 250, 499, 500, 600):
        got = {r["key"] for r in importance.top_k(frame, "score", "key", k).collect() if r["kept"]}
        assert got == {i for i, _ in sorted(rows, key=lambda r: (-r[1], r[0]))[:k]}


def test_classifier_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    scores = importance.resampled(docs, labels.where(~held), per_gram=50.0).withColumnRenamed("key", "doc_id").join(labels.where(held), "doc_id").collect()
    right = sum(r["kept"] == (r["quality"] == 1) for r in scores) / len(scores)
    assert len(scores) > 500 and right > 0.95


def test_samples_follow_the_weights(spark):
    """Over many salts, the first draw of Gumbel top-1 falls on each item in proportion to its exponential weight."""
    weights = np.array([0.0, 1.0, 2.0])
    hits = np.zeros(3)
    for salt in range(3000):
        even = np.random.default_rng(salt).random(3)
        hits[np.argmax(weights - np.log(-np.log(even)))] += 1
    assert np.allclose(hits / hits.sum(), np.exp(weights) / np.exp(weights).sum(), atol=0.03)


def spans_by_walking(text):
    """Base spans and linked ones with Python's re, all pairs compared."""
    found = []
    for kind, pattern, group, least in (
            ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
            ("access", r"AKIA[A-Z0-9]+", 0, 18), ("hex", r"[0-9a-f]+", 0, 16)):
        for m in re.finditer(pattern, text):
            if len(m[group]) >= least:
                found.append((m.start(), secrets.KINDS.index(kind), m.end()))
    base, parts = list(found), [(s, k, e) for s, k, e in found]
    for m in re.finditer(secrets.ASSIGN, text):
        if 4 <= len(m[1]) < 12:
            parts.append((m.start(), secrets.KINDS.index("weak"), m.end()))
    for kind, pattern in (("weak", secrets.WEAK), ("identifier", secrets.IDENTIFIER), ("endpoint", secrets.ENDPOINT)):
        parts += [(m.start(), secrets.KINDS.index(kind), m.end()) for m in re.finditer(pattern, text)]
    role = {0: "s", 1: "i", 2: "s", 3: "s", 4: "i", 5: "e"}
    linked = set()
    for s, k, e in parts:
        near = {role[q] for t, q, _ in parts if abs(s - t) <= secrets.SCOPE and role[q] != role[k]}
        if k >= 3 and (near >= {"i", "s"} if role[k] == "e" else ({"s": "i", "i": "s"}[role[k]] in near)):
            linked.add((s, k, e))
    return sorted(base), sorted(linked)


def test_secret_spans_against_a_walk(docs_of):
    rng = random.Random(8)
    bits = ["password = ", "token:", "Api_Key='", "secret", "SECRET=\"", "passwd: ", "AKIA", "QX77ZZ01", "deadbeef", "0123456789abcdef", "abc-d_e.f", "+/=",
            " user: bob", " login=amy", "pass: hunter2", "auth=zzzz9", "https://x.example.org/a?b=c", "redis://h:1", "\n", " ", "é\U0001F600", "word " * 30, ";"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    texts += ["token=" * 5000 + "x" * 12, "f" * 100_000, "user: a1b " * 3000 + "pass: abcd"]
    frame = docs_of([(i, t, "en", "a") for i, t in enumerate(texts)])
    for r in secrets.secret_spans(frame).collect():
        if len(texts[r["key"]]) < 25_000:  # the walk compares all pairs
            base, linked = spans_by_walking(texts[r["key"]])
            assert (sorted(map(tuple, r["base"])), sorted(map(tuple, r["linked"]))) == (base, linked), texts[r["key"]]


def test_audit_finds_exactly_the_damage(spark):
    rng = random.Random(4)
    a, offset = [], 0
    for i in range(3000):
        size = rng.choice([200, 5000, 300_000 if i % 500 == 0 else 900])
        a.append((i % 2, offset, size, f"d{i}"))
        offset += size
    b = list(a)
    b[7] = (*b[7][:3], "changed")
    b[1500] = (*b[1500][:2], 199, b[1500][3])
    lost = b.pop(2999)
    lost_first = b.pop(0)
    b.append((9, 0, 10, "new file"))
    schema = "file long, offset long, length long, digest string"
    got = warc.audit(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)).collect()
    assert {(r["file"], r["offset"]) for r in got} == {x[:2] for x in (a[7], a[1500], lost, lost_first, (9, 0))}
    assert len(got) == 5


def test_simhash_query_against_all_pairs(spark):
    """The whole of op8 on the small documents: fingerprints word by word, links by comparing all pairs."""
    import xxhash

    from logweir.llm import queries

    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    prints = []
    for _, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    pairs = [(i, j) for i, j in itertools.combinations(range(len(docs)), 2) if (prints[i] ^ prints[j]).bit_count() <= 4]
    label = groups_of(len(docs), pairs)
    lowest = {}
    for (key, _), root in zip(docs, label):
        lowest[root] = min(lowest.get(root, key), key)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op8_simhash_near_dedup(spark, SMALL).collect()}
    assert got == {key: (f"{fp:016x}", lowest[root]) for (key, _), fp, root in zip(docs, prints, label)} and len(set(lowest.values())) < len(docs)
