"""A third of all rows under one key, number, source or content: same results, spread over tasks."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from corpus_fixtures import awkward, docs_of, empty  # noqa: F401
from logweir.llm import common, importance, mixing, warc


def test_copies_are_numbered(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, 1, 1, 1, 2]), rng.choice(["x", None]), n) for n in range(500)]
    frame = spark.createDataFrame(rows, "k int, t string, row long").repartition(7)
    got = common.copies_numbered(frame, ["k", "t"], "row", salts=5).collect()
    found = {}
    for r in got:
        found.setdefault((r["k"], r["t"]), []).append(r["nth"])
    assert {k: sorted(v) for k, v in found.items()} == {k: list(range(n)) for k, n in Counter((k, t) for k, t, _ in rows).items()}
    assert sorted(r["row"] for r in got) == list(range(500))


def test_records_of_a_hot_file_are_laid_out(spark, tmp_path):
    rng = random.Random(2)
    rows = [(None, hashlib.sha256(str(rng.randrange(90)).encode()).hexdigest(), 0, "n") for _ in range(120)]
    rows += [(7, hashlib.sha256(b"same").hexdigest(), 13, "s") for _ in range(120)]
    rows += [(n, hashlib.sha256(str(n).encode()).hexdigest(), n % 50, "o") for n in rng.sample(range(5000), 120)]
    rows = [(n, d, len(d) + s, w) for n, d, s, w in rows] + [(8, hashlib.sha256(b"none").hexdigest(), None, "x")]
    schema = "page_id long, digest string, length long, prefix string"
    spark.createDataFrame(rows, schema).repartition(5).write.parquet(folder := f"{tmp_path}/records")
    got = warc.laid_out(spark.read.parquet(folder), "page_id", "length")
    assert got.columns == ["page_id", "digest", "length", "prefix", "file", "offset"]
    expected, at = [], Counter()
    for n, d, s, w in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2] or 0)):
        file = -1 if n is None else n // 1000
        expected.append((n, d, s, w, file, at[file]))
        at[file] += s or 0
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)


def test_audit_plans_do_not_grow_with_the_tree(spark, tmp_path):
    """Each level reads stored nodes: a file of many levels has no larger plan than one of two."""
    def plan(size: int) -> str:
        made = spark.range(300).select(F.lit(0).cast("long").alias("file"), (F.col("id") * size).alias("offset"), F.lit(size).cast("long").alias("length"),
                                       F.sha2(F.col("id").cast("string"), 256).alias("digest"))
        records = common.stored(made, "records")
        other = common.stored(made.withColumn("digest", F.when(F.col("id") != 200, F.col("digest"))) if "id" in made.columns else
                              made.withColumn("digest", F.when(F.col("offset") != 200 * size, F.col("digest"))), "records")
        found = warc.audit(records, other)
        assert [(r["offset"], r["second_digest"]) for r in found.collect()] == [(200 * size, None)]
        return found._jdf.queryExecution().analyzed().toString()

    assert plan(1 << 11).count("Relation") == plan(1 << 21).count("Relation") <= 4


def test_many_equal_documents_are_mixed(spark, docs_of):
    rng = random.Random(3)
    words = lambda n: " ".join(f"w{k}" for k in range(n))
    rows = [(5, words(9), "en", "hot")] * 200 + [(None, None, "en", "hot")] * 50 + [(None, words(4), "en", "hot")] * 100
    rows += [(n, words(rng.randrange(40)), "en", rng.choice(["hot", "b", None])) for n in range(250)]
    got = mixing.mix(docs_of(rows)).collect()
    targets = {r["source"]: r["target"] for r in got}

    def draw(key, text):
        inner = hashlib.md5((text or "").encode()).hexdigest()
        return int(hashlib.md5(f"{'' if key is None else key}|{inner}".encode()).hexdigest()[:15], 16)

    expected = []
    for source, target in targets.items():
        mine = sorted(((draw(k, t), k is not None, k or 0, len((t or "").split()), k) for k, t, _, s in rows if s == source))
        total, budget = sum(r[3] for r in mine), int(target + 0.5)
        rounds = budget // total if total else 0
        left = budget - rounds * total
        for _, _, _, size, key in mine:
            expected.append((source, key, size, rounds * size + max(0, min(size, left))))
            left -= size
    assert sorted(((r["source"], r["key"], r["size"], r["taken"]) for r in got), key=str) == sorted(expected, key=str)
    assert len({tuple(r["row"]) for r in got}) == len(rows)


# --- importance resampling


def plain_buckets(text, buckets):
    hashes = [xxhash.xxh3_64_intdigest(w) for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())]
    bits = buckets.bit_length() - 1
    mask, pair = (1 << 64) - 1, int(importance.PAIR)
    return [h >> (64 - bits) for h in hashes] + [((((a * pair) & mask) ^ b) * pair & mask) >> (64 - bits) for a, b in zip(hashes, hashes[1:])]


@pytest.mark.parametrize("per_gram", [None, 50.0])
def test_models_and_weights_against_plain_counts(spark, docs_of, per_gram):
    rng = random.Random(4)
    rows = [(n, " ".join(rng.choices(["good", "words", "Here", "and", "bad", "ones"], weights=[5, 4, 3, 2, 1, 1] if n % 2 else [1, 1, 2, 3, 5, 5], k=rng.randrange(0, 30))), "en", "a")
            for n in range(60)] + [(None, "good bad", "en", "a"), (99, None, "en", "a"), (1, "good bad", "en", "a")]
    labels = spark.createDataFrame([(n, n % 2) for n in range(40)] + [(None, 1)], "doc_id long, quality int")
    buckets = importance.buckets_for(sum(len((t or "").encode()) for _, t, _, _ in rows))
    raw, target = Counter(), Counter()
    for key, text, _, _ in rows:
        raw.update(plain_buckets(text, buckets))
        if key is not None and key < 40 and key % 2:
            target.update(plain_buckets(text, buckets))

    def ratio(b):
        return np.log((target[b] + 1) / (target.total() + buckets)) - np.log((raw[b] + 1) / (raw.total() + buckets))

    expected = []
    for key, text, _, _ in rows:
        found = plain_buckets(text, buckets)
        total = sum(map(ratio, found))
        expected.append((str(key), round(total if per_gram is None else per_gram * total / len(found) if found else 0.0, 9)))
    got = importance.resampled(docs_of(rows), labels, per_gram=per_gram).collect()
    assert sorted((str(r["key"]), round(r["log_weight"], 9)) for r in got) == sorted(expected)


def test_models_grow_with_the_corpus():
    sizes = [importance.buckets_for(n) for n in (0, 10**6, 10**8, 5 * 10**8, 3 * 10**10, 10**14)]
    assert sizes == sorted(sizes) and sizes[0] == 1 << 16 < sizes[2] < sizes[4] <= sizes[5] and all(n & (n - 1) == 0 for n in sizes)


def test_equal_rows_have_noise_of_their_own_and_are_drawn_by_weight(spark, docs_of):
    """Rows without a key, and copies; over several draws, kept shares follow the weights."""
    rows = [(None, "plain words here", "en", "a")] * 150 + [(k % 50, "good words here", "en", "a") for k in range(150)]
    docs = docs_of(rows)
    labels = spark.createDataFrame([(n, 1) for n in range(50)] + [(n, 0) for n in range(1000, 1200)], "doc_id long, quality int")
    kept = Counter()
    for salt in range(8):
        got = importance.resampled(docs, labels, share=0.2, salt=salt, per_gram=0.7).collect()
        assert len({r["sample_key"] for r in got}) == 300 and sum(r["kept"] for r in got) == 60
        kept.update(r["key"] is None for r in got if r["kept"])
        weights = {r["key"] is None: r["log_weight"] for r in got}
    # Drawing 60 of 300 without replacement, one after the other.
    odds, left = np.exp(weights[True] - weights[False]), [150.0, 150.0]
    for _ in range(60):
        of_plain = left[0] * odds / (left[0] * odds + left[1])
        left = [left[0] - of_plain, left[1] - (1 - of_plain)]
    assert abs(kept[True] / 8 - (150 - left[0])) < 6 and 0.05 < odds < 0.9
