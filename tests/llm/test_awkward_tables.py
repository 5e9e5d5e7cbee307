"""Every operator on NULLs, empty and very long texts, ties, repeated rows, clashing column names and an empty table."""

import hashlib

import pytest
from pyspark.sql import functions as F

from corpus_fixtures import LONG, ROWS, awkward, docs_of, empty  # noqa: F401
from logweir.llm import chunks, importance, lines, mixing, quality_rules, secrets, sentencepiece, simhash, tokens, warc

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def by_key(rows, name="key"):
    found = {}
    for r in rows:
        found.setdefault(r[name], []).append(r)
    return found


def test_sentencepiece(awkward, empty):
    got = by_key(sentencepiece.encoded(awkward, MODEL).collect(), "doc_id")
    assert sum(map(len, got.values())) == len(ROWS) and all(r["exact"] for rs in got.values() for r in rs)
    assert got[8][0]["token_ids"] == [] and got[9][0]["n_tokens"] == 0 and got[5][0] == got[5][1]
    back = {r["doc_id"]: r["text"] for r in sentencepiece.decoded(sentencepiece.encoded(awkward, MODEL), MODEL).collect()}
    assert back[11] == LONG and back[12] == ROWS[9][1] and back[8] == ""
    assert sentencepiece.encoded(empty, MODEL).count() == 0


def test_quality_rules(awkward, empty):
    got = by_key(quality_rules.judged(awkward).collect())
    assert sum(map(len, got.values())) == len(ROWS)
    assert got[8][0]["base_failed"] and got[8][0]["n_words"] == 0 and not got[9][0]["kept"] and got[14][0]["n_words"] == 3
    assert got[11][0]["n_words"] == 16001 and len(got[None]) == 2
    assert quality_rules.judged(empty).count() == 0
    assert quality_rules.kept_documents(awkward).columns == awkward.columns


def test_importance_resampling(spark, awkward, empty):
    labels = spark.createDataFrame([(5, 1), (3, 1), (12, 0), (None, 1), (5, 1)], "doc_id long, quality int")
    rows = importance.resampled(awkward, labels).collect()
    assert len(rows) == len(ROWS) and sum(r["kept"] for r in rows) == round(0.8 * len(ROWS))
    assert {r["log_weight"] for r in rows if r["key"] in (8, 9, 10)} == {0.0}
    nothing = labels.limit(0)
    assert all(r["kept"] for r in importance.resampled(awkward, nothing).collect())
    assert importance.resampled(empty, labels).count() == 0


def test_chunk_fingerprints(awkward, empty):
    rows = chunks.edited_and_next(awkward).collect()
    order = sorted(range(len(ROWS)), key=lambda k: (ROWS[k][0] is None, -(ROWS[k][0] or 0), k))
    texts = [ROWS[k][1] or "" for k in order]
    expected = []
    for k, text in enumerate(texts):
        after, cut = texts[(k + 1) % len(texts)], len(text) // 3
        edited = text[:len(text) - cut] + after[:cut]
        sets = [chunks.chunk_set(x) for x in (text, edited, after)]
        expected.append((ROWS[order[k]][0], len(text), hashlib.sha256(edited.encode()).hexdigest(), chunks.written(sets[0]), chunks.written(sets[1]),
                         chunks.containment(sets[0], sets[1]), chunks.containment(sets[0], sets[2])))
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, expected))
    assert chunks.edited_and_next(empty).count() == 0
    single = chunks.edited_and_next(awkward.where("doc_id = 14")).first()
    assert single["near_next"] == 1.0
    assert by_key(chunks.fingerprints(awkward).collect(), "doc_id")[8][0]["fingerprint"] == ""


def test_line_dedup(awkward, empty):
    cut, total, deleted = lines.dedup_lines(awkward)
    got = by_key(cut.collect(), "doc_id")
    assert cut.columns == [*awkward.columns, total, deleted] and sum(map(len, got.values())) == len(ROWS)
    assert got[3][0]["text"] == ROWS[2][1]  # the smallest key has the passage first
    assert sorted(r["text"] for r in got[5]) == ["", "The end."] and "No key here." in [r["text"] for r in got[None]]
    assert got[8][0]["text"] is None and got[8][0][total] == 0 and got[9][0][total] == 1
    assert got[11][0][deleted] > 0  # every 97th line repeats
    assert lines.dedup_lines(empty)[0].count() == 0


def test_mixing(awkward, empty):
    rows = mixing.mix(awkward).collect()
    got = by_key(rows)
    assert len(rows) == len(ROWS) and got[8][0]["taken"] == got[8][0]["size"] == 0
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    for source in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == source]
        assert sum(r["taken"] for r in own) == int(own[0]["target"] + 0.5) and sum(r["size"] for r in own) == own[0]["source_size"]
    assert abs(sum({r["source"]: r["target"] for r in rows}.values()) - 1.5 * sum(r["size"] for r in rows)) < 1
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(awkward).collect()))
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(awkward).columns == awkward.columns


def test_simhash(awkward, empty):
    got = by_key(simhash.near_duplicates(awkward).collect())
    assert sum(map(len, got.values())) == len(ROWS)
    assert got[8][0]["fp"] == got[9][0]["fp"] == got[10][0]["fp"] == 0 and {got[k][0]["component_id"] for k in (8, 9, 10)} == {8}
    assert got[14][0]["fp"] == got[15][0]["fp"] and got[15][0]["component_id"] == 14
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.without_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(5) <= 1 and 14 in ids and 15 not in ids and 8 in ids and 9 not in ids


@pytest.mark.parametrize("rule", tokens.RULES)
def test_section_tokens(awkward, empty, rule):
    got = by_key(tokens.section_tokens(awkward, RANKS, rule=rule).collect(), "doc_id")
    assert [tuple(r)[1:] for r in got[8]] == [(0, 0, 0, 0, 0)] and len(got[11]) == LONG.count("\n") + 1
    assert sum(r["n_chars"] for r in got[11]) == len(LONG) and len(got[5]) == 4
    assert tokens.section_tokens(empty, RANKS).count() == 0


def test_secret_scan(awkward, empty):
    rows = secrets.secret_spans(awkward).select("key", secrets.listed(F.col("base")).alias("base"), secrets.listed(F.col("linked")).alias("linked")).collect()
    got = by_key(rows)
    assert len(rows) == len(ROWS) and got[8][0]["base"] == "" and got[11][0]["base"] == ""
    assert got[12][0]["base"] == "assign:11:38"
    assert got[12][0]["linked"] == "identifier:39:52,weak:53:63"
    assert got[13][0]["base"] == "access:0:20,hex:21:53" and got[13][0]["linked"] == "weak:54:67"
    assert secrets.secret_spans(empty).count() == 0


def test_warc(spark):
    pages = spark.createDataFrame([(1, "u", "<p>é</p>"), (2, None, None), (None, "v", ""), (2, None, None), (3, "w", "x" * 200_000)], "page_id long, url string, html string")
    made = pages.select("page_id", warc.record(pages["url"], pages["page_id"], pages["html"]).alias("data"))
    data = {r["page_id"]: bytes(r["data"]) for r in made.collect()}
    assert data[1].startswith(b"WARC/1.0\r\n") and b"Content-Length: 9\r\n\r\n<p>\xc3\xa9</p>\r\n\r\n" in data[1] and b"Content-Length: 0" in data[2]
    laid = warc.laid_out(made.select("page_id", F.sha2("data", 256).alias("digest"), F.octet_length("data").alias("length")), "page_id", "length")
    assert warc.audit(laid, laid).count() == 0
    assert warc.audit(laid, laid.limit(0)).count() == 5 and warc.audit(laid.limit(0), laid.limit(0)).count() == 0
