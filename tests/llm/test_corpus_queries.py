"""Each corpus query against its SQL; the pipeline against a plain version."""

import re

import duckdb
import pytest

import corpus_pipeline
from compare import database, difference
from conftest import SMALL
from corpus_fixtures import awkward, docs_of, empty  # noqa: F401
from logweir.llm import oracle, queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_against_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SMALL), database(SMALL), queries.ORACLE[name]) is None


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def plain_pipeline(sf_dir: str) -> list[tuple]:
    import sentencepiece

    con = duckdb.connect()
    con.execute(f"CREATE TABLE documents AS SELECT * FROM '{sf_dir}/documents.parquet'")

    def keep(sql: str) -> None:
        con.execute(f"CREATE TABLE kept AS {sql}")
        con.execute("DROP TABLE documents")
        con.execute("ALTER TABLE kept RENAME TO documents")

    keep(f"SELECT d.* FROM documents d JOIN ({oracle.OP2}) q USING (doc_id) WHERE q.kept")
    keep(f"SELECT d.doc_id, c.text, d.lang, d.source, length(c.text) AS n_chars FROM documents d JOIN ({oracle.OP6}) c USING (doc_id) "
         f"WHERE c.n_deleted = 0 OR regexp_matches(c.text, '{oracle.WORD}')")
    rows = con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()
    words = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) for _, t in rows]
    sets = [{tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in words]
    group = list(range(len(rows)))
    for i, mine in enumerate(sets):  # all pairs
        for j in range(i):
            if 100 * len(mine & sets[j]) >= 80 * len(mine | sets[j]):
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    con.execute("CREATE TABLE first AS SELECT unnest(?) AS doc_id", [[rows[g][0] for g in set(group)]])
    keep("SELECT * FROM documents SEMI JOIN first USING (doc_id)")
    keep(f"SELECT d.* FROM documents d JOIN ({oracle.OP7}) m USING (doc_id), range(2) AS t(k) WHERE m.taken > 0 AND t.k * m.size < m.taken")
    model = sentencepiece.SentencePieceProcessor(model_file=f"{corpus_pipeline.TOKENIZERS}/piece_bpe_32k.model")
    return sorted((d, lang, source, tuple(model.encode(t))) for d, t, lang, source in con.execute("SELECT doc_id, text, lang, source FROM documents").fetchall())


def test_pipeline_against_a_plain_version(spark):
    found = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted((r["doc_id"], r["lang"], r["source"], tuple(r["token_ids"])) for r in found) == plain_pipeline(SMALL)
    assert all(r["exact"] and r["n_tokens"] == len(r["token_ids"]) for r in found)


def test_stages_take_awkward_and_empty_tables(spark, awkward, empty, tmp_path):
    for docs in (awkward, empty):
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            made = stage(spark, docs, "")
            if name != "sentencepiece":
                assert made.columns == docs.columns
            made.write.parquet(folder := f"{tmp_path}/{id(docs)}-{k}")
            assert spark.read.parquet(folder).count() <= 2 * docs.count()
        # And one after the other.
        step = docs
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, step, "").write.parquet(folder := f"{tmp_path}/{id(docs)}-chain-{k}")
            step = spark.read.parquet(folder)
