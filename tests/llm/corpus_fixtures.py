"""Frames with every awkward case, read from stored files as the operators ask for."""

from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest



PASSAGE = " ".join(f"alpha{i} beta{i % 7}" for i in range(40))
LONG = "\n".join(" ".join(f"w{i * j % 97}x" for j in range(20)) for i in range(800)) + "\n" + "y" * 30_000

# doc_id, text, lang, source; rows with the names of the operators' own columns are added as noise.
ROWS = [
    (5, PASSAGE + "\nThe end.", "en", "a"),
    (5, PASSAGE + "\nThe end.", "en", "a"),
    (3, "Short one.\n" + PASSAGE, "en", "b"),
    (None, PASSAGE + "\nNo key here.", None, None),
    (None, None, None, None),
    (8, None, "de", "a"),
    (9, "", "de", "a"),
    (10, " \t\n\n  ", "fr", None),
    (11, LONG, "fr", "b"),
    (12, "Größe 日本 \U0001F600 password = abcdefghijklmnop user: someone pass: tiny", "de", "c"),
    (13, "AKIA" + "Q" * 16 + " " + "0123456789abcdef" * 2 + " secret:short1", "en", "c"),
    (14, "one two three", "en", "c"),
    (15, "One two THREE", "en", "c"),
]
NOISE = ("n_words", "size", "key", "row", "row_number", "fp", "kept", "lines", "taken", "component_id", "gone_row", "mix_row", "again", "root", "bucket", "target", "stretch")


def write(folder: Path, rows) -> str:
    ids, texts, langs, sources = (list(c) for c in zip(*rows)) if rows else ([], [], [], [])
    columns = {"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string()), "lang": pa.array(langs, pa.string()),
               "source": pa.array(sources, pa.string()), "n_chars": pa.array([len(t or "") for t in texts], pa.int64())}
    columns |= {n: pa.array(["noise"] * len(rows), pa.string()) for n in NOISE}
    path = folder / "documents.parquet"
    pq.write_table(pa.table(columns), path)
    return str(path)


@pytest.fixture(scope="session")
def awkward(spark, tmp_path_factory):
    return spark.read.parquet(write(tmp_path_factory.mktemp("awkward"), ROWS))


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    return spark.read.parquet(write(tmp_path_factory.mktemp("empty"), []))


@pytest.fixture(scope="session")
def docs_of(spark, tmp_path_factory):
    """A stored frame of rows (doc_id, text, lang, source)."""
    return lambda rows: spark.read.parquet(write(tmp_path_factory.mktemp("docs"), rows))
