"""What the corpus operators share: words, free column names, tables stored in the shared folder, Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logweir.session import stored  # noqa: F401 - for the operators

# A word: a longest run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WORDS_OF_BYTES = re.compile(WORD.encode()).findall
WORDS_OF_TEXT = re.compile(WORD).findall

# Texts of about this many bytes are worked on at once, so that a Python worker's memory is bounded.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(frame: DataFrame, wish: str) -> str:
    """``wish``, with underscores added until no column of the frame has that name."""
    taken = {c.lower() for c in frame.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def _rows_of_files(docs: DataFrame) -> bool:
    """Whether each row is a row of a Parquet file under one path, and another row for each."""
    if "_metadata" in map(str.lower, docs.columns):
        return False
    node = docs._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().head()
    try:
        docs.select("_metadata.row_index")
        return node.nodeName() == "LogicalRelation" and node.relation().location().rootPaths().size() == 1
    except AnalysisException:
        return False


def with_row(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows numbered, and the number's column name: a struct (file, index) that belongs to the row.

    A row of a Parquet file has that file's hash and its own place there, in every scan, however the files are split.
    Any other frame is numbered once and stored; its rows are read from that table.
    """
    name = free_name(docs, "row_number")
    if _rows_of_files(docs):
        number = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("index"))
        return docs.select("*", number.alias(name)), name
    number = F.struct(F.lit(0).cast("long").alias("file"), F.monotonically_increasing_id().alias("index"))
    return stored(docs.withColumn(name, number), "numbered-rows"), name


def copies_numbered(rows: DataFrame, same: list[str], row: str, name: str = "nth", salts: int = 64) -> DataFrame:
    """The rows with a number ``name`` among those of equal ``same`` columns, from 0 and by salt, then ``row``.

    Rows are dealt by salts, so that a group that holds a large share of all rows is numbered by many tasks; NULLs are
    equal to each other.
    """
    salt, before = free_name(rows, "salt"), free_name(rows, "before")
    salted = rows.withColumn(salt, F.pmod(F.xxhash64(row), F.lit(salts)).cast("int"))
    held = salted.groupBy(*same, salt).agg(F.count("*").alias("held"))
    earlier = W.partitionBy(*same).orderBy(salt).rowsBetween(W.unboundedPreceding, -1)
    held = held.select(*[F.col(c).alias(f"of_{i}") for i, c in enumerate(same)], F.col(salt).alias("of_salt"),
                       F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias(before), F.col("held").alias("of_held"))
    first = salted.withColumn(name, F.row_number().over(W.partitionBy(*same, salt).orderBy(row)) - 1)
    on = [salted[salt] == held["of_salt"], *[salted[c].eqNullSafe(held[f"of_{i}"]) for i, c in enumerate(same)]]
    # Most rows have no copy and need no number from elsewhere.
    joined = first.join(held.where(F.col(before) > 0).drop("of_held"), on, "left")
    return joined.select(*rows.columns, (F.col(name) + F.coalesce(before, F.lit(0))).cast("long").alias(name))


def n_words(text: Column) -> Column:
    """Number of words of a text, 0 for NULL; long."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``most`` bytes of text, a longer text alone."""
    start = size = 0
    lengths = pc.binary_length(batch.column(text)).to_pylist()
    for i, n in enumerate(lengths):
        if size and size + (n or 0) > most:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n or 0
    if batch.num_rows > start:
        yield batch.slice(start)


def bytes_of(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8, NULL as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def texts_of(column: pa.Array) -> list[str]:
    """The texts, NULL as empty."""
    return [x or "" for x in column.to_pylist()]


def map_texts(frame: DataFrame, text: str, work: Callable[[pa.RecordBatch], dict], schema: str, most: int = SLICE_BYTES) -> DataFrame:
    """``work`` applied to parts of bounded size; it returns the new columns, and other columns pass through.

    ``schema``: the result's columns, those of ``frame`` that are kept included.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for batch in batches:
            for part in slices(batch, text, most):
                made = work(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made[f.name], f.type) if f.name in made and not isinstance(made[f.name], pa.Array)
                     else made[f.name] if f.name in made else part.column(f.name).cast(f.type) for f in arrow],
                    schema=arrow)

    return frame.mapInArrow(run, schema)
