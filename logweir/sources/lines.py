"""JSON lines: one document per text line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.plans.paths import Node

# A line is parsed as the first element of a two-element array that ends with this number. Spark's JSON
# parser stops at the end of the first value and would accept '{"a":1}{"b":2}' as its first document; inside
# the array such a line has no well-formed end, so it is recognised as bad.
END_MARK = 7741930562


def read_lines(spark: SparkSession, paths, day_pattern: str | None = None, spread: int | None = None) -> DataFrame:
    """Text lines with the file they came from, and the day when the path holds one.

    ``day_pattern`` is a regular expression with three groups, e.g. ``(\\d{4})/(\\d{2})/(\\d{2})``. A compressed file can't be
    split: its lines are read by one task, and parsed and written by that task too. With ``spread`` the raw lines are
    dealt over so many tasks first; it pays for few large files and costs a shuffle of the lines.
    """
    lines = with_file_columns(spark.read.option("lineSep", "\n").text(paths), day_pattern)
    return lines if spread is None else lines.repartition(spread)


def with_file_columns(lines: DataFrame, day_pattern: str | None = None) -> DataFrame:
    file_path = F.col("_metadata.file_path")
    columns = [F.col("value"), file_path.alias("file_path")]
    if day_pattern:
        parts = [F.regexp_extract(file_path, day_pattern, i) for i in (1, 2, 3)]
        columns.append(F.concat_ws("-", *parts).try_cast("date").alias("data_date"))
    return lines.select(*columns)


def parse_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Add ``doc``, the parsed line.

    The one-element explode keeps the parse in a single place of the plan: as a plain projection the
    optimizer would copy it into every filter on ``doc`` and parse each line twice.
    """
    text = F.concat(F.lit("["), F.col(value), F.lit(f",{END_MARK}]"))
    return lines.select("*", F.explode(F.array(F.try_parse_json(text))).alias("doc"))


def is_document(doc: Column) -> Column:
    """The line held exactly one JSON document."""
    return F.coalesce(F.try_variant_get(doc, "$[1]", "bigint") == F.lit(END_MARK), F.lit(False))


def document(doc: Column) -> Node:
    """The root of a parsed line."""
    return Node(doc, "$[0]")
