"""The error table: lines that are no document, and documents that lack a mandatory key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.operators.extract import is_incomplete, missing_keys
from logweir.plans.spec import SchemaSpec
from logweir.sources.lines import document, is_document

# Also the reason of a document that is larger than Spark's JSON parser takes, which the parser doesn't tell apart.
BAD_LINE = "line is not one JSON document that can be parsed"
MISSING_KEY = "required key missing"


def error_fields(docs: DataFrame, spec: SchemaSpec) -> list[Column]:
    """The six values of an error row, in table order. ``starttime`` is the wall clock of the run."""
    doc = document(F.col("doc"))
    missing = [
        F.when(predicate, F.lit(f"{name}: {what}"))
        for name, table in spec.tables.items()
        for what, predicate in missing_keys(table, doc)
    ]
    bad_line = ~is_document(F.col("doc"))
    detail = F.when(bad_line, F.lit(BAD_LINE))
    if missing:
        detail = detail.otherwise(F.concat_ws("; ", *missing))
    return [
        F.current_timestamp(),
        F.col("file_path") if "file_path" in docs.columns else F.lit(None).cast("string"),
        F.lit(None).cast("bigint"),
        F.when(bad_line, F.lit(BAD_LINE)).otherwise(F.lit(MISSING_KEY)),
        detail,
        F.col("value"),
    ]


def error_rows(docs: DataFrame, spec: SchemaSpec) -> DataFrame:
    """The rejected lines as rows of the error table."""
    rejected = ~is_document(F.col("doc")) | is_incomplete(spec, document(F.col("doc")))
    names = ("starttime", "filename", "line_number", "error_reason", "error_detail", "raw_line")
    carried = [F.col(c) for c in ("data_date",) if c in docs.columns]
    return docs.where(rejected).select(*[c.alias(n) for c, n in zip(error_fields(docs, spec), names)], *carried)
