"""Checks of extracted values: texts wider than their columns, times out of range."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.operators.extract import MAX_EPOCH_SECONDS, extract_tables
from logweir.plans.spec import SchemaSpec, TableSpec
from logweir.sources.psv import truncate_text


def truncation_report(rows: DataFrame, table: TableSpec, name: str) -> DataFrame:
    """(table_name, column_name, n_too_long) for the text columns wider than their ``char(n)``, in one pass."""
    checked = [c for c in table.columns if c.char_width is not None and not c.is_noop]
    if not checked:
        return rows.sparkSession.createDataFrame([], "table_name string, column_name string, n_too_long bigint")
    counts = rows.agg(*[
        F.count_if(F.length(F.col(f"`{c.out_name}`").cast("string")) > c.char_width).alias(f"c{i}")
        for i, c in enumerate(checked)
    ])
    pairs = F.array(*[
        F.struct(F.lit(c.out_name).alias("column_name"), F.col(f"c{i}").alias("n_too_long"))
        for i, c in enumerate(checked)
    ])
    return counts.select(F.lit(name).alias("table_name"), F.inline(pairs)).where("n_too_long > 0")


def truncate_columns(rows: DataFrame, table: TableSpec, unit: str = "characters") -> DataFrame:
    """Text cut to the width of its column, by characters or by UTF-8 bytes."""
    cut = {
        c.out_name: truncate_text(F.col(f"`{c.out_name}`"), c.char_width, unit)
        for c in table.columns
        if c.char_width is not None and isinstance(c.data_type, T.StringType)
    }
    return rows.withColumns(cut) if cut else rows


def over_limit(rows: DataFrame, table: TableSpec, name: str, limit: int) -> DataFrame:
    """(table_name, column_name, n_too_long) for JSON columns with texts longer than ``limit``, in rows extracted without one."""
    wide = replace(table, columns=tuple(replace(c, sql_attr=f"varchar({limit})") for c in table.columns if c.is_json))
    return truncation_report(rows, wide, name)


def times_out_of_range(docs: DataFrame, spec: SchemaSpec) -> DataFrame:
    """(table_name, column_name, n_out_of_range) for timestamps beyond the year 9999, which extraction leaves NULL."""
    plain = {
        name: replace(t, sortkey_attr=(), columns=tuple(
            replace(c, sql_attr="int8") for c in t.columns if isinstance(c.data_type, T.TimestampType) and not (c.is_noop or c.is_derived)))
        for name, t in spec.tables.items()
    }
    plain = {n: t for n, t in plain.items() if t.columns}
    found = docs.sparkSession.createDataFrame([], "table_name string, column_name string, n_out_of_range bigint")
    for name, rows in extract_tables(docs, SchemaSpec(plain)).items():
        kinds = {c.out_name: c for c in spec.tables[name].columns}
        counts = [F.struct(F.lit(c.out_name).alias("column_name"), F.count_if(
            F.abs(F.col(f"`{c.out_name}`")) > MAX_EPOCH_SECONDS * (1 if kinds[c.out_name].scales_epoch_seconds else 1000)).alias("n_out_of_range"))
            for c in plain[name].columns]
        found = found.unionByName(rows.agg(F.array(*counts).alias("counts")).select(F.lit(name).alias("table_name"), F.inline("counts")))
    return found.where("n_out_of_range > 0")
