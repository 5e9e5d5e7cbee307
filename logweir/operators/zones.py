"""Zone maps: per stored day, the span of the column that dates its rows, kept beside the rows.

A day's zone lies in the day's own folder and so is published, replaced and removed with it. It answers which days can
be old enough to go without reading any of them.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.operators.evolve import DAY
from logweir.plans.spec import TableSpec
from logweir.sources import files

ZONE_FILE = "_zone.json"  # Spark passes over names that start with an underscore


@dataclass(frozen=True)
class Zone:
    """The rows of a stored day: how many, how many without a date, and the first and last day of the others."""

    column: str
    rows: int
    undated: int
    first: date | None
    last: date | None


def retention_column(table: TableSpec) -> str | None:
    """The sort key that dates the rows: the timestamp one, else the date one; None if there is neither."""
    by_type = {
        kind: [c.out_name for c in table.columns if c.out_name in table.sortkey_attr and isinstance(c.data_type, kind)]
        for kind in (T.TimestampType, T.DateType)
    }
    found = by_type[T.TimestampType] or by_type[T.DateType]
    if len(found) > 1:
        raise ValueError("several sort keys could date the rows")
    return found[0] if found else None


def day_folder(day: date | None) -> str:
    """A day's partition directory."""
    return f"{DAY}={'__HIVE_DEFAULT_PARTITION__' if day is None else day.isoformat()}"


def day_of(path: str) -> date | None:
    """The day of a partition directory."""
    text = path.rstrip("/").rsplit("=", 1)[1]
    return None if text.startswith("__") else date.fromisoformat(text)


def in_days(days: list) -> Column:
    """The row's day is one of these; None stands for rows without a day."""
    known = [d for d in days if d is not None]
    return F.col(DAY).isin(known) | (F.col(DAY).isNull() if len(known) < len(days) else F.lit(False))


def measure(rows: DataFrame, column: str) -> dict[date | None, Zone]:
    """The zones of all days of ``rows``: one scan of one column, one row per day to the driver."""
    found = rows.groupBy(DAY).agg(
        F.count("*").alias("rows"), F.count_if(F.col(column).isNull()).alias("undated"),
        F.to_date(F.min(column)).alias("first"), F.to_date(F.max(column)).alias("last"))
    return {r[DAY]: Zone(column, r["rows"], r["undated"], r["first"], r["last"]) for r in found.collect()}


def write_zones(spark: SparkSession, folder: str, table: TableSpec | None) -> None:
    """Zones for the days just written below ``folder``; nothing where no column dates the rows."""
    column = retention_column(table) if table is not None else None
    if column is None:
        return
    kind = next(c.data_type for c in table.columns if c.out_name == column)
    rows = spark.read.schema(T.StructType([T.StructField(column, kind), T.StructField(DAY, T.DateType())])).parquet(folder)
    for day, zone in measure(rows, column).items():
        text = {k: v.isoformat() if isinstance(v, date) else v for k, v in asdict(zone).items()}
        files.write_text(spark, f"{folder}/{day_folder(day)}/{ZONE_FILE}", json.dumps(text))


def read_zone(spark: SparkSession, folder: str, column: str) -> Zone | None:
    """The zone of a day's folder, or None where none is kept for the column."""
    text = files.read_text(spark, f"{folder}/{ZONE_FILE}")
    held = None if text is None else json.loads(text)
    if held is None or held["column"] != column:
        return None
    first, last = (held[k] and date.fromisoformat(held[k]) for k in ("first", "last"))
    return Zone(column, held["rows"], held["undated"], first, last)
