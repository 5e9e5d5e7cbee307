"""Lookups by equality without a scan of everything: Parquet files with Bloom filters on the columns looked up.

Events of a job lie in all files of a ledger, so the span of ids in a row group says nothing. A Bloom filter per row group
and column says for certain that an id is not there; the reader skips such groups by itself, for any filter by equality.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Values told apart per row group: twelve bits each for one false answer in a hundred. More only make false answers likelier.
EXPECTED_VALUES = 100_000


def write_indexed(rows: DataFrame, folder: str, keys: list[str], expected: dict[str, int] | None = None, mode: str = "append",
                  row_group_bytes: int | None = None) -> None:
    """Write rows so that ``find`` by any of ``keys`` skips the row groups without the value.

    ``expected``: per key, about how many values a row group holds (EXPECTED_VALUES for others); it sizes the filter.
    """
    missing = sorted(set(keys) - set(rows.columns))
    if missing:
        raise ValueError(f"no such columns: {', '.join(missing)}")
    writer = rows.write.mode(mode)
    for key in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{key}", str((expected or {}).get(key, EXPECTED_VALUES)))
        # A dictionary would answer by itself, and its columns get no filter.
        writer = writer.option(f"parquet.enable.dictionary#{key}", "false")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    writer.parquet(folder)


def equals(found: dict[str, object]) -> Column:
    """All columns have the values given; None stands for NULL, a list for any of its values."""
    def one(name: str, value) -> Column:
        column = F.col(f"`{name}`")
        if isinstance(value, (list, tuple, set)):
            return column.isin(*value)
        return column.isNull() if value is None else column == F.lit(value)

    return reduce(Column.__and__, [one(n, v) for n, v in found.items()], F.lit(True))


def find(spark: SparkSession, folder: str, schema, **values) -> DataFrame:
    """The rows below ``folder`` with these values; the filter goes to the scan."""
    return spark.read.schema(schema).parquet(folder).where(equals(values))
