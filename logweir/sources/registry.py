"""Log formats by name: how to get from paths to parsed documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from logweir.sources.dump import parse_inserts
from logweir.sources.lines import parse_lines, read_lines

Reader = Callable[..., DataFrame]


def _json(spark: SparkSession, paths, day_pattern: str | None = None, spread: int | None = None) -> DataFrame:
    return parse_lines(read_lines(spark, paths, day_pattern, spread))


def _inserts(spark: SparkSession, paths, day_pattern: str | None = None, spread: int | None = None) -> DataFrame:
    return parse_inserts(read_lines(spark, paths, day_pattern, spread))


_READERS: dict[str, Reader] = {"json": _json, "mysql": _inserts}


def register(name: str, reader: Reader) -> None:
    """Add a format: ``reader(spark, paths, day_pattern=None)`` returning lines with ``value`` and ``doc``.

    A reader that deals lines of large files over tasks takes ``spread`` too.
    """
    _READERS[name] = reader


def read_documents(spark: SparkSession, fmt: str, paths, day_pattern: str | None = None, spread: int | None = None) -> DataFrame:
    if fmt not in _READERS:
        raise ValueError(f"unknown log format {fmt!r}; known: {', '.join(sorted(_READERS))}")
    return _READERS[fmt](spark, paths, day_pattern, **({} if spread is None else {"spread": spread}))
