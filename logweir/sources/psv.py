"""Delimited text with backslash escapes: one row per line, read and written.

Line feed, carriage return, backslash and the delimiter are escaped inside values, so a record never spans
lines and a real delimiter is never preceded by an odd run of backslashes. NULL and the empty string are both
written as an empty field.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.plans.spec import ColumnSpec, TableSpec

# --- fixed values -----------------------------------------------------------------------------------
DELIMITERS = ("|", "\x1e")
# ----------------------------------------------------------------------------------------------------


def check_delimiter(delimiter: str) -> str:
    if delimiter not in DELIMITERS:
        raise ValueError(f"the delimiter is a bar or a record separator, not {delimiter!r}")
    return delimiter


def escape_text(text: Column, delimiter: str = "|") -> Column:
    """Backslash first, so that the escapes added after it stay single."""
    for plain, escaped in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), (delimiter, "\\" + delimiter)):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def unescape_text(text: Column, delimiter: str = "|") -> Column:
    """Inverse of ``escape_text``; text without a backslash is passed through."""
    back = F.lit("\\")

    def undo(piece: Column) -> Column:
        for escaped, plain in (("\\n", "\n"), ("\\r", "\r"), ("\\" + delimiter, delimiter)):
            piece = F.replace(piece, F.lit(escaped), F.lit(plain))
        return piece

    pieces = F.split(text, re.escape("\\\\"), -1)
    return F.when(F.instr(text, "\\") == 0, text).otherwise(F.array_join(F.transform(pieces, undo), "\\"))


def field_text(value: Column, data_type: T.DataType, delimiter: str = "|") -> Column:
    """One value as a field; NULL is empty."""
    if isinstance(data_type, T.StringType):
        text = escape_text(value, delimiter)
    elif isinstance(data_type, T.TimestampType):
        text = F.unix_millis(value).cast("string")
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit(""))


def psv_line(columns: list[tuple[Column, T.DataType]], delimiter: str = "|") -> Column:
    """The values, in order, as one line."""
    return F.concat_ws(delimiter, *[field_text(c, t, delimiter) for c, t in columns])


def to_psv(rows: DataFrame, order: list[str] | None = None, delimiter: str = "|") -> DataFrame:
    """Rows as lines in column ``value``; without an order the columns are sorted by name.

    Naming a column that the rows do not have is an error.
    """
    check_delimiter(delimiter)
    types = {f.name: f.dataType for f in rows.schema.fields}
    names = order if order else sorted(types)
    lost = [n for n in names if n not in types]
    if lost:
        raise KeyError(f"no such column: {', '.join(lost)}")
    return rows.select(psv_line([(F.col(f"`{n}`"), types[n]) for n in names], delimiter).alias("value"))


def split_fields(line: Column, delimiter: str = "|") -> Column:
    """The still escaped fields of a line.

    A line without backslashes is split directly. Otherwise the pattern takes whole runs with possessive
    quantifiers, so it needs no backtracking and no deep recursion on long fields.
    """
    bar = re.escape(delimiter)
    inner = "|" if delimiter == "|" else delimiter
    pattern = rf"([^\\{inner}]*+(?:\\.[^\\{inner}]*+)*+){bar}"
    careful = F.regexp_extract_all(F.concat(line, F.lit(delimiter)), F.lit(pattern), F.lit(1))
    return F.when(F.instr(line, "\\") == 0, F.split(line, bar, -1)).otherwise(careful)


def _cut(text: Column, column: ColumnSpec, unit: str | None) -> Column:
    return truncate_text(text, column.char_width, unit) if unit and column.char_width else text


def truncate_text(text: Column, width: int, unit: str = "characters") -> Column:
    """At most ``width`` characters, or at most ``width`` bytes of UTF-8 without splitting a character."""
    if unit == "characters":
        return F.left(text, F.lit(width))
    if unit != "bytes":
        raise ValueError(f"unit must be 'characters' or 'bytes', not {unit!r}")
    raw = F.encode(text, "UTF-8")
    cuts = [F.try_validate_utf8(F.substring(raw, 1, width - k).cast("string")) for k in range(min(width, 3) + 1)]
    return F.when(F.octet_length(text) <= width, text).otherwise(F.coalesce(*cuts))


def from_psv(lines: DataFrame, table: TableSpec, delimiter: str = "|", value: str = "value",
             truncate: str | None = None, strict: bool = True) -> DataFrame:
    """Typed rows from lines in spec order (noop columns are not in the file and come back NULL).

    A field that does not fit its type becomes NULL. Text is kept whole; with ``truncate`` ("characters" or "bytes") what is
    wider than ``char(n)`` is cut to n of these. With ``strict`` a
    line with the wrong number of fields stops the job; otherwise missing fields are NULL.
    """
    check_delimiter(delimiter)
    present = [c for c in table.columns if not c.is_noop]
    keep = [F.col(c) for c in ("data_date",) if c in lines.columns]
    fields = split_fields(F.col(value), delimiter)
    if strict:
        stop = F.raise_error(F.lit(f"expected {len(present)} fields")).cast("array<string>")
        fields = F.when(F.size(fields) == len(present), fields).otherwise(stop)
    # the one-element explode keeps the split from being repeated per column
    rows = lines.select(*keep, F.explode(F.array(fields)).alias("_fields"))
    out = []
    for c in table.columns:
        if c.is_noop:
            out.append(F.lit(None).cast(c.data_type).alias(c.out_name))
            continue
        raw = F.get(F.col("_fields"), F.lit(present.index(c)))
        raw = F.when(raw != F.lit("\x00"), raw)  # a lone NUL character is NULL
        if isinstance(c.data_type, T.StringType):
            typed = _cut(unescape_text(raw, delimiter), c, truncate)
        elif isinstance(c.data_type, T.TimestampType):
            typed = F.timestamp_millis(raw.try_cast("bigint"))
        else:
            typed = raw.try_cast(c.data_type)
        out.append(typed.alias(c.out_name))
    return rows.select(*out, *keep)
