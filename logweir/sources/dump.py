"""SQL dumps: one complete single-row ``INSERT INTO t (cols) VALUES (...)`` per line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.sources.lines import END_MARK

# A quoted text (with backslash or doubled quotes inside) or a bare word such as NULL or 12.5; possessive, so
# long texts cost no recursion.
VALUE = r"('(?:[^'\\]++|\\.|'')*+'|[^\s,()']++)"
STATEMENT = r"^\s*INSERT INTO\s+`?([^`\s(]+)`?\s*\(([^)]*)\)\s*VALUES\s*\((.*)\)\s*;?\s*$"
# Escapes of a quoted text that stand for another character; any other escaped character is itself.
ESCAPES = {"n": "\n", "r": "\r", "t": "\t", "0": "\x00", "Z": "\x1a", "b": "\b"}


def _unquoted(token):
    """The text of a quoted token, the bare token otherwise, NULL for the word NULL."""
    inner = F.substring(token, F.lit(2), F.length(token) - 2)
    pieces = F.split(F.replace(inner, F.lit("''"), F.lit("'")), r"\\\\", -1)

    def undo(piece):
        for letter, plain in ESCAPES.items():
            piece = F.replace(piece, F.lit("\\" + letter), F.lit(plain))
        return F.replace(piece, F.lit("\\"), F.lit(""))

    text = F.when(F.instr(inner, "\\") == 0, F.replace(inner, F.lit("''"), F.lit("'"))).otherwise(
        F.array_join(F.transform(pieces, undo), "\\")
    )
    return F.when(token.startswith("'"), text).when(F.upper(token) != "NULL", token)


def parse_inserts(lines: DataFrame, value: str = "value") -> DataFrame:
    """Add ``table_name`` and ``doc``: the row as a parsed document, ready for ``extract_tables``.

    Values are kept as text; the spec's column types decide what they become. A line that is no INSERT has no
    document and goes to quarantine.
    """
    line = F.col(value)
    pattern = "(?is)" + STATEMENT
    names = F.transform(
        F.split(F.regexp_extract(line, pattern, 2), ","), lambda n: F.trim(F.replace(n, F.lit("`"), F.lit("")))
    )
    tokens = F.regexp_extract_all(F.regexp_extract(line, pattern, 3), F.lit(VALUE), F.lit(1))
    shaped = lines.select(
        "*",
        F.regexp_extract(line, pattern, 1).alias("table_name"),
        F.explode(F.array(F.struct(names.alias("names"), tokens.alias("tokens")))).alias("_insert"),
    )
    row = F.map_from_arrays(F.col("_insert.names"), F.transform(F.col("_insert.tokens"), _unquoted))
    # A repeated column name makes the row ambiguous: quarantined like any other line that is no row.
    whole = (F.col("table_name") != "") & (F.size("_insert.names") == F.size("_insert.tokens")) & (
        F.size(F.array_distinct("_insert.names")) == F.size("_insert.names"))
    marked = F.array(F.to_variant_object(row), F.lit(END_MARK).cast("bigint").cast("variant"))
    return shaped.select(
        *[c for c in shaped.columns if c != "_insert"],
        F.when(whole, F.to_variant_object(marked)).alias("doc"),
    )
