"""Text and path helpers as column functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------------------------
MESSAGE_LIMIT = 256
IDENTITY_LIMIT = 256
# ----------------------------------------------------------------------------------------------------


def storage_bucket(path: Column) -> Column:
    """``b`` of ``s3://b/key``; NULL when the path is not of that kind."""
    return F.nullif(F.regexp_extract(path, r"^s3://([^/]*)/", 1), F.lit(""))


def storage_key(path: Column) -> Column:
    """``key`` of ``s3://b/key``; NULL when the path is not of that kind."""
    return F.when(path.rlike(r"^s3://[^/]*/"), F.regexp_extract(path, r"^s3://[^/]*/(.*)$", 1))


def last_segment(path: Column) -> Column:
    """The last non-empty step of a path, e.g. the log name of a log's folder."""
    return F.try_element_at(F.filter(F.split(path, "/"), lambda part: part != ""), F.lit(-1))


def log_name_of_path(path: Column) -> Column:
    return last_segment(storage_key(path))


def column_name_of_key(key: Column) -> Column:
    """Strip leading dots, then dots to underscores."""
    return F.replace(F.regexp_replace(key, r"^\.+", ""), F.lit("."), F.lit("_"))


def short_message(text: Column) -> Column:
    return F.left(text, F.lit(MESSAGE_LIMIT))


def checked_identity(text: Column) -> Column:
    """A spec identity that fits the ledger; a longer one stops the job."""
    stop = F.raise_error(F.lit("spec identity does not fit the ledger")).cast("string")
    return F.when(F.length(text) <= IDENTITY_LIMIT, text).otherwise(stop)


def job_key(cluster: Column, log_name: Column, version: Column, start: Column, end: Column) -> Column:
    """The key of a job; an open end reads ``None``."""
    parts = [cluster, log_name, version, start, F.coalesce(end, F.lit("None"))]
    return F.concat_ws(":", *[p.cast("string") for p in parts])


def checked_arguments(text: Column) -> Column:
    """Trimmed JSON text, ``{}`` for blank; anything else that is no JSON stops the job."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+|\s+$", "")
    stop = F.raise_error(F.lit("additional arguments are no JSON")).cast("string")
    wrapped = F.try_parse_json(F.concat(F.lit("["), trimmed, F.lit(",0]")))
    whole = F.coalesce(F.try_variant_get(wrapped, "$[1]", "int") == 0, F.lit(False))
    return F.when(trimmed == "", F.lit("{}")).when(whole, trimmed).otherwise(stop)


def is_plain_name(text: Column) -> Column:
    """Letters, digits and underscores only."""
    return text.rlike(r"^\w+$")


def search(rows: DataFrame, **wanted) -> DataFrame:
    """Rows whose columns contain the wanted texts, ignoring case: AND over columns, OR over a column's list."""
    for name, texts in wanted.items():
        texts = [texts] if isinstance(texts, str) else list(texts or [])
        if not texts:
            continue
        hit = F.lit(False)
        for text in texts:
            hit = hit | F.contains(F.lower(F.col(name).cast("string")), F.lit(text.lower()))
        rows = rows.where(hit)
    return rows
