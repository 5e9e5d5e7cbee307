"""Day directories: which days exist, which are complete, and where each is read from.

A day lives in ``<prefix>/YYYY/MM/DD/`` and is complete when that directory holds a marker file. Listing the
markers is metadata work; everything after it is joins of small frames of (prefix, day).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.session import small_frame
from logweir.sources import files

# --- fixed values -----------------------------------------------------------------------------------
COMPLETE = "COMPLETE"
SUCCESS = "_SUCCESS"
INPUT_SUFFIX = "/part-*.gz"
# ----------------------------------------------------------------------------------------------------
DAY_IN_PATH = r"(\d{4})/(\d{2})/(\d{2})"


def _joined(*parts: Column) -> Column:
    """Parts joined by slashes; repeated slashes are collapsed except after a scheme."""
    return F.regexp_replace(F.concat_ws("/", *parts), r"(?<!:)/{2,}", "/")


def day_input(prefix: Column, day: Column, suffix: str = INPUT_SUFFIX) -> Column:
    """The glob of a day's input files."""
    return F.concat(_joined(prefix, F.date_format(day, "yyyy/MM/dd")), F.lit(suffix))


def marker_path(prefix: Column, day: Column, marker: str = COMPLETE) -> Column:
    return _joined(prefix, F.date_format(day, "yyyy/MM/dd"), F.lit(marker))


def list_markers(spark: SparkSession, prefixes: list[str], marker: str = COMPLETE, days: list[date] | None = None) -> DataFrame:
    """(prefix, day) for markers below the prefixes, of all days or of ``days``. Empty markers are fine, they are never read.

    The months of ``days`` are listed, not the whole history.
    """
    months = ["[0-9]*/[0-9]*"] if days is None else sorted({f"{d:%Y/%m}" for d in days})
    rows = []
    for prefix in prefixes:
        for month in months:
            for path in files.glob(spark, f"{prefix.rstrip('/')}/{month}/[0-9]*/{marker}"):
                rows.append((prefix, "/".join(path.split("/")[-4:-1])))
    found = small_frame(spark, rows, "prefix string, day_text string")
    return found.select("prefix", F.try_to_timestamp("day_text", F.lit("yyyy/MM/dd")).cast("date").alias("day"))


def complete_days(wanted: DataFrame, markers: DataFrame, force: bool = False) -> DataFrame:
    """The (prefix, day) rows of ``wanted`` that have a marker; ``force`` accepts all of them."""
    return wanted if force else wanted.join(markers, ["prefix", "day"], "left_semi")


def first_complete_prefix(days: DataFrame, prefixes: DataFrame, markers: DataFrame, force: bool = False) -> DataFrame:
    """Per day, the first prefix in priority order that is complete; NULL where none is.

    ``prefixes`` has (prefix, priority); ``days`` has (day).
    """
    if force:
        # every prefix counts as complete, so the first in the list serves every day
        first = prefixes.agg(F.min_by("prefix", "priority").alias("prefix"))
        return days.select("day", first.scalar().alias("prefix"))
    best = markers.join(prefixes, "prefix").groupBy("day").agg(F.min_by("prefix", "priority").alias("prefix"))
    return days.join(best, "day", "left").select("day", "prefix")


def require_prefix(chosen: DataFrame) -> DataFrame:
    """Stop the job when a day has no complete prefix."""
    stop = F.raise_error(F.concat(F.lit("no complete prefix for "), F.col("day").cast("string")))
    return chosen.withColumn("prefix", F.coalesce("prefix", stop.cast("string")))


def days_to_run(days: DataFrame, done: DataFrame, started: DataFrame | None = None) -> DataFrame:
    """Days whose output is neither finished (marker) nor already started (ledger)."""
    left = days.join(done.select("day").distinct(), "day", "left_anti")
    if started is not None:
        left = left.join(started.select("day").distinct(), "day", "left_anti")
    return left
