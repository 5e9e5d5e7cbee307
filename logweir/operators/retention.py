"""Retention by age, compaction and statistics of stored tables."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.operators.day_tables import DayTable, FolderTable
from logweir.operators.evolve import BATCH, DAY
from logweir.operators.zones import Zone, in_days, measure, retention_column
from logweir.plans.spec import TableSpec


def cutoff(rows: DataFrame, column: str, ttl_days: int) -> DataFrame:
    """One row (min_day, max_day, cutoff_day); the cutoff is NULL when nothing is old enough to go."""
    span = rows.agg(F.to_date(F.min(column)).alias("min_day"), F.to_date(F.max(column)).alias("max_day"))
    due = F.datediff("max_day", "min_day") > ttl_days
    return span.withColumn("cutoff_day", F.when(due, F.date_sub("max_day", ttl_days)))


def keep_recent(rows: DataFrame, column: str, ttl_days: int) -> DataFrame:
    """The rows that retention keeps: from the cutoff midnight on, and those without a date.

    The cutoff is a scalar subquery (a two-value aggregate); where nothing is due it lies before all data, so
    that the filter stays a plain comparison the scan can use.
    """
    due = F.coalesce(F.col("cutoff_day"), F.lit("0001-01-01").cast("date")).cast("timestamp")
    limit = cutoff(rows, column, ttl_days).select(due).scalar()
    return rows.where(F.col(column).isNull() | (F.col(column).cast("timestamp") >= limit))


def day_zones(stored: DayTable) -> dict[date | None, Zone]:
    """The zone of every stored day; only days without one are scanned, in one column."""
    column = retention_column(stored.table)
    found = stored.zones()
    unknown = [day for day, zone in found.items() if zone is None]
    measured = measure(stored.rows().where(in_days(unknown)), column) if unknown else {}
    return {**{day: zone for day, zone in found.items() if zone is not None}, **measured}


def cutoff_of(days: dict[date | None, Zone], ttl_days: int) -> date | None:
    """The first day to keep, or None when nothing is old enough to go."""
    first = min((z.first for z in days.values() if z.first), default=None)
    last = max((z.last for z in days.values() if z.last), default=None)
    return last - timedelta(days=ttl_days) if first and (last - first).days > ttl_days else None


def recent_rows(stored: DayTable, ttl_days: int) -> DataFrame:
    """``keep_recent`` of a stored table: days that hold nothing to keep are not read."""
    column = retention_column(stored.table)
    limit = None
    if column is not None and stored.by_day():
        days = day_zones(stored)
        limit = cutoff_of(days, ttl_days)
    if limit is None:
        return stored.rows()
    keep = [day for day, z in days.items() if z.undated or z.last is None or z.last >= limit]
    return stored.rows().where(in_days(keep) & (F.col(column).isNull() | (F.col(column).cast("timestamp") >= F.lit(limit).cast("timestamp"))))


def delete_old_rows(stored: DayTable, ttl_days: int | None) -> int:
    """Delete old rows of a table stored by day; returns how many.

    The zones tell which days hold old rows and which hold nothing else: those are dropped unread, only days that hold
    both are read and rewritten, and the rest is not touched. Rows are read by the spec, so a rewritten day has all of
    its columns.
    """
    column = retention_column(stored.table)
    if column is None or ttl_days is None or not stored.by_day():
        return 0
    days = day_zones(stored)
    limit = cutoff_of(days, ttl_days)
    if limit is None:
        return 0
    old = [day for day, z in days.items() if z.first and z.first < limit]
    whole = [day for day in old if not days[day].undated and days[day].last < limit]
    mixed = [day for day in old if day not in whole]
    n_old = sum(days[day].rows for day in whole)
    if mixed:
        is_old = F.col(column).cast("timestamp") < F.lit(limit).cast("timestamp")
        rows = stored.rows().where(in_days(mixed))
        n_old += rows.where(is_old).count()
        stored.replace(rows.where(F.coalesce(~is_old, F.lit(True))), mixed)
    stored.drop(whole)
    return n_old


def delete_old(spark: SparkSession, folder: str, table: TableSpec, ttl_days: int | None) -> int:
    """``delete_old_rows`` of a table in a folder."""
    return delete_old_rows(FolderTable(spark, folder.rsplit("/", 1)[-1], folder, table), ttl_days)


def compact_days(stored: DayTable, days: list | None = None) -> None:
    """Rewrite days (default: all) into files of the session's advisory size, in the table's layout.

    Rows are read by the spec: files of older versions get the columns added since, with their defaults. The
    batches that a stream wrote become one; its source must not replay them any more.
    """
    rows = stored.rows()
    if days is not None:
        rows = rows.where(in_days(days))
    if BATCH in rows.columns:
        rows = rows.withColumn(BATCH, F.lit(-1).cast("long"))
    if not stored.table.distkeys:
        rows = rows.hint("rebalance", DAY)
    stored.replace(rows)


def compact(spark: SparkSession, folder: str, table: TableSpec, days: list | None = None) -> None:
    """``compact_days`` of a table in a folder."""
    compact_days(FolderTable(spark, folder.rsplit("/", 1)[-1], folder, table), days)


def analyze(spark: SparkSession, names: list[str]) -> None:
    """Refresh the statistics of every catalog table; failures are counted and raised at the end."""
    failed = []
    for name in names:
        try:
            spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")
        except Exception:
            failed.append(name)
    if failed:
        raise RuntimeError(f"no statistics for {len(failed)} tables: {', '.join(failed)}")
