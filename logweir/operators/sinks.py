"""Writing extracted tables: delimited text for all tables in one pass, and partitioned Parquet."""

from __future__ import annotations

import time
import uuid
from dataclasses import replace
from datetime import date

from pyspark.errors import AnalysisException, SparkRuntimeException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.operators.evolve import BATCH, DAY, reconcile, remember
from logweir.operators.extract import REJECTED, DeriveFunction, extract_tables, tagged_rows
from logweir.operators.quarantine import error_fields, error_rows
from logweir.operators.zones import day_folder, write_zones
from logweir.plans.spec import ERROR_TABLE, SchemaSpec, SpecError, TableSpec, error_table
from logweir.session import fresh_folder
from logweir.sources import files
from logweir.sources.psv import check_delimiter, psv_line

TABLE = "table"
INCOMING, READY, MOVED = "_incoming-", "_ready", "_moved"  # Spark passes over names that start with an underscore
GRACE_SECONDS = 2 * 24 * 3600


def data_error(stopped: Exception) -> str:
    """The text of an error that bad data, an unreadable file or a bad spec has raised.

    Anything else, a lost cluster or a full disk, is raised again and stops the run.
    """
    text = str(stopped)
    if isinstance(stopped, (SpecError, AnalysisException, SparkRuntimeException)) or "[FAILED_READ_FILE" in text:
        return text
    raise stopped


def psv_fan_out(docs: DataFrame, spec: SchemaSpec, delimiter: str = "|",
                metrics: dict[str, DeriveFunction] | None = None) -> DataFrame:
    """All rows of all tables as (``table``, ``line``), in one pass over the documents.

    Bad and incomplete documents become lines of the error table.
    """
    check_delimiter(delimiter)
    rows, columns_of = tagged_rows(docs, spec, metrics)
    tag = F.col("_tag")
    error_types = [c.data_type for c in error_table().columns]
    name = F.lit(ERROR_TABLE)
    line = psv_line(list(zip(error_fields(docs, spec), error_types)), delimiter)
    for n, (table_name, table) in enumerate(spec.tables.items()):
        pairs = [(v, c.data_type) for c, v in zip(table.columns, columns_of(n)) if not c.is_noop]
        name = F.when(tag == n, F.lit(table_name)).otherwise(name)
        line = F.when(tag == n, psv_line(pairs, delimiter)).otherwise(line)
    carried = [F.col(DAY)] if DAY in docs.columns else []
    return rows.select(*carried, name.alias("table"), line.alias("line"))


def write_psv(fanned: DataFrame, folder: str, compression: str = "gzip", level: str = "BEST_SPEED") -> None:
    """One directory per table (below one per day when the frame has days), overwriting only those days.

    ``level``: of gzip, by Hadoop's name. The files are read once or twice, so the default packs fast, not small.
    """
    days = [DAY] if DAY in fanned.columns else []
    (fanned.write.mode("overwrite").option("compression", compression).option("zlib.compress.level", level)
        .option("partitionOverwriteMode", "dynamic").partitionBy(*days, "table").text(folder))


def laid_out(rows: DataFrame, table: TableSpec, partitions: list[str]) -> DataFrame:
    """Rows gathered by day and dist key, and sorted by the sort keys inside each partition.

    Without a dist key nothing is shuffled. ``rebalance`` lets adaptive execution split a hot key over several
    tasks and merge small ones, which a plain ``repartition`` on the key would not.
    """
    if table.distkeys:
        rows = rows.hint("rebalance", *partitions, *table.distkeys)
    order = [*partitions, *table.sortkey_attr]
    return rows.sortWithinPartitions(*order) if order else rows


def write_table(rows: DataFrame, folder: str, table: TableSpec | None = None, days: list[date | None] | None = None) -> None:
    """Parquet below ``folder``; a table with dist or sort keys is laid out by them.

    With a day column, exactly the days of ``rows`` and those in ``days`` are replaced: a day in ``days`` for which there
    are no rows has none afterwards. Rows are written beside the table first, then whole day directories change
    places, so ``rows`` may come from ``folder`` itself. If that is stopped before all rows are written, the table is as
    it was; if later, ``finish_swaps`` completes it. Without a day column the whole table is replaced.
    """
    spark = rows.sparkSession
    partitions = [c for c in (DAY, BATCH) if c in rows.columns]
    if table is not None and (table.distkeys or table.sortkey_attr):
        rows = laid_out(rows, table, partitions)
    if DAY not in partitions:
        rows.write.mode("overwrite").parquet(folder)
        return
    incoming = f"{folder}/{INCOMING}{uuid.uuid4().hex}"
    rows.write.partitionBy(*partitions).parquet(incoming)
    if partitions == [DAY]:
        write_zones(spark, incoming, table)
    made = [path.rsplit("/", 1)[1] for path in files.glob(spark, f"{incoming}/{DAY}=*")]
    files.write_whole(spark, f"{incoming}/{READY}", "\n".join(sorted({*made, *map(day_folder, days or [])})))
    _swap(spark, folder, incoming)


def _swap(spark: SparkSession, folder: str, incoming: str) -> None:
    """Put the listed days of ``incoming`` in place of those of ``folder``; may be repeated after a stop at any point."""
    listed = files.read_text(spark, f"{incoming}/{READY}").split()
    made = {path.rsplit("/", 1)[1] for path in files.glob(spark, f"{incoming}/{DAY}=*")}
    done = {path.rsplit("/", 1)[1] for path in files.glob(spark, f"{incoming}/{MOVED}/{DAY}=*")}
    for name in listed:
        if name in made:
            files.remove(spark, f"{folder}/{name}")
            files.touch(spark, f"{incoming}/{MOVED}/{name}")
            files.rename(spark, f"{incoming}/{name}", f"{folder}/{name}")
        elif name not in done:
            files.remove(spark, f"{folder}/{name}")
    files.remove(spark, f"{incoming}/{READY}")  # first: without the list nothing is swapped again
    files.remove(spark, incoming)


def finish_swaps(spark: SparkSession, folder: str, grace_seconds: float = GRACE_SECONDS) -> None:
    """Complete the day swaps that a stopped load has left; what was not all written goes after a time of grace."""
    for incoming in files.glob(spark, f"{folder}/{INCOMING}*"):
        if files.exists(spark, f"{incoming}/{READY}"):
            _swap(spark, folder, incoming)
        elif files.modified(spark, incoming) < time.time() - grace_seconds:
            files.remove(spark, incoming)


def typed_fan_out(docs: DataFrame, spec: SchemaSpec, metrics: dict[str, DeriveFunction] | None = None) -> DataFrame:
    """All rows of all tables in one pass: ``table``, and per table a struct column that is set in its rows.

    Rejected documents become rows of the error table.
    """
    rows, columns_of = tagged_rows(docs, spec, metrics)
    tag, name, structs = F.col("_tag"), F.lit(ERROR_TABLE), []
    for n, (table_name, table) in enumerate(spec.tables.items()):
        name = F.when(tag == n, F.lit(table_name)).otherwise(name)
        values = F.struct(*[v.alias(c.out_name) for c, v in zip(table.columns, columns_of(n))])
        structs.append(F.when(tag == n, values).alias(table_name))
    error = F.struct(*[v.alias(c.out_name) for c, v in zip(error_table().columns, error_fields(docs, spec))])
    carried = [F.col(DAY)] if DAY in docs.columns else []
    return rows.select(*carried, name.alias(TABLE), *structs, F.when(tag == REJECTED, error).alias(ERROR_TABLE))


def write_stage(docs: DataFrame, spec: SchemaSpec, folder: str, metrics: dict[str, DeriveFunction] | None = None) -> None:
    """The rows of all tables, parsed once, one directory per table (and day below it when there are days)."""
    fanned = typed_fan_out(docs, spec, metrics)
    days = [DAY] if DAY in fanned.columns else []
    fanned.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(TABLE, *days).parquet(folder)


def staged_rows(spark: SparkSession, folder: str, name: str, table: TableSpec, with_days: bool) -> DataFrame:
    """One table of a stage, by the spec's schema; empty where it has no rows."""
    struct = T.StructType([T.StructField(c.out_name, c.data_type) for c in table.columns])
    schema = T.StructType([T.StructField(name, struct), *([T.StructField(DAY, T.DateType())] if with_days else [])])
    where = f"{folder}/{TABLE}={name}"
    rows = spark.read.schema(schema).parquet(where) if files.exists(spark, where) else spark.createDataFrame([], schema)
    return rows.select(F.col(f"`{name}`.*"), *([DAY] if with_days else []))


def staged_tables(docs: DataFrame, spec: SchemaSpec, metrics: dict[str, DeriveFunction] | None = None,
                  folder: str | None = None) -> dict[str, DataFrame]:
    """Parse once, write one typed stage, serve every table (and the error table) from it.

    The stage is a written table in the shared folder, so losing an executor does not mean parsing again.
    """
    spark = docs.sparkSession
    folder = folder or fresh_folder(spark, "stage")
    write_stage(docs, spec, folder, metrics)
    days = DAY in docs.columns
    return {n: staged_rows(spark, folder, n, t, days) for n, t in {**spec.tables, ERROR_TABLE: error_table()}.items()}


def stored_error_table() -> TableSpec:
    """The error table as it is stored: in the order of the documents, not sorted."""
    return replace(error_table(), sortkey_attr=())


def load_tables(docs: DataFrame, spec: SchemaSpec, root: str, metrics: dict[str, DeriveFunction] | None = None,
                stage: bool = True, days: list[date] | None = None) -> list[dict]:
    """Write every table and the error table below ``root``; one result per table, stopping at the first failure.

    Stored tables are reconciled with the spec first. The days of the rows and those in ``days`` are replaced exactly, in
    every table; documents without days replace whole tables. With ``stage`` the lines are parsed once into a stage, and
    a day with rows in any table is replaced in all of them; without it they are parsed once per table.
    """
    spark = docs.sparkSession
    folder = fresh_folder(spark, "stage") if stage else None
    if stage:
        frames = staged_tables(docs, spec, metrics, folder)
        if DAY in docs.columns:
            seen = {path.rsplit("=", 1)[1] for path in files.glob(spark, f"{folder}/{TABLE}=*/{DAY}=*")}
            days = [*(days or []), *(None if d.startswith("__") else date.fromisoformat(d) for d in sorted(seen))]
    else:
        frames = {**extract_tables(docs, spec, metrics), ERROR_TABLE: error_rows(docs, spec)}
    results = []
    for name, rows in frames.items():
        table = spec.tables.get(name) or stored_error_table()
        result = {"table_name": name, "status": "success", "error_info": None}
        try:
            reconcile(spark, name, f"{root}/{name}", table, remembering=False)
            finish_swaps(spark, f"{root}/{name}")
            write_table(rows, f"{root}/{name}", table, days)
            remember(spark, f"{root}/{name}", table)
        except Exception as failure:  # the step's outcome is data for the ledger
            result.update(status="error", error_info=data_error(failure))
        results.append(result)
        if result["status"] == "error":
            break
    if folder:
        files.remove(spark, folder)
    return results
