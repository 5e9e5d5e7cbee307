"""File-stream ingest: each new file is routed to all tables and to the error table, by day where paths hold one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logweir.operators.evolve import BATCH, DAY, read_stored, reconcile
from logweir.operators.extract import DeriveFunction
from logweir.operators.sinks import laid_out, staged_rows, stored_error_table, write_stage
from logweir.plans.spec import ERROR_TABLE, SchemaSpec, error_table
from logweir.session import fresh_folder
from logweir.sources import files
from logweir.sources.lines import parse_lines, with_file_columns


def ingest_stream(spark: SparkSession, source: str, spec: SchemaSpec, root: str, checkpoint: str,
                  metrics: dict[str, DeriveFunction] | None = None, day_pattern: str | None = None,
                  max_files_per_batch: int | None = None, interval: str | None = None) -> StreamingQuery:
    """Start the ingest of text files below ``source``.

    With a ``day_pattern`` the tables are partitioned by day like those of a batch load, and below it by batch, in the spec's
    layout; retention and compaction work on them. Without an ``interval`` it takes what is there and stops.
    Batches can be replayed after a failure, so each one owns its ``batch_id`` partitions, which a replay overwrites. A
    batch is parsed once, into a stage in the shared folder from which all tables and the error table are written.
    """
    reader = spark.readStream.format("text").option("lineSep", "\n")
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    lines = with_file_columns(reader.load(source), day_pattern)
    tables = {**spec.tables, ERROR_TABLE: stored_error_table()}
    for name, table in tables.items():
        reconcile(spark, name, f"{root}/{name}", table)

    def store(batch: DataFrame, batch_id: int) -> None:
        docs = parse_lines(batch)
        with_days = DAY in docs.columns
        stage = fresh_folder(spark, "ingest")
        write_stage(docs, spec, stage, metrics)  # the one parse of the batch
        for name, table in tables.items():
            partitions = [DAY] * with_days + [BATCH]
            rows = staged_rows(spark, stage, name, spec.tables.get(name) or error_table(), with_days)
            rows = laid_out(rows.withColumn(BATCH, F.lit(batch_id).cast("long")), table, partitions)
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(f"{root}/{name}")
        files.remove(spark, stage)

    writer = lines.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def ingested(spark: SparkSession, root: str, spec: SchemaSpec, name: str) -> DataFrame:
    """A table that ``ingest_stream`` filled, as the spec sees it."""
    table = stored_error_table() if name == ERROR_TABLE else spec.tables[name]
    return read_stored(spark, f"{root}/{name}", table).drop(BATCH)


def ingested_errors(spark: SparkSession, root: str, spec: SchemaSpec) -> DataFrame:
    return ingested(spark, root, spec, ERROR_TABLE)
