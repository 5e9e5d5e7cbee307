"""Days picked up as they become complete: a stream of markers that starts extracting and loading."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logweir.operators.days import day_list, extract_days, load_frontier_days, record, stage_of
from logweir.plans.spec import SchemaSpec
from logweir.sources.days import COMPLETE, INPUT_SUFFIX, SUCCESS, list_markers

MARKER_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def marker_stream(spark: SparkSession, prefix: str, marker: str = COMPLETE) -> DataFrame:
    """A stream that has a batch whenever days below ``prefix`` have become complete; data files are not listed.

    Markers are empty and empty files have no rows, so the batches have none either.
    """
    return spark.readStream.format("binaryFile").schema(MARKER_SCHEMA).load(f"{prefix.rstrip('/')}/[0-9]*/[0-9]*/[0-9]*/{marker}")


def follow_days(spark: SparkSession, spec: SchemaSpec, prefixes: list[str], start: date, stage: str, root: str, checkpoint: str,
                interval: str | None = None, ledger: str | None = None, fmt: str = "json", suffix: str = INPUT_SUFFIX,
                **loading) -> StreamingQuery:
    """Extract days from ``start`` on as their markers appear in any of ``prefixes``, and load the frontier.

    Markers may come in any order. At each arrival the days that have a marker are compared with what this spec version
    has staged, and those left are extracted; then all that is staged and not yet loaded, by the ledger, is loaded up to
    the first gap. So a late marker closes its gap, and what waited behind it is loaded too. A replayed batch finds its
    days done. ``loading``: options of ``load_frontier_days``.
    """
    ledger = ledger or f"{root}/_ledger"
    arrivals = reduce(DataFrame.union, [marker_stream(spark, prefix) for prefix in prefixes])

    def known(session: SparkSession, folders: list[str], marker: str) -> set[date]:
        found = list_markers(session, folders, marker).where(F.col("day") >= F.lit(start))
        return {r["day"] for r in found.select("day").distinct().collect()}  # one row per day

    def run(batch: DataFrame, batch_id: int) -> None:
        session, own = batch.sparkSession, stage_of(stage, spec) + "/markers"
        new = known(session, prefixes, COMPLETE) - known(session, [own], SUCCESS)
        if new:
            extract_days(session, spec, prefixes, sorted(new), stage, fmt, suffix, note=lambda made: record(session, spec, ledger, made))
        staged = sorted(known(session, [own], SUCCESS))
        if staged:
            load_frontier_days(session, spec, day_list(start, staged[-1]), staged, stage, root, ledger, **loading)

    writer = arrivals.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()
