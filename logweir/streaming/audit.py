"""Status audit on a stream: illegal status changes, also when files arrive late or out of order.

State is bounded by the delay, not by the history. Events wait in the state of their (job, slot of time) until the
watermark has passed the slot's end: then all of them are there, are put in order once, and leave the state. A job's
slots end one after the other, so what goes on from slot to slot is the last status of each job, its only lasting state.
A job that owns a large share of all events is thus spread over its slots.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from logweir.operators.ledger import is_legal, without_time

# The processes that run the state's code may not have this library on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DELAY = "2 days"
SLOT = "1 hour"
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _LastStatus(StatefulProcessor):
    """The last status of a job: what was before the first event of each slot that is over. One row per slot, in and out."""

    def __init__(self, initial: str):
        self.initial, self.row = initial, Row("job_id", "before", "first", "changes")

    def init(self, handle) -> None:
        self.last = handle.getValueState("last", "status string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self.last.get()
        before = self.initial if known is None else known[0]
        for row in sorted(rows, key=lambda r: r["slot_end"]):
            yield self.row(key[0], before, row["first"], row["changes"])
            before = row["last_status"]
        self.last.update((before,))


def _ended_slots(events: DataFrame, order: list[str], delay: str, slot: str) -> DataFrame:
    """One row per job and slot that is over: its first event, its illegal changes and its last status.

    The events wait in the state of a grouping, put in order once they are all there, both in the JVM. NULL comes first, as in Spark's order.
    """
    at = order[0]
    timed = events.where(F.col(at).isNotNull()).select("job_id", F.coalesce("status", F.lit("null")).alias("status"), *order)
    held = F.sort_array(F.collect_list(F.struct(*order, "status"))).alias("held")
    ended = timed.withWatermark(at, delay).groupBy("job_id", F.window(at, slot)).agg(held)
    pairs = F.zip_with(F.slice("held", 1, F.size("held") - 1), F.slice("held", 2, F.size("held") - 1), lambda a, b: F.struct(
        *[b[c].alias(c) for c in order], a["status"].alias("from_status"), b["status"].alias("to_status")))
    return ended.select(
        "job_id", F.col("window.end").alias("slot_end"), F.get("held", F.lit(0)).alias("first"),
        F.element_at("held", -1)["status"].alias("last_status"),
        F.filter(pairs, lambda p: ~is_legal(p["from_status"], p["to_status"])).alias("changes"))


def illegal_changes(events: DataFrame, order: list[str], delay: str = DELAY, slot: str = SLOT, initial: str = "null") -> DataFrame:
    """(job_id, order columns, from_status, to_status) of a stream's illegal changes, each once, as soon as it is certain.

    ``events`` has job_id, status and the ``order`` columns, the first of which is a timestamp; a NULL status reads as
    ``null``. Events may come in any order within ``delay``; those of slots that ended before that are left out, and the
    stream's progress counts them. Events without a time are passed over.
    """
    ended = _ended_slots(events, order, delay, slot)
    kinds = {f.name: f.dataType for f in ended.schema}
    out = T.StructType([T.StructField("job_id", kinds["job_id"]), T.StructField("before", T.StringType()),
                        T.StructField("first", kinds["first"]), T.StructField("changes", kinds["changes"])])
    linked = ended.groupBy("job_id").transformWithState(_LastStatus(initial), out, "Append", "None")
    first = F.struct(*[F.col("first")[c].alias(c) for c in order], F.col("before").alias("from_status"), F.col("first.status").alias("to_status"))
    across = F.when(~is_legal(F.col("before"), F.col("first.status")), F.array(first))
    found = F.concat(F.coalesce(across, F.slice("changes", 1, 0)), "changes")
    return linked.select("job_id", F.inline(found))


def audit_stream(events: DataFrame, order: list[str], root: str, checkpoint: str, interval: str | None = None,
                 delay: str = DELAY, slot: str = SLOT) -> StreamingQuery:
    """Append the illegal changes of a stream to ``<root>/changes``; see ``illegal_changes``."""
    spark = events.sparkSession
    before = spark.conf.get(STORE)
    spark.conf.set(STORE, ROCKS)  # state that outgrows memory; a query keeps the store it was started with
    try:
        found = illegal_changes(events, order, delay, slot)
        writer = found.writeStream.outputMode("append").format("parquet").option("path", f"{root}/changes")
        writer = writer.option("checkpointLocation", checkpoint)
        return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()
    finally:
        spark.conf.set(STORE, before)


def untimed_stream(events: DataFrame, order: list[str], root: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Append the events without a time, which the audit passes over, to ``<root>/untimed``."""
    writer = without_time(events, order).writeStream.format("parquet").option("path", f"{root}/untimed").option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def audited(spark: SparkSession, root: str, schema: T.StructType, order: list[str]) -> DataFrame:
    """The illegal changes found so far; ``schema`` is that of the events."""
    kinds = {f.name: f.dataType for f in schema}
    columns = [("job_id", kinds["job_id"]), *[(c, kinds[c]) for c in order], ("from_status", T.StringType()), ("to_status", T.StringType())]
    return spark.read.schema(T.StructType([T.StructField(n, k) for n, k in columns])).parquet(f"{root}/changes")
