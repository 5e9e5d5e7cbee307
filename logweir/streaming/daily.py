"""Daily counts with a readiness rule: a day is final once data 48 hours younger than its end has been seen."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logweir.session import small_frame
from logweir.sources import files

DELAY = "48 hours"
DELAY_HOURS = 48
OPEN_SCHEMA = "day date, n_rows bigint, newest timestamp, final_before date"


def daily_counts(events: DataFrame, column: str = "ts", delay: str = DELAY) -> DataFrame:
    """(day, n_rows) per finished day of a stream; state is one counter per open day."""
    return (
        events.withWatermark(column, delay)
        .groupBy(F.window(column, "1 day").alias("_day"))
        .agg(F.count("*").alias("n_rows"))
        .select(F.to_date("_day.start").alias("day"), "n_rows")
    )


def write_final_days(counts: DataFrame, folder: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Append days to a Parquet folder as they become final."""
    writer = counts.writeStream.outputMode("append").format("parquet").option("path", folder)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def _state(spark: SparkSession, root: str, batch_id: int) -> tuple[dict[date, int], datetime | None, date | None]:
    """After a batch: rows per open day, the newest time seen, and the day before which all days are final."""
    folder = f"{root}/open/batch_id={batch_id}"
    rows = spark.read.schema(OPEN_SCHEMA).parquet(folder).collect() if files.exists(spark, folder) else []  # a row per open day
    head = rows[0] if rows else None
    return {r["day"]: r["n_rows"] for r in rows if r["day"]}, head and head["newest"], head and head["final_before"]


def count_days(events: DataFrame, root: str, checkpoint: str, column: str = "ts", delay_hours: int = DELAY_HOURS,
               interval: str | None = None) -> StreamingQuery:
    """Count a stream's rows per day, and lose none: each is in a final day, an open one, or among the late rows.

    A day is final once a time ``delay_hours`` after its end has been seen; its count goes to ``<root>/final``. Rows of a day
    that was final before their batch, and rows without a time, go whole to ``<root>/late``. ``<root>/open`` holds the open
    days as of each batch, all the state there is: it is read back by the next batch, so a replayed batch writes the
    same again. A batch is read once, and once more where it holds late rows.
    """
    def count(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        held, newest, final_before = _state(spark, root, batch_id - 1)
        found = batch.groupBy(F.to_date(column).alias("day")).agg(F.count("*").alias("n"), F.max(column).alias("newest")).collect()  # a row per day
        late = False
        for r in found:
            if r["day"] is None or (final_before and r["day"] < final_before):
                late = True
            else:
                held[r["day"]] = held.get(r["day"], 0) + r["n"]
        newest = max((x for x in [newest, *[r["newest"] for r in found]] if x), default=None)
        if newest:
            passed = (newest - timedelta(hours=delay_hours)).date()  # days that end by then are final
            final_before = max(passed, final_before or passed)
        final = [(day, n) for day, n in sorted(held.items()) if day < final_before] if final_before else []
        left = [(day, n, newest, final_before) for day, n in sorted(held.items()) if not (final_before and day < final_before)]
        if late:
            before = _state(spark, root, batch_id - 1)[2]
            day = F.to_date(column)
            rows = batch.where(day.isNull() | (day < F.lit(before)) if before else day.isNull())
            rows.write.mode("overwrite").parquet(f"{root}/late/batch_id={batch_id}")
        small_frame(spark, final, "day date, n_rows bigint").write.mode("overwrite").parquet(f"{root}/final/batch_id={batch_id}")
        small_frame(spark, left or [(None, 0, newest, final_before)], OPEN_SCHEMA).write.mode("overwrite").parquet(f"{root}/open/batch_id={batch_id}")
        files.remove(spark, f"{root}/open/batch_id={batch_id - 2}")

    writer = events.writeStream.foreachBatch(count).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def counted_days(spark: SparkSession, root: str, column: str = "ts") -> DataFrame:
    """(state, day, n_rows): final and open days, and late rows by day (NULL: without a time)."""
    newest = max((int(path.rsplit("=", 1)[1]) for path in files.glob(spark, f"{root}/open/batch_id=*")), default=-1)
    held, _, _ = _state(spark, root, newest)
    found = small_frame(spark, [("open", day, n) for day, n in sorted(held.items())], "state string, day date, n_rows bigint")
    if files.exists(spark, f"{root}/final"):
        final = spark.read.schema("day date, n_rows bigint").parquet(f"{root}/final")
        found = found.unionByName(final.select(F.lit("final").alias("state"), "day", "n_rows"))
    if files.exists(spark, f"{root}/late"):
        late = spark.read.parquet(f"{root}/late").groupBy(F.to_date(column).alias("day")).agg(F.count("*").alias("n_rows"))
        found = found.unionByName(late.select(F.lit("late").alias("state"), "day", "n_rows"))
    return found
