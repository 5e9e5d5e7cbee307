"""Questions about the loading history: current state, runs, how far each job got, what to do next.

The ledger is an append-only log of events. Everything here groups by job (and day), where a single job may
own a large share of the events, so state is reduced by mergeable aggregates (``max_by`` and the like, combined
before the shuffle). Windows run only over rows already reduced to one per job and day.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logweir.functions.dates import earlier, later, ready_day, retry_delay_seconds
from logweir.session import stored

# --- fixed values -----------------------------------------------------------------------------------
LEGAL_TRANSITIONS = {
    "null": ["scheduled"],
    "scheduled": ["null", "running"],
    "running": ["cancelled", "null", "running", "success", "error", "complete", "paused"],
    "success": ["scheduled"],
    "cancelled": ["null"],
    "complete": ["null"],
    "error": ["null"],
    "paused": ["null", "success"],
}
SCHEDULABLE = ("null", "success")
ACTIONS = ("cancel_requested", "pause_requested", "delete_requested")
JOB_DEFAULTS = {
    "delete_requested": 0, "cancel_requested": 0, "pause_requested": 0, "additional_arguments": "{}",
}
MAX_ERROR_RETRIES = 16
KEEPALIVE_SECONDS = 300
QUEUE_GRACE_SECONDS = 3600
# ----------------------------------------------------------------------------------------------------

SLOT_ROWS = 100_000  # events of a job that one task puts in order
CUTS = 64  # parts into which a larger slot is cut at once


# -- current state -----------------------------------------------------------------------------------

def latest_per_key(events: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest event per key: what an upsert by key would have left.

    An aggregate, not a ranking window: each task forwards at most one row per key.
    """
    rest = [c for c in events.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_newest")
    return events.groupBy(*keys).agg(newest).select(*keys, "_newest.*").select(*events.columns)


def with_defaults(rows: DataFrame, defaults: dict = JOB_DEFAULTS) -> DataFrame:
    """Missing values replaced by the record type's defaults, as readers see them."""
    return rows.withColumns({
        c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items() if c in rows.columns
    })


def only_known_fields(rows: DataFrame, known: list[str]) -> DataFrame:
    """The rows, or an error when they carry a field the record type does not have."""
    unknown = sorted(set(rows.columns) - set(known))
    if unknown:
        raise ValueError(f"unknown fields: {', '.join(unknown)}")
    return rows


def without_key(rows: DataFrame, column: str, value) -> DataFrame:
    """All rows but those of one key (NULL keys stay)."""
    return rows.where(~F.col(column).eqNullSafe(F.lit(value)))


# -- runs --------------------------------------------------------------------------------------------

def run_rows(steps: DataFrame) -> DataFrame:
    """One row per (job_id, data_date) from step events.

    ``steps`` has job_id, data_date, step ('et' or 'load'), result (NULL for a start), at, error_info. The
    status is ``<step>_started`` or ``<step>_<result>`` of the newest event; a step's runtime goes from the
    last start before its last finish to that finish (0 without a start); the error text is that of the
    last finish, NULL when it was a success.
    """
    keys = ["job_id", "data_date"]
    finished = F.col("result").isNotNull()
    status = F.concat_ws("_", "step", F.coalesce("result", F.lit("started")))
    # a finish sorts after a start of the same instant
    order = F.struct("at", finished.cast("int"), "step")
    error = F.when(F.col("result") != "success", F.coalesce("error_info", F.lit("None")))

    def when_is(step: str, condition: Column, value: Column) -> Column:
        return F.when((F.col("step") == step) & condition, value)

    aggregates = [
        F.max("at").alias("updated_at"),
        F.max_by(status, order).alias("etl_status"),
        F.max_by(F.struct(error.alias("text")), F.when(finished, order)).getField("text").alias("etl_error"),
    ]
    for step in ("et", "load"):
        aggregates += [
            F.max(when_is(step, ~finished, F.col("at"))).alias(f"{step}_starttime"),
            F.max(when_is(step, finished, F.col("at"))).alias(f"_{step}_finish"),
        ]
    runs = steps.groupBy(*keys).agg(*aggregates)
    # Only a step that was started again after its last finish needs a look at earlier starts.
    restarted = runs.where(
        (F.col("et_starttime") > F.col("_et_finish")) | (F.col("load_starttime") > F.col("_load_finish"))
    ).select(*keys, "_et_finish", "_load_finish")
    earlier = (
        steps.where(~finished).join(restarted, keys)
        .groupBy(*keys)
        .agg(*[
            F.max(when_is(s, F.col("at") <= F.col(f"_{s}_finish"), F.col("at"))).alias(f"_{s}_before")
            for s in ("et", "load")
        ])
    )
    joined = runs.join(earlier, keys, "left")

    def runtime(step: str) -> Column:
        start, finish = F.col(f"{step}_starttime"), F.col(f"_{step}_finish")
        begun = F.when(start <= finish, start).otherwise(F.col(f"_{step}_before"))
        seconds = (F.unix_micros(finish) - F.unix_micros(F.coalesce(begun, finish))) / F.lit(1e6)
        return seconds.alias(f"{step}_runtime")

    return joined.select(
        *keys, "etl_status", "updated_at", "et_starttime", runtime("et"), "load_starttime", runtime("load"), "etl_error"
    )


def per_day_status(results: DataFrame) -> DataFrame:
    """(job_id, day, bad): ``bad`` is the first record of the day that is no success, or NULL."""
    bad = F.col("status") != "success"
    record = F.struct("status", "error_info")
    return results.groupBy("job_id", "day").agg(F.min_by(record, F.when(bad, F.col("seq"))).alias("bad"))


def result_fold(results: DataFrame, end_dates: DataFrame | None = None) -> DataFrame:
    """(job_id, status, last_ok_day, error_info) per job from (job_id, day, seq, status, error_info).

    Days are walked in order up to the first record that is no success. ``error`` and ``unknown`` end in an
    error; any other status ends the walk as a success so far. When every day succeeded and the last one is
    the job's end date the job is complete. ``end_dates`` (job_id, end_date) also lists jobs without any
    result, which are errors.
    """
    days = per_day_status(results)
    ordered = W.partitionBy("job_id")
    first_bad = F.min(F.when(F.col("bad").isNotNull(), F.col("day"))).over(ordered)
    walked = days.withColumn("_stop", first_bad)
    folded = walked.groupBy("job_id").agg(
        F.max(F.when(F.col("_stop").isNull() | (F.col("day") < F.col("_stop")), F.col("day"))).alias("last_ok_day"),
        F.min_by("bad", F.when(F.col("day") == F.col("_stop"), F.col("day"))).alias("bad"),
        F.lit(True).alias("_any"),
    )
    if end_dates is None:
        folded = folded.withColumn("end_date", F.lit(None).cast("date"))
    else:
        folded = end_dates.join(folded, "job_id", "left")
    failed = F.col("bad.status").isin("error", "unknown")
    complete = F.col("bad").isNull() & (F.col("last_ok_day") == F.col("end_date"))
    status = (
        F.when(F.col("_any").isNull() | failed, F.lit("error"))
        .when(complete, F.lit("complete"))
        .otherwise(F.lit("success"))
    )
    return folded.select(
        "job_id", status.alias("status"), "last_ok_day", F.when(failed, F.col("bad.error_info")).alias("error_info")
    )


# -- how far may a job go ----------------------------------------------------------------------------

def extracted_days(status: DataFrame, table_versions: str) -> DataFrame:
    """The days of one spec version whose extract step is complete: the input of ``load_frontier``."""
    return status.where((F.col("et_status") == "complete") & (F.col("table_versions") == table_versions))


def load_frontier(status: DataFrame, start: Column, retry_errors: bool = False, single_day: bool = False) -> DataFrame:
    """The days each job can load now, walking from ``start`` to the first gap.

    ``status`` has job_id, day, load_status for days whose extract step is complete. A NULL status is a
    candidate; an error is one when retrying and ends the walk otherwise; any other status is passed over.
    A day that occurs twice ends the walk behind its first row. ``single_day`` looks at the start day only.
    """
    wanted = F.col("day") == start if single_day else F.col("day") >= start
    # NULL sorts first, so a duplicated day counts as not loaded
    days = status.where(wanted).groupBy("job_id", "day").agg(
        F.count("*").alias("n"), F.min(F.struct("load_status")).getField("load_status").alias("load_status")
    )
    by_day = W.partitionBy("job_id").orderBy("day")
    gap = F.datediff("day", start) != F.row_number().over(by_day) - 1
    error_stop = (F.col("load_status") == "error") & F.lit(not retry_errors)
    twice_before = F.coalesce(F.lag(F.col("n") > 1).over(by_day), F.lit(False))
    marked = days.withColumn("_stop", (gap | F.coalesce(error_stop, F.lit(False)) | twice_before).cast("int"))
    reached = marked.withColumn("_stopped", F.max("_stop").over(by_day.rowsBetween(W.unboundedPreceding, 0)))
    open_day = F.col("load_status").isNull() | ((F.col("load_status") == "error") & F.lit(retry_errors))
    return reached.where((F.col("_stopped") == 0) & open_day).select("job_id", "day")


def stand_in_status(jobs: DataFrame, start: Column, today: Column) -> DataFrame:
    """Every day from start to today per job with no load status, for jobs without a status table."""
    days = F.explode(F.sequence(start, today))
    return jobs.select("job_id", days.alias("day")).withColumn("load_status", F.lit(None).cast("string"))


def next_loadable_day(results: DataFrame, start: Column) -> DataFrame:
    """(job_id, day): the one day each job may load next, if any.

    ``results`` has job_id, day, step, seq, status. A day may load when its last extract record is a success,
    it was neither loaded nor failed yet, and every earlier day from ``start`` on is loaded.
    """
    def last(step: str) -> Column:
        return F.max_by(F.col("status"), F.when(F.col("step") == step, F.col("seq")))

    days = results.where(F.col("day") >= start).groupBy("job_id", "day").agg(
        last("et").alias("et_status"), last("load").alias("load_status")
    )
    by_day = W.partitionBy("job_id").orderBy("day")
    loaded = F.coalesce(F.col("load_status") == "success", F.lit(False))
    before = F.min(loaded.cast("int")).over(by_day.rowsBetween(W.unboundedPreceding, -1))
    no_gap = F.datediff("day", start) == F.row_number().over(by_day) - 1
    ready = no_gap & (F.coalesce(before, F.lit(1)) == 1)
    return (
        days.withColumn("_ready", ready)
        .where(F.col("_ready") & F.col("load_status").isNull() & (F.col("et_status") == "success"))
        .select("job_id", "day")
    )


# -- maintenance and planning ------------------------------------------------------------------------

def action_pending() -> Column:
    pending = F.lit(False)
    for action in ACTIONS:
        pending = pending | (F.coalesce(F.col(action), F.lit(0)) != 0)
    return pending


def stuck_rows(jobs: DataFrame, now: Column, retention_seconds: int) -> DataFrame:
    """Jobs scheduled longer than the queue keeps a message (plus an hour), or running without a keepalive.

    A job without an update time counts as updated now.
    """
    age = F.unix_micros(now) - F.unix_micros(F.coalesce("et_status_last_updated_at", now))
    limit = F.when(F.col("et_status") == "scheduled", F.lit(retention_seconds + QUEUE_GRACE_SECONDS)).when(
        F.col("et_status") == "running", F.lit(KEEPALIVE_SECONDS)
    )
    return jobs.where(age > limit.cast("bigint") * 1000000)


def retry_due(jobs: DataFrame, now: Column, max_retries: int = MAX_ERROR_RETRIES) -> DataFrame:
    """Failed jobs to run again now: their time has come and retries are left, or an action is pending.

    A missing retry time counts as now, a missing count as exhausted.
    """
    in_time = F.coalesce("et_next_error_retry_attempt", now) <= now
    left = F.coalesce("et_num_error_retries", F.lit(max_retries)) < max_retries
    return jobs.where((F.col("et_status") == "error") & ((in_time & left) | action_pending()))


def after_run(jobs: DataFrame, final_status: Column, last_ok: Column, now: Column,
              max_retries: int = MAX_ERROR_RETRIES) -> DataFrame:
    """The jobs as they are after a run: a failure adds to the retry count and sets the next attempt while
    retries are left; a success clears both; the last good day moves only when there is one."""
    failures = F.coalesce("et_num_error_retries", F.lit(-1)) + 1
    failed, succeeded = final_status == "error", final_status == "success"
    wait = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), retry_delay_seconds(failures).cast("decimal(18,6)"))
    next_attempt = F.when(failed & (failures < max_retries), now + wait)
    return jobs.withColumns({
        "et_status": final_status,
        "et_status_last_updated_at": now,
        "et_last_successful_date": F.coalesce(last_ok, F.col("et_last_successful_date")),
        "et_num_error_retries": F.when(failed, failures).when(~succeeded, F.col("et_num_error_retries")),
        "et_next_error_retry_attempt": F.coalesce(
            next_attempt, F.when(~succeeded, F.col("et_next_error_retry_attempt"))
        ),
    })


def planned_range(jobs: DataFrame, now: Column) -> DataFrame:
    """Schedulable jobs with the day range to work on (``work_start``, ``work_end``).

    Starts after the last good day, ends at the end date or the last day whose data must be there. A job for
    which nothing is ready is left out unless an action is pending.
    """
    known = F.col("max_complete_date") if "max_complete_date" in jobs.columns else None
    ready = ready_day(now, F.col("time_log_need_to_be_available"), F.col("additional_arguments"), known)
    following = F.date_add("et_last_successful_date", 1)
    has_data = (F.col("start_date") <= F.col("_ready")) & (
        F.col("et_last_successful_date").isNull() | (following <= F.col("_ready"))
    )
    return (
        jobs.where(F.coalesce("et_status", F.lit("null")).isin(*SCHEDULABLE))
        .withColumn("_ready", ready)
        .where(has_data | action_pending())
        .withColumn("work_start", later(F.col("start_date"), following))
        .withColumn("work_end", earlier(F.col("end_date"), F.col("_ready")))
        .drop("_ready")
    )


def work_plan(jobs: DataFrame, clusters: DataFrame, now: Column) -> DataFrame:
    """One row per job and day to run, with the target cluster's address.

    A job whose cluster is unknown stops the query. The join carries no broadcast hint: Spark broadcasts the
    clusters while they are small and splits hot cluster ids otherwise.
    """
    ranged = planned_range(jobs, now)
    placed = ranged.join(clusters.select("cluster_id", "host", "port", "db_schema"), "cluster_id", "left")
    stop = F.raise_error(F.concat(F.lit("unknown cluster "), F.col("cluster_id").cast("string"))).cast("string")
    days = F.when(F.col("work_start") <= F.col("work_end"), F.sequence("work_start", "work_end"))
    return placed.withColumn("host", F.coalesce("host", stop)).select(
        "job_id", "cluster_id", "host", "port", "db_schema", F.explode(days).alias("day")
    )


def display_status() -> Column:
    """What a user sees: a requested action wins over the stored status until it has taken effect."""
    status = F.coalesce("et_status", F.lit("null"))
    ended = status.isin("cancelled", "complete")
    return (
        F.when(F.col("delete_requested") == 1, F.lit("deleting"))
        .when((F.col("cancel_requested") == 1) & ~ended, F.lit("cancelling"))
        .when((F.col("pause_requested") == 1) & ~ended & (status != "paused"), F.lit("pausing"))
        .when((F.col("pause_requested") == 0) & (status == "paused"), F.lit("resuming"))
        .otherwise(status)
    )


# -- audit -------------------------------------------------------------------------------------------

def is_legal(before: Column, after: Column, legal: dict[str, list[str]] = LEGAL_TRANSITIONS) -> Column:
    """The change is in the table of legal ones; a fixed expression, so checking it needs no join."""
    found = F.lit(False)
    for status, following in legal.items():
        found = found | ((before == status) & after.isin(*following))
    return F.coalesce(found, F.lit(False))


def without_time(events: DataFrame, order: list[str]) -> DataFrame:
    """Events that have no place in the order; ``transitions`` passes over them, so they belong in an error output."""
    return events.where(F.col(order[0]).isNull())


def _slots(events: DataFrame, at: str) -> DataFrame:
    """``events`` with a column _slot that grows with time within a job; a job with many events has many slots.

    Events are counted per job first. Only what has more than SLOT_ROWS is cut, at quantiles of its own times, so a burst
    is cut where it is dense; and again, until nothing is too large, or all of it is of one instant. The cuts are stored:
    every reader sees the same slots.
    """
    micros = F.unix_micros(at)
    slotted = events.withColumn("_slot", F.lit(0).cast("long"))
    fractions = F.array(*[F.lit(n / CUTS) for n in range(1, CUTS)])
    while True:
        counts = slotted.groupBy(F.col("job_id").alias("_job"), F.col("_slot").alias("_of")).agg(
            F.count("*").alias("n"), F.min(micros).alias("low"), F.max(micros).alias("high"))
        hot = stored(counts.where((F.col("n") > SLOT_ROWS) & (F.col("low") < F.col("high"))).select("_job", "_of", "low"), "hot-jobs")
        if hot.isEmpty():
            return slotted
        same = slotted["job_id"].eqNullSafe(hot["_job"]) & (slotted["_slot"] == hot["_of"])
        cuts = slotted.join(hot, same).groupBy("_job", "_of").agg(
            F.array_append(F.percentile_approx(micros, fractions, 10 * CUTS), F.min("low")).alias("_cuts"))
        cuts = stored(cuts, "slots")
        joined = slotted.join(cuts, slotted["job_id"].eqNullSafe(cuts["_job"]) & (slotted["_slot"] == cuts["_of"]), "left")
        within = F.coalesce(F.size(F.filter(F.array_distinct("_cuts"), lambda cut: cut < micros)), F.lit(0))
        slot = F.col("_slot") * (CUTS + 1) + F.when(F.col("_cuts").isNull(), 0).otherwise(within)
        slotted = joined.withColumn("_slot", slot).drop("_job", "_of", "_cuts")


def transitions(events: DataFrame, order: list[str], initial: str = "null", first_from: DataFrame | None = None) -> DataFrame:
    """(job_id, order columns, from_status, to_status) for consecutive statuses of each job.

    ``events`` has job_id, status and the ``order`` columns, the first of which is a timestamp; a NULL status reads
    as ``null``. A job may own a large share of all events, so no task sorts a whole job: neighbours are found by a
    window over (job, slot of time), and only the first and last event of each slot go on to a window over the job.
    ``first_from`` (job_id, status) gives the status a job had before these events. Events without a time are
    ``without_time``'s.
    """
    timed = events.where(F.col(order[0]).isNotNull()).select("job_id", F.coalesce("status", F.lit("null")).alias("status"), *order)
    slotted = _slots(timed, order[0])
    in_slot = W.partitionBy("job_id", "_slot").orderBy(*order)
    rows = slotted.select(
        "job_id", "status", *order, F.lag("status").over(in_slot).alias("from_status"),
        (F.row_number().over(in_slot) == 1).alias("_first"), F.lead(F.lit(True)).over(in_slot).isNull().alias("_last"),
    )
    inside = rows.where(~F.col("_first"))
    by_job = W.partitionBy("job_id").orderBy(*order)
    # the event before the first one of a slot is the last one of an earlier slot
    first = rows.where("_first OR _last").withColumn("_before", F.lag("status").over(by_job)).where("_first")
    if first_from is not None:
        known = first_from.select("job_id", F.coalesce("status", F.lit("null")).alias("_known"))
        first = first.join(known, "job_id", "left").withColumn("_before", F.coalesce("_before", "_known"))
    across = first.withColumn("from_status", F.coalesce("_before", F.lit(initial)))
    columns = ["job_id", *order, "from_status", F.col("status").alias("to_status")]
    return inside.select(*columns).unionByName(across.select(*columns))


def illegal_transitions(changes: DataFrame, legal: dict[str, list[str]] = LEGAL_TRANSITIONS) -> DataFrame:
    """The changes that the table of legal ones does not have."""
    return changes.where(~is_legal(F.col("from_status"), F.col("to_status"), legal))


# -- listings ----------------------------------------------------------------------------------------

def log_versions(keys: DataFrame, prefix: str, column: str = "key") -> DataFrame:
    """(log_name, version) from spec keys ``<prefix>/<log>/schema/<version>/schema.yaml``; others are ignored."""
    pattern = "^" + re.escape(prefix) + r"/(\w+)/schema/(\w+)/schema\.yaml$"
    return keys.where(F.col(column).rlike(pattern)).select(
        F.regexp_extract(column, pattern, 1).alias("log_name"), F.regexp_extract(column, pattern, 2).alias("version")
    ).distinct()


def versions_by_name(keys: DataFrame, prefix: str, column: str = "key") -> DataFrame:
    """(log_name, versions) for display: ``log_versions`` with one list per log, as long as it has versions."""
    return log_versions(keys, prefix, column).groupBy("log_name").agg(F.sort_array(F.collect_list("version")).alias("versions"))
