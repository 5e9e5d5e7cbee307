"""Running a range of days: extract every day that is complete, load what the ledger says is open.

Days are partitions of one Spark job, not one job each. The extract step leaves a typed stage, by table and day,
below a folder of the spec's identity, with a marker per finished day; another version of the spec extracts its days
anew. The load step publishes the frontier: the staged days from the start on that the ledger doesn't have as loaded, up
to the first gap. Every outcome is an event of the ledger.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.operators import claims
from logweir.operators.day_tables import table_of
from logweir.operators.extract import DeriveFunction
from logweir.operators.ledger import load_frontier
from logweir.operators.retention import compact_days, delete_old_rows
from logweir.operators.sinks import DAY, data_error, staged_rows, stored_error_table, write_stage
from logweir.operators.zones import in_days
from logweir.plans.spec import ERROR_TABLE, SchemaSpec, error_table
from logweir.session import small_frame
from logweir.sources import files
from logweir.sources.days import DAY_IN_PATH, INPUT_SUFFIX, SUCCESS, days_to_run, first_complete_prefix, list_markers
from logweir.sources.registry import read_documents

SATURDAY = 6
STARTED = "started"
Note = Callable[[list[tuple]], None]
RESULT_SCHEMA = "day date, step string, table_name string, status string, error_info string"
LEDGER_SCHEMA = f"identity string, seq timestamp, n int, {RESULT_SCHEMA}"


def _tell(note: Note | None, results: list[tuple]) -> None:
    if note is not None and results:
        note(results)


def _day_path(prefix: str, day: date) -> str:
    return f"{prefix.rstrip('/')}/{day:%Y/%m/%d}"


def day_list(start: date, end: date, step: int = 1) -> list[date]:
    """All days from start to end inclusive; swapped bounds are exchanged."""
    low, high = min(start, end), max(start, end)
    return [low + timedelta(days=n) for n in range(0, (high - low).days + 1, step)]


def stage_of(stage: str, spec: SchemaSpec) -> str:
    """The folder in which a spec version stages its days: rows and markers."""
    return f"{stage.rstrip('/')}/{hashlib.sha256(spec.identity.encode()).hexdigest()[:16]}"


def extract_days(spark: SparkSession, spec: SchemaSpec, prefixes: list[str], days: list[date], stage: str,
                 fmt: str = "json", suffix: str = INPUT_SUFFIX, metrics: dict[str, DeriveFunction] | None = None,
                 force: bool = False, note: Note | None = None, hold_seconds: float = claims.HOLD_SECONDS,
                 spread: int | None = None) -> list[tuple]:
    """Stage every complete day that this spec version hasn't staged yet, all in one job; one result row per day.

    A day is claimed before it is staged, so of several runs over the same days one stages each. A day that another run
    has claimed comes back as ``running``. A claim ends with its run, or ``hold_seconds`` after it was taken if the run
    has stopped. ``note`` is told of the starts and of the outcomes. ``spread``: see ``read_lines``.
    """
    own = stage_of(stage, spec)
    wanted = small_frame(spark, [(d,) for d in days], "day date")
    ranked = small_frame(spark, list(zip(prefixes, range(len(prefixes)))), "prefix string, priority int")
    open_days = days_to_run(wanted, list_markers(spark, [own + "/markers"], SUCCESS, days))
    # one row per day comes back: it decides which folders are read
    chosen = first_complete_prefix(open_days, ranked, list_markers(spark, prefixes, days=days), force).collect()
    inputs = {r["day"]: r["prefix"] and _day_path(r["prefix"], r["day"]) + suffix for r in chosen}
    failures = {day: "no complete prefix" for day, path in inputs.items() if path is None}
    failures |= {day: "no input files" for day, path in inputs.items() if path and not files.glob(spark, path)}
    held = {day: claims.take(spark, f"{own}/claims/{day:%Y-%m-%d}", hold_seconds) for day in sorted(inputs) if day not in failures}

    def marker(day: date) -> str:
        return f"{_day_path(own + '/markers', day)}/{SUCCESS}"

    def stage_days(part: dict[date, str]) -> None:
        docs = read_documents(spark, fmt, list(part.values()), DAY_IN_PATH, spread)
        for day in part:  # what a broken run has left
            for path in files.glob(spark, f"{own}/rows/table=*/{DAY}={day.isoformat()}"):
                files.remove(spark, path)
        write_stage(docs, spec, own + "/rows", metrics)
        for day in part:
            files.touch(spark, marker(day))

    try:
        # Another run may have staged a day since the markers were listed.
        left = [day for day in held if not files.exists(spark, marker(day))]
        taken = [day for day in left if held[day] is None]
        ready = {day: inputs[day] for day in left if held[day] is not None}
        _tell(note, [(day, "et", None, STARTED, None) for day in ready])
        failures |= _one_job_or_one_each(ready, stage_days)
    finally:
        for claim in filter(None, held.values()):
            claim.release()

    def outcome(day: date) -> tuple:
        if day in taken:
            return (day, "et", None, "running", "claimed by another run")
        return (day, "et", None, "error" if day in failures else "success", failures.get(day))

    results = [outcome(day) for day in days]
    _tell(note, [r for r in results if r[0] in ready or r[0] in failures])  # days staged earlier are known
    return results


def _one_job_or_one_each(parts: dict[date, str], run) -> dict[date, str]:
    """Run all days together; when their data stops the job, one by one. Returns the failing days with their errors."""
    failures = {}
    if not parts:
        return failures
    try:
        run(parts)
    except Exception as stopped:
        data_error(stopped)
        for day, value in sorted(parts.items()):
            try:
                run({day: value})
            except Exception as stopped_day:  # the step's outcome is data for the ledger
                failures[day] = data_error(stopped_day)
    return failures


def load_days(spark: SparkSession, spec: SchemaSpec, days: list[date], stage: str, root: str,
              ttl_days: int | None = None, today: date | None = None, namespace: str | None = None,
              loaded: dict[str, set[date]] | None = None, note: Note | None = None) -> list[tuple]:
    """Publish staged days as tables below ``root``, exactly; one result row per day and table.

    With a ``namespace`` the tables are those of the catalog, and readers see each day's old rows or its new ones; without
    one they are folders. What differs from the spec by more than added columns is an error. All days go in one job per
    table; if data stops it, they go one by one in order, and the first day that fails ends the load. With ``ttl_days`` a
    table first makes room for one day by dropping what is too old, and on Saturdays it is compacted; after a load of
    several days what they pushed out is dropped as well. Days that ``loaded`` names for a table are passed over there.
    ``note`` is told of starts, and of each table as soon as it is published.
    """
    if not days:
        return []
    tables = {n: table_of(spark, n, t, root, namespace) for n, t in {**spec.tables, ERROR_TABLE: stored_error_table()}.items()}
    rows_of = {n: staged_rows(spark, stage_of(stage, spec) + "/rows", n, spec.tables.get(n, error_table()), True) for n in tables}
    done: dict[str, set[date]] = {n: set((loaded or {}).get(n, ())) for n in tables}

    def load(name: str, part: list[date]) -> list[tuple]:
        stored, part = tables[name], [day for day in part if day not in done[name]]
        if part:
            stored.check()
            if ttl_days is not None and stored.by_day():
                delete_old_rows(stored, ttl_days - 1)
                if (today or date.today()).isoweekday() == SATURDAY:
                    compact_days(stored)
            stored.replace(rows_of[name].where(in_days(part)), part)
            if ttl_days is not None and len(part) > 1:
                delete_old_rows(stored, ttl_days)
            done[name].update(part)
        outcomes = [(day, "load", name, "success", None) for day in part]
        _tell(note, outcomes)
        return outcomes

    def finished(part: list[date]) -> None:
        _tell(note, [(day, "load", None, "success", None) for day in part])

    results: list[tuple] = []
    _tell(note, [(day, "load", None, STARTED, None) for day in days])
    try:
        for name in tables:
            results += load(name, days)
        finished(days)
        return results
    except Exception as stopped:
        data_error(stopped)
    for day in sorted(days):
        for name in tables:
            try:
                results += load(name, [day])
            except Exception as stopped:
                failed = (day, "load", name, "error", data_error(stopped))
                _tell(note, [failed])
                return [*results, failed]
        finished([day])
    return results


def ledger_events(spark: SparkSession, ledger: str) -> DataFrame:
    """All events of a ledger folder; none where it does not exist yet."""
    if not files.glob(spark, f"{ledger}/*"):
        return small_frame(spark, [], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(f"{ledger}/*")


def ledger_steps(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger as step events of whole days (job_id, data_date, step, result, at, error_info), as ``run_rows`` takes them.

    A start has no result. A day's load ends well when all tables are there, and badly with the first that fails.
    """
    known = ledger_events(spark, ledger).where(F.col("table_name").isNull() | (F.col("status") == "error"))
    return known.select(F.col("identity").alias("job_id"), F.col("day").alias("data_date"), "step",
                        F.when(F.col("status") != STARTED, F.col("status")).alias("result"), F.col("seq").alias("at"), "error_info")


def _newest(spark: SparkSession, spec: SchemaSpec, ledger: str) -> DataFrame:
    """(day, table_name, status): the newest outcome of loading each table's day; what concerns the whole day has no name."""
    known = ledger_events(spark, ledger).where((F.col("identity") == spec.identity) & (F.col("step") == "load") & (F.col("status") != STARTED))
    return known.groupBy("day", F.coalesce("table_name", F.lit("")).alias("table_name")).agg(F.max_by("status", F.struct("seq", "n")).alias("status"))


def load_status(spark: SparkSession, spec: SchemaSpec, days: list[date], ledger: str) -> DataFrame:
    """(job_id, day, load_status): complete once every table is loaded, error where the newest word on one is a failure, else NULL.

    So a day of which a stopped run has loaded some tables is open.
    """
    good = F.count_if((F.col("status") == "success") & F.col("table_name").isin(*spec.tables, ERROR_TABLE))
    state = _newest(spark, spec, ledger).groupBy("day").agg(
        F.when(good == len(spec.tables) + 1, "complete").when(F.bool_or(F.col("status") != "success"), "error").alias("load_status"))
    wanted = small_frame(spark, [(d,) for d in days], "day date")
    return wanted.join(state, "day", "left").select(F.lit(spec.identity).alias("job_id"), "day", "load_status")


def loaded_tables(spark: SparkSession, spec: SchemaSpec, days: list[date], ledger: str) -> dict[str, set[date]]:
    """Per table, which of ``days`` are loaded; one row per day and table comes to the driver."""
    newest = _newest(spark, spec, ledger).where((F.col("status") == "success") & (F.col("table_name") != "") & F.col("day").isin(days))
    found: dict[str, set[date]] = {}
    for r in newest.collect():
        found.setdefault(r["table_name"], set()).add(r["day"])
    return found


def record(spark: SparkSession, spec: SchemaSpec, ledger: str, results: list[tuple]) -> None:
    """Append outcomes to the ledger, in a folder of their own: runs at the same time must not share one that is being written."""
    at = datetime.now(timezone.utc)
    rows = small_frame(spark, [(spec.identity, at, n, *r) for n, r in enumerate(results)], LEDGER_SCHEMA)
    rows.coalesce(1).write.parquet(f"{ledger}/{at:%Y%m%dT%H%M%S}-{uuid.uuid4().hex}")


def load_frontier_days(spark: SparkSession, spec: SchemaSpec, days: list[date], staged: list[date], stage: str, root: str, ledger: str,
                       ttl_days: int | None = None, retry_errors: bool = True, namespace: str | None = None,
                       days_at_once: int | None = None) -> list[tuple]:
    """Load what the ledger says is open of the ``staged`` days, from the first of ``days`` to the first gap; one result row per day and table.

    Starts and outcomes go to the ledger as soon as they are known. One run at a time loads below ``root``: while another
    does, nothing is loaded here. ``days_at_once``: days that are loaded together, default all.
    """
    claim = claims.take(spark, f"{root}/_claims/load")
    if claim is None:
        return []
    try:
        return _load_frontier(spark, spec, days, staged, stage, root, ledger, ttl_days, retry_errors, namespace, days_at_once)
    finally:
        claim.release()


def _load_frontier(spark: SparkSession, spec: SchemaSpec, days: list[date], staged: list[date], stage: str, root: str, ledger: str,
                   ttl_days: int | None, retry_errors: bool, namespace: str | None, days_at_once: int | None) -> list[tuple]:
    # With a step the days walked are numbered on, so that the walk sees no gap between them.
    number = {day: days[0] + timedelta(days=n) for n, day in enumerate(days)}
    status = load_status(spark, spec, staged, ledger)
    walked = status.join(small_frame(spark, list(number.items()), "day date, place date"), "day").select("job_id", F.col("place").alias("day"), "load_status")
    frontier = {r["day"] for r in load_frontier(walked, F.lit(days[0]), retry_errors).collect()}  # one row per day
    to_load = [d for d in days if number[d] in frontier]
    loaded = loaded_tables(spark, spec, to_load, ledger) if to_load else {}
    results: list[tuple] = []
    at_once = days_at_once or max(len(to_load), 1)
    for n in range(0, len(to_load), at_once):
        results += load_days(spark, spec, to_load[n:n + at_once], stage, root, ttl_days, namespace=namespace, loaded=loaded,
                             note=lambda made: record(spark, spec, ledger, made))
        if results and results[-1][3] != "success":
            break
    return results


def run_days(spark: SparkSession, spec: SchemaSpec, prefixes: list[str], start: date, end: date, stage: str,
             root: str, fmt: str = "json", suffix: str = INPUT_SUFFIX,
             metrics: dict[str, DeriveFunction] | None = None, step: int = 1, ttl_days: int | None = None,
             ledger: str | None = None, retry_errors: bool = True, namespace: str | None = None,
             days_at_once: int | None = None, spread: int | None = None) -> DataFrame:
    """Extract, then load, a range of days; (day, step, table_name, status, error_info) of what was done.

    The ledger (default: ``<root>/_ledger``) decides what to load: days of this spec version that aren't loaded yet, from
    the start to the first day that isn't extracted, or that has failed unless ``retry_errors``. A day that cannot be
    extracted does not keep later days from being extracted, but nothing from that day on is loaded. Starts and outcomes
    are in the ledger as soon as they are known, so a run after one that was stopped goes on where that was: days staged
    are not staged again, tables loaded not loaded again.
    """
    ledger = ledger or f"{root}/_ledger"
    days = day_list(start, end, step)
    results = extract_days(spark, spec, prefixes, days, stage, fmt, suffix, metrics, note=lambda made: record(spark, spec, ledger, made), spread=spread)
    staged = [day for day, _, _, status, _ in results if status == "success"]
    missing = next(((day, info) for day, _, _, status, info in results if status != "success"), None)
    if missing:
        late = (missing[0], "load", None, "error", f"not extracted: {missing[1]}")
        record(spark, spec, ledger, [late])
        results = [*results, late]
    results += load_frontier_days(spark, spec, days, staged, stage, root, ledger, ttl_days, retry_errors, namespace, days_at_once)
    return small_frame(spark, results, RESULT_SCHEMA)


def loaded_counts(spark: SparkSession, spec: SchemaSpec, root: str) -> DataFrame:
    """(data_date, table_name, n_rows) of what is stored; Parquet answers counts from its footers."""
    counted = None
    for name in [*spec.tables, ERROR_TABLE]:
        if not files.glob(spark, f"{root}/{name}/{DAY}=*"):
            continue
        rows = spark.read.parquet(f"{root}/{name}").groupBy(DAY).agg(F.count("*").alias("n_rows"))
        rows = rows.select(DAY, F.lit(name).alias("table_name"), "n_rows")
        counted = rows if counted is None else counted.unionByName(rows)
    return counted if counted is not None else small_frame(
        spark, [], f"{DAY} date, table_name string, n_rows bigint"
    )
