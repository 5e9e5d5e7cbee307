"""Ledger questions: against plain walks, and single cases."""

import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from logweir.operators import ledger


def d(text):
    return dt.date.fromisoformat(text) if text else None


def day(number):
    return dt.date(2014, 7, number)


def frontier_by_walking(days: dict, start: int, retry: bool) -> list[int]:
    """The rule as a loop: from the start on day by day, until a day is missing or an error stands in the way."""
    found, at = [], start
    while at in days:
        if days[at] == "error" and not retry:
            break
        if days[at] in (None, "error"):
            found.append(at)
        at += 1
    return found


@pytest.mark.parametrize("retry", [False, True])
def test_frontier_of_random_ledgers(spark, retry):
    """300 jobs, each with some of the days 1 to 9 in random states."""
    rng = random.Random(retry)
    ledgers = {f"job {n}": {k: rng.choice([None, None, "complete", "running", "error"]) for k in range(1, 10) if rng.random() < 0.85} for n in range(300)}
    rows = [(job, day(k), status) for job, days in ledgers.items() for k, status in days.items()]
    frame = spark.createDataFrame(rows, "job_id string, day date, load_status string")
    for start in (1, 4):
        got = {}
        for r in ledger.load_frontier(frame, F.lit(day(start)), retry).collect():
            got.setdefault(r.job_id, []).append(r.day.day)
        assert {j: sorted(x) for j, x in got.items()} == {j: x for j, days in ledgers.items() if (x := frontier_by_walking(days, start, retry))}


def test_frontier_of_a_single_day(spark):
    rows = [("j", day(4), None), ("j", day(5), None), ("j", day(6), None)]
    frame = spark.createDataFrame(rows, "job_id string, day date, load_status string")
    assert [r.day.day for r in ledger.load_frontier(frame, F.lit(day(5)), single_day=True).collect()] == [5]


def test_frontier_stops_behind_a_repeated_day(spark):
    rows = [("j", day(1), None), ("j", day(2), None), ("j", day(2), None), ("j", day(3), None)]
    frame = spark.createDataFrame(rows, "job_id string, day date, load_status string")
    assert sorted(r.day.day for r in ledger.load_frontier(frame, F.lit(day(1))).collect()) == [1, 2]


def test_stand_in_status_feeds_the_frontier(spark):
    jobs = spark.createDataFrame([("a",), ("b",)], "job_id string")
    status = ledger.stand_in_status(jobs, F.lit(day(1)), F.lit(day(4)))
    assert ledger.load_frontier(status, F.lit(day(1))).count() == 8


def fold_by_walking(results: list, end) -> tuple:
    """The rule as a loop over the days in order; results are (day, seq, status, info)."""
    if not results:
        return "error", None, None
    good = None
    for this in sorted({r[0] for r in results}):
        of_day = sorted(r for r in results if r[0] == this)
        broken = next((r for r in of_day if r[2] != "success"), None)
        if broken:
            return ("error", good, broken[3]) if broken[2] in ("error", "unknown") else ("success", good, None)
        good = this
    return ("complete" if good == end else "success"), good, None


def test_fold_of_random_results(spark):
    """400 jobs with up to 8 results over 5 days; some end on a day of theirs, some have no result at all."""
    rng, rows, ends, want = random.Random(11), [], [], {}
    for n in range(400):
        made = [(day(rng.randint(1, 5)), seq, rng.choice(["success"] * 7 + ["error", "unknown", "cancelled"]), f"info {n}/{seq}") for seq in range(rng.randint(0, 8))]
        end = rng.choice([None, *(day(k) for k in range(1, 6))])
        rows += [(f"job {n}", *r) for r in made]
        ends.append((f"job {n}", end))
        want[f"job {n}"] = fold_by_walking(made, end)
    frame = spark.createDataFrame(rows, "job_id string, day date, seq int, status string, error_info string")
    got = ledger.result_fold(frame, spark.createDataFrame(ends, "job_id string, end_date date")).collect()
    assert {r.job_id: (r.status, r.last_ok_day, r.error_info) for r in got} == want
    open_end = {r.job_id: (r.status, r.last_ok_day) for r in ledger.result_fold(frame).collect()}
    assert open_end == {j: ("success" if w[0] == "complete" else w[0], w[1]) for j, w in want.items() if j in open_end}


@pytest.mark.parametrize("records, expected", [
    ([(1, "et", "success")], 1), ([(1, "et", "error")], None), ([(2, "et", "success")], None),
    ([(1, "et", "success"), (1, "load", "success"), (2, "et", "success")], 2),
    ([(1, "et", "success"), (1, "load", "error"), (2, "et", "success")], None),
    ([(1, "et", "success"), (1, "load", "success"), (2, "et", "error"), (3, "et", "success")], None),
    ([(1, "et", "error"), (1, "et", "success")], 1), ([(1, "et", "success"), (1, "load", "success")], None),
])
def test_next_loadable(spark, records, expected):
    rows = [("j", day(n), step, i, status) for i, (n, step, status) in enumerate(records)]
    frame = spark.createDataFrame(rows, "job_id string, day date, step string, seq int, status string")
    got = [r.day.day for r in ledger.next_loadable_day(frame, F.lit(day(1))).collect()]
    assert got == ([expected] if expected else [])


def steps(spark, *rows):
    data = [("j", day(1), step, result, dt.datetime(2014, 7, 2, 0, 0) + dt.timedelta(seconds=at), info) for step, result, at, info in rows]
    return spark.createDataFrame(data, "job_id string, data_date date, step string, result string, at timestamp, error_info string")


@pytest.mark.parametrize("rows, expected", [
    ([("et", None, 0, None)], ("et_started", None, None, None)),
    ([("et", None, 0, None), ("et", "success", 1.5, None)], ("et_success", 1.5, None, None)),
    ([("et", "error", 3, None)], ("et_error", 0.0, None, "None")),
    ([("et", None, 0, None), ("et", "success", 2, None), ("load", None, 3, None), ("load", "error", 7, "bad")], ("load_error", 2.0, 4.0, "bad")),
    ([("et", None, 0, None), ("et", "error", 5, "x"), ("et", None, 9, None)], ("et_started", 5.0, None, "x")),
    ([("et", None, 0, None), ("et", None, 4, None), ("et", "success", 5, None)], ("et_success", 1.0, None, None)),
    ([("et", None, 0, None), ("et", "error", 5, "x"), ("et", None, 9, None), ("et", "success", 10, None)], ("et_success", 1.0, None, None)),
])
def test_run_rows(spark, rows, expected):
    got = ledger.run_rows(steps(spark, *rows)).first()
    assert (got.etl_status, got.et_runtime, got.load_runtime, got.etl_error) == expected


def test_latest_per_key(spark):
    rows = [(1, 10, "a"), (1, 12, None), (2, 5, "z"), (1, 11, "b")]
    got = ledger.latest_per_key(spark.createDataFrame(rows, "k int, at int, v string"), ["k"], ["at"])
    assert sorted(map(tuple, got.collect())) == [(1, 12, None), (2, 5, "z")]
    with pytest.raises(ValueError, match="unknown fields: v"):
        ledger.only_known_fields(got, ["k", "at"])
    assert ledger.without_key(spark.createDataFrame([("a",), (None,), ("b",)], "k string"), "k", "a").count() == 2


NOW = dt.datetime(2015, 1, 1, 12, 0)
JOB = ("job_id string, et_status string, et_status_last_updated_at timestamp, et_num_error_retries int, "
       "et_next_error_retry_attempt timestamp, et_last_successful_date date, cancel_requested int, pause_requested int, delete_requested int")


def jobs(spark, *rows):
    return spark.createDataFrame([(str(i), *r) for i, r in enumerate(rows)], JOB)


def ago(seconds):
    return NOW - dt.timedelta(seconds=seconds)


def test_stuck(spark):
    made = jobs(spark, *[(s, t, None, None, None, 0, 0, 0) for s, t in (
        ("running", ago(301)), ("running", ago(300)), ("running", None), ("scheduled", ago(3600 + 101)), ("scheduled", ago(3600 + 100)), ("success", ago(10**6)))])
    assert sorted(r.job_id for r in ledger.stuck_rows(made, F.lit(NOW), 100).collect()) == ["0", "3"]


def test_retry_due(spark):
    made = jobs(spark, *[("error", None, n, t, None, c, 0, 0) for n, t, c in (
        (0, ago(1), 0), (15, ago(0), 0), (16, ago(1), 0), (None, ago(1), 0), (3, None, None), (3, ago(-1), 0), (16, None, 1))])
    assert sorted(r.job_id for r in ledger.retry_due(made, F.lit(NOW)).collect()) == ["0", "1", "4", "6"]


@pytest.mark.parametrize("before, final, count, wait", [
    (None, "error", 0, 300), (0, "error", 1, 600), (14, "error", 15, 300 * 2**15), (15, "error", 16, None), (5, "success", None, None), (5, "paused", 5, None),
])
def test_after_run(spark, before, final, count, wait):
    made = jobs(spark, ("running", ago(9), before, None, d("2014-01-01"), 0, 0, 0))
    got = ledger.after_run(made, F.lit(final), F.lit(None).cast("date"), F.lit(NOW)).first()
    assert (got.et_status, got.et_num_error_retries, got.et_last_successful_date) == (final, count, d("2014-01-01"))
    assert got.et_next_error_retry_attempt == (NOW + dt.timedelta(seconds=wait) if wait else None)


@pytest.mark.parametrize("start, end, status, last, delay, expected", [
    ("2014-01-01", "2014-01-03", "null", None, None, ("2014-01-01", "2014-01-03")),
    ("2014-12-29", None, "null", None, None, ("2014-12-29", "2014-12-30")),
    ("2014-12-01", None, "success", "2014-12-29", None, ("2014-12-30", "2014-12-30")),
    ("2014-12-01", None, "success", "2014-12-30", None, None), ("2014-12-31", None, "null", None, None, None),
    ("2014-12-31", None, "null", None, "12:00", ("2014-12-31", "2015-01-01")), ("2014-01-01", "2014-01-03", "error", None, None, None),
    ("2014-01-01", "2014-01-03", None, None, None, ("2014-01-01", "2014-01-03")),
])
def test_work_plan(spark, start, end, status, last, delay, expected):
    row = ("j", 7, d(start), d(end), status, d(last), delay, "{}", 0, 0, 0)
    made = spark.createDataFrame([row], "job_id string, cluster_id int, start_date date, end_date date, et_status string, et_last_successful_date date, "
                                 "time_log_need_to_be_available string, additional_arguments string, cancel_requested int, pause_requested int, delete_requested int")
    clusters = spark.createDataFrame([(7, "h", 5, "public")], "cluster_id int, host string, port int, db_schema string")
    plan = ledger.work_plan(made, clusters, F.lit(NOW)).orderBy("day").collect()
    assert (str(plan[0].day), str(plan[-1].day)) == expected if expected else plan == []
    assert all(p.host == "h" for p in plan)
    if expected:
        with pytest.raises(PySparkException, match="unknown cluster 7"):
            ledger.work_plan(made, clusters.where("port = 0"), F.lit(NOW)).collect()


@pytest.mark.parametrize("delete, cancel, pause, status, shown", [
    (1, 1, 1, "running", "deleting"), (0, 1, 1, "running", "cancelling"), (0, 1, 0, "cancelled", "cancelled"), (0, 0, 1, "running", "pausing"),
    (0, 0, 1, "paused", "paused"), (0, 0, 0, "paused", "resuming"), (0, 0, 1, "complete", "complete"), (0, 0, 0, None, "null"),
])
def test_display(spark, delete, cancel, pause, status, shown):
    made = jobs(spark, (status, None, None, None, None, cancel, pause, delete))
    assert made.select(ledger.display_status()).first()[0] == shown


def test_versions(spark):
    keys = ["p/s/ad/schema/v2/schema.yaml", "p/s/ad/schema/v1/schema.yaml", "p/s/ad/schema/v1/schema.yaml", "p/s/b/schema/x/schema.yaml",
            "p/s/a-d/schema/v1/schema.yaml", "p/s/ad/schema/schema.yaml", "x/p/s/ad/schema/v9/schema.yaml", "p/s/ad/schema/v1/schemaXyaml", "p/s/ad/schema/v1/schema.yaml.bak"]
    got = ledger.versions_by_name(spark.createDataFrame([(k,) for k in keys], "key string"), "p/s").collect()
    assert {r.log_name: r.versions for r in got} == {"ad": ["v1", "v2"], "b": ["x"]}


def brute_transitions(rows, initial="null"):
    last, out = {}, []
    for job, status, at, n in sorted(rows, key=lambda r: (r[2], r[3])):
        out.append((job, n, last.get(job, initial), status))
        last[job] = status
    return sorted(out)


@pytest.mark.parametrize("slot_rows", [1, 50, 10**6])
def test_transitions_against_a_walk(spark, slot_rows, monkeypatch):
    """However a job's time is cut into slots: a burst at one instant, NULL statuses, events without a time."""
    monkeypatch.setattr(ledger, "SLOT_ROWS", slot_rows)
    kinds = [*ledger.LEGAL_TRANSITIONS, None]
    rows = [(i % 3 if i % 2 else 0, kinds[(i * 7 + i // 5) % len(kinds)], NOW + dt.timedelta(seconds=0 if i % 4 == 0 else (i * 37) % 5000), i) for i in range(600)]
    frame = spark.createDataFrame([*rows, (0, "running", None, 600), (1, None, None, 601)], "job_id int, status string, at timestamp, n int")
    changes = ledger.transitions(frame, ["at", "n"])
    got = sorted((r.job_id, r.n, r.from_status, r.to_status) for r in changes.collect())
    assert got == brute_transitions([(j, s or "null", at, n) for j, s, at, n in rows])
    bad = sorted((r.job_id, r.n, r.from_status, r.to_status) for r in ledger.illegal_transitions(changes).collect())
    assert bad == [t for t in got if t[3] not in ledger.LEGAL_TRANSITIONS[t[2]]]
    assert sorted(r.n for r in ledger.without_time(frame, ["at", "n"]).collect()) == [600, 601]
