"""Streams: same result as a batch, replays, state between batches."""

import datetime as dt
import json


from logweir.operators import days, ledger, sinks
from logweir.operators.extract import extract_tables
from logweir.plans.spec import parse_spec
from logweir.sources import files
from logweir.sources.lines import parse_lines, read_lines
from logweir.streaming import audit, daily, ingest, ready

SPEC = parse_spec("""
version: 1
tables:
  doc:
    src: ''
    src_type: dict
    columns:
    - {log_key: id, sql_attr: int8, is_mandatory: true}
    - {name: __source_filename__, sql_attr: varchar(999), is_derived: true}
    sortkey_attr: []
  item:
    src: items
    src_type: list
    columns:
    - {log_key: index, sql_attr: int4}
    - {log_key: value, sql_attr: int8}
    sortkey_attr: []
""")


def write_file(folder, name, values):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join((v if isinstance(v, str) else json.dumps(v)) + "\n" for v in values))


def run(spark, tmp_path, **more):
    ingest.ingest_stream(spark, f"{tmp_path}/in/*", SPEC, f"{tmp_path}/out", f"{tmp_path}/checkpoint",
                         day_pattern=r"(\d{4})-(\d{2})-(\d{2})", **more).awaitTermination()


def test_stream_equals_batch(spark, tmp_path):
    for n in range(3):
        write_file(tmp_path / "in" / f"2014-01-0{n + 1}", f"f{n}.json", [{"id": n * 10 + i, "items": [i] * i} for i in range(4)] + ["bad"])
    run(spark, tmp_path, max_files_per_batch=1)
    write_file(tmp_path / "in" / "2014-01-04", "late.json", [{"id": 99}, {"items": [1]}])
    run(spark, tmp_path)
    batch = parse_lines(read_lines(spark, f"{tmp_path}/in/*", r"(\d{4})-(\d{2})-(\d{2})"))
    for name, want in extract_tables(batch, SPEC).items():
        got = ingest.ingested(spark, f"{tmp_path}/out", SPEC, name).select(want.columns)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and not want.isEmpty()
    errors = ingest.ingested_errors(spark, f"{tmp_path}/out", SPEC)
    assert sorted(r.error_reason[:8] for r in errors.collect()) == ["line is "] * 3 + ["required"]
    assert errors.where("data_date = date'2014-01-04'").count() == 1
    assert len(files.glob(spark, f"{tmp_path}/out/doc/data_date=*/batch_id=*")) == 4


def test_a_replayed_batch_does_not_repeat_rows(spark, tmp_path):
    write_file(tmp_path / "in" / "2014-01-01", "f.json", [{"id": 1}])
    run(spark, tmp_path)
    files.remove(spark, f"{tmp_path}/checkpoint/commits")  # as if the job died before the batch was marked done
    run(spark, tmp_path)
    assert ingest.ingested(spark, f"{tmp_path}/out", SPEC, "doc").count() == 1


def test_daily_counts_wait_for_late_data(spark, tmp_path):
    def add(name, *stamps):
        rows = [(dt.datetime.fromisoformat(s),) for s in stamps]
        spark.createDataFrame(rows, "ts timestamp").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def final():
        source = spark.readStream.schema("ts timestamp").parquet(f"{tmp_path}/in")
        daily.write_final_days(daily.daily_counts(source), f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
        return sorted((r.day.day, r.n_rows) for r in spark.read.schema("day date, n_rows bigint").parquet(f"{tmp_path}/out").collect())

    add("a", "2014-01-01T10:00:00", "2014-01-02T10:00:00")
    assert final() == []
    add("b", "2014-01-01T23:59:00", "2014-01-03T23:59:00")
    assert final() == []
    add("c", "2014-01-04T00:00:00")
    assert final() == [(1, 2)]
    add("d", "2014-01-05T00:00:00")
    assert final() == [(1, 2), (2, 1)]


def audit_files(spark, tmp_path, parts, schema, delay, slot="10 minutes"):
    """Run the audit, a batch per file, stopped and started again after the first; the events end with one of another job, long after the others."""
    queries, partitions = [], spark.conf.get("spark.sql.shuffle.partitions")
    end = (None, None, dt.datetime(2014, 6, 1), -1)
    spark.conf.set("spark.sql.shuffle.partitions", 2)  # two Python workers each
    try:
        for some in (parts[:1], [*parts[1:], [end]]):
            for part in some:
                spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
            source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
            queries.append(audit.audit_stream(source, ["at", "n"], f"{tmp_path}/out", f"{tmp_path}/checkpoint", delay=delay, slot=slot))
            queries[-1].awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    return audit.audited(spark, f"{tmp_path}/out", source.schema, ["at", "n"]), queries


STATUSES = "job_id int, status string, at timestamp, n int"


def test_audit_carries_state_between_batches(spark, tmp_path):
    kinds = list(ledger.LEGAL_TRANSITIONS)
    start = dt.datetime(2014, 1, 1)
    # Job 0 has half of all events, all in a few slots.
    rows = [(i % 4 if i % 2 else 0, kinds[(i * 5 + i // 3) % len(kinds)], start + dt.timedelta(minutes=i), i) for i in range(120)]
    found, queries = audit_files(spark, tmp_path, [rows[:40], rows[40:80], rows[80:]], STATUSES, "30 minutes")
    want = ledger.illegal_transitions(ledger.transitions(spark.createDataFrame(rows, STATUSES), ["at", "n"]))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    # What is over has left the state; in the end it holds one status per job.
    held = [sum(o["numRowsTotal"] for o in p["stateOperators"]) for q in queries for p in q.recentProgress]
    assert held[-1] <= 5 and not files.exists(spark, f"{tmp_path}/out/events")


def test_audit_of_late_files(spark, tmp_path):
    """Legal in order, but the files come in another order; and a status that is missing."""
    steps = ["scheduled", "running", None, "scheduled", "running", "success", "scheduled", "error"]
    rows = [(1, status, dt.datetime(2014, 1, 1) + dt.timedelta(minutes=n), n) for n, status in enumerate(steps)] + [(1, "running", None, 99)]
    found, _ = audit_files(spark, tmp_path, [[rows[n] for n in part] for part in ([5, 6], [8, 0, 3], [1, 2, 4, 7])], STATUSES, "2 days", "5 minutes")
    assert [(r.n, r.from_status, r.to_status) for r in found.collect()] == [(7, "scheduled", "error")]
    source = spark.readStream.schema(STATUSES).parquet(f"{tmp_path}/in")
    audit.untimed_stream(source, ["at", "n"], f"{tmp_path}/out", f"{tmp_path}/untimed-checkpoint").awaitTermination()
    assert [r.n for r in spark.read.parquet(f"{tmp_path}/out/untimed").collect()] == [99]


def test_audit_events_wait_in_the_jvm(spark, tmp_path):
    """Only one row per job and slot goes to Python, not the events."""
    rows = [(1, "running", dt.datetime(2014, 1, 1) + dt.timedelta(seconds=n), n) for n in range(50)]
    found, queries = audit_files(spark, tmp_path, [rows[:25], rows[25:]], STATUSES, "30 minutes")
    assert [(r.n, r.from_status) for r in found.collect()] == [(0, "null")]
    last = queries[-1].recentProgress[0]["stateOperators"]
    assert sorted(o["operatorName"] == "stateStoreSave" for o in last) == [False, True]


def test_late_rows_are_kept_and_counted(spark, tmp_path):
    def add(*stamps):
        rows = [(n, s and dt.datetime.fromisoformat(s)) for n, s in enumerate(stamps)]
        spark.createDataFrame(rows, "n int, ts timestamp").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        source = spark.readStream.schema("n int, ts timestamp").parquet(f"{tmp_path}/in")
        daily.count_days(source, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
        found = [(r.state, r.day and r.day.day, r.n_rows) for r in daily.counted_days(spark, f"{tmp_path}/out").collect()]
        return sorted(found, key=lambda r: (r[0], r[1] or 0))

    assert daily.counted_days(spark, f"{tmp_path}/none").count() == 0
    assert add("2014-01-01T10:00:00", "2014-01-02T10:00:00") == [("open", 1, 1), ("open", 2, 1)]
    assert add("2014-01-01T23:59:00", "2014-01-03T23:59:00") == [("open", 1, 2), ("open", 2, 1), ("open", 3, 1)]
    first = [("final", 1, 2), ("open", 2, 1), ("open", 3, 1), ("open", 4, 1)]
    assert add("2014-01-04T00:00:00") == first
    files.remove(spark, f"{tmp_path}/checkpoint/commits/2")  # the batch is run again, as if the job had died before it was marked done
    last = add("2014-01-01T00:00:00", "2014-01-01T05:00:00", None, "2014-01-09T00:00:00")
    assert last == [("final", 1, 2), ("final", 2, 1), ("final", 3, 1), ("final", 4, 1), ("late", None, 1), ("late", 1, 2), ("open", 9, 1)]
    assert len(files.glob(spark, f"{tmp_path}/out/open/batch_id=*")) == 2


def test_days_are_picked_up_by_their_markers(spark, tmp_path):
    for n in range(1, 4):
        write_file(tmp_path / "in" / "2014" / "01" / f"0{n}", "part-0.json", [{"id": n}] * n)
    args = (spark, SPEC, [str(tmp_path / "in")], dt.date(2014, 1, 1), f"{tmp_path}/stage", f"{tmp_path}/out", f"{tmp_path}/checkpoint")

    def arrive(*marked):
        for n in marked:
            files.touch(spark, f"{tmp_path}/in/2014/01/0{n}/COMPLETE")
        ready.follow_days(*args, suffix="/part-*.json").awaitTermination()
        rows = days.loaded_counts(spark, SPEC, f"{tmp_path}/out").where("table_name = 'doc'").collect()
        return sorted((r.data_date.day, r.n_rows) for r in rows)

    assert arrive() == [] and arrive(2) == [] and arrive(3) == []
    assert arrive(1) == [(1, 1), (2, 2), (3, 3)]
    steps = days.ledger_events(spark, f"{tmp_path}/out/_ledger").where("status = 'started'").groupBy("step", "day").count()
    assert sorted((r.step, r.day.day, r["count"]) for r in steps.collect()) == [(s, n, 1) for s in ("et", "load") for n in (1, 2, 3)]


def test_a_batch_is_parsed_once(spark, tmp_path, monkeypatch):
    write_file(tmp_path / "in" / "2014-01-01", "f.json", [{"id": 1, "items": [1, 2]}, "bad"])
    parsed = []
    monkeypatch.setattr(ingest, "write_stage", lambda docs, *args: (parsed.append(docs), sinks.write_stage(docs, *args)))
    run(spark, tmp_path)
    assert len(parsed) == 1
    assert [ingest.ingested(spark, f"{tmp_path}/out", SPEC, n).count() for n in ("doc", "item", "pipeline_errors")] == [1, 2, 1]
