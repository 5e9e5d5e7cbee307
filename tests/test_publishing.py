"""Days change places without loss, claims, the ledger of a run that is stopped, zone maps."""

import datetime as dt
import json
import threading
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from logweir.operators import claims, day_tables, days, evolve, ledger, retention, sinks, zones
from logweir.plans.spec import SpecError, TableSpec, parse_spec
from logweir.sources import files


def table(*columns, sortkeys=()):
    return TableSpec.from_dict({"src": "", "src_type": "dict", "sortkey_attr": list(sortkeys),
                                "columns": [{"log_key": n, "sql_attr": a} for n, a in columns]})


IDS = table(("id", "int8"), ("mark", "varchar(9)"))
EVENTS = table(("id", "int8"), ("ts", "TIMESTAMP"), sortkeys=["ts"])
FIRST = dt.date(2014, 1, 1)


class Stopped(RuntimeError):
    pass


def day(n):
    return FIRST + dt.timedelta(days=n)


def marked(spark, mark, *numbers):
    return spark.createDataFrame([(n, mark, day(n)) for n in numbers], "id long, mark string, data_date date")


def seen(rows):
    return sorted((r.id, r.mark, r.data_date) for r in rows.collect())


@pytest.fixture
def catalog(spark, tmp_path):
    made = []

    def make(spec=IDS):
        made.append(f"t_{uuid.uuid4().hex[:12]}")
        found = day_tables.table_of(spark, made[-1], spec, str(tmp_path), "public")
        found.check()
        return found

    yield make
    for name in made:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_a_published_day_changes_as_a_whole(spark, catalog):
    stored = catalog()
    stored.replace(marked(spark, "old", 0, 1, 2))
    waiting = stored.write(marked(spark, "new", 1, 2, 3))
    assert seen(spark.table(stored.name)) == [(n, "old", day(n)) for n in range(3)]
    stored.publish(waiting, [day(0), day(2), day(9)])
    assert seen(spark.table(stored.name)) == [(n, "new", day(n)) for n in (1, 2, 3)]


def test_a_stop_between_two_days_leaves_each_whole(spark, catalog, monkeypatch):
    stored = catalog()
    stored.replace(marked(spark, "old", 0, 1))
    waiting, sql = stored.write(marked(spark, "new", 0, 1)), spark.sql

    def stop(text, *args, **options):
        if "SET LOCATION" in text and day(1).isoformat() in text:
            raise Stopped
        return sql(text, *args, **options)

    with monkeypatch.context() as patch:
        patch.setattr(spark, "sql", stop)
        with pytest.raises(Stopped):
            stored.publish(waiting)
    spark.catalog.refreshTable(stored.name)
    assert seen(spark.table(stored.name)) == [(0, "new", day(0)), (1, "old", day(1))]
    stored.publish(waiting)
    assert seen(spark.table(stored.name)) == [(0, "new", day(0)), (1, "new", day(1))]


def test_rows_without_a_day_and_rewrites_of_the_table_itself(spark, catalog):
    stored = catalog()
    rows = marked(spark, "a", 0, 1).unionByName(spark.createDataFrame([(7, "b", None)], "id long, mark string, data_date date"))
    stored.replace(rows)
    assert set(stored.days()) == {None, day(0), day(1)}
    retention.compact_days(stored)
    assert spark.table(stored.name).exceptAll(rows).isEmpty() and spark.table(stored.name).count() == 3
    stored.replace(rows.limit(0), [None])
    assert set(stored.days()) == {day(0), day(1)}


def test_sweep_removes_only_what_nothing_points_to(spark, catalog):
    stored = catalog()
    stored.replace(marked(spark, "old", 0, 1))
    stored.replace(marked(spark, "new", 1))
    stored.write(marked(spark, "lost", 5))
    assert stored.sweep() == []  # the time of grace
    assert len(stored.sweep(grace_seconds=-60)) == 2
    spark.catalog.refreshTable(stored.name)
    assert seen(spark.table(stored.name)) == [(0, "old", day(0)), (1, "new", day(1))]
    assert stored.sweep(grace_seconds=-60) == []


def test_catalog_tables_take_new_columns_and_refuse_others(spark, catalog, tmp_path):
    stored = catalog()
    stored.replace(marked(spark, "a", 0))
    grown = day_tables.CatalogTable(spark, stored.name, stored.folder, table(("id", "int8"), ("mark", "varchar(9)"), ("size", "int4 default 7")))
    grown.check()
    grown.replace(marked(spark, "b", 1).withColumn("size", F.lit(2)))
    assert sorted((r.id, r.size) for r in spark.table(stored.name).collect()) == [(0, 7), (1, 2)]
    with pytest.raises(SpecError):
        stored.check()


@pytest.mark.parametrize("stop_at", range(8))
def test_a_stopped_folder_swap_is_completed(spark, tmp_path, monkeypatch, stop_at):
    """Whatever call a load stops at: before the list of days is there, all is as it was; after it, the next load completes the swap."""
    folder = str(tmp_path / "t")
    sinks.write_table(marked(spark, "old", 0, 1, 2), folder)
    calls = [0]

    def stopping(real):
        def call(*args):
            calls[0] += 1
            if calls[0] > stop_at:
                raise Stopped
            return real(*args)
        return call

    with monkeypatch.context() as patch:
        for name in ("remove", "rename", "touch"):
            patch.setattr(files, name, stopping(getattr(files, name)))
        try:
            sinks.write_table(marked(spark, "new", 1, 2), folder, days=[day(0)])
        except Stopped:
            pass
    listed = files.glob(spark, f"{folder}/{sinks.INCOMING}*/{sinks.READY}")
    if not listed and calls[0] <= 1:
        assert seen(evolve.read_stored(spark, folder, IDS)) == [(n, "old", day(n)) for n in range(3)]
        sinks.finish_swaps(spark, folder, grace_seconds=-60)
        assert not files.glob(spark, f"{folder}/{sinks.INCOMING}*")
        assert seen(evolve.read_stored(spark, folder, IDS)) == [(n, "old", day(n)) for n in range(3)]
    else:
        sinks.finish_swaps(spark, folder)
        sinks.finish_swaps(spark, folder)
        assert seen(evolve.read_stored(spark, folder, IDS)) == [(1, "new", day(1)), (2, "new", day(2))]


def test_a_failed_load_does_not_claim_the_new_version(spark, tmp_path, monkeypatch):
    stored = day_tables.table_of(spark, "t", IDS, str(tmp_path))
    stored.check()
    stored.replace(marked(spark, "a", 0))
    grown = day_tables.table_of(spark, "t", table(("id", "int8"), ("mark", "varchar(9)"), ("size", "int4")), str(tmp_path))
    grown.check()
    with pytest.raises(Exception):
        grown.replace(marked(spark, "b", 1).withColumn("size", F.raise_error(F.lit("no")).cast("int")))
    assert evolve.remembered_spec(spark, f"{tmp_path}/t") == IDS


# --- claims


def test_of_many_claimants_one_gets_the_work(spark, tmp_path):
    held, most, lock = [0], [0], threading.Lock()

    def work(n):
        claim = claims.take(spark, f"{tmp_path}/work", attempts=3)
        if claim:
            with lock:
                held[0] += 1
                most[0] = max(most[0], held[0])
            time.sleep(0.05)
            with lock:
                held[0] -= 1
            claim.release()
        return claim is not None

    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(work, range(24)))
    assert most[0] <= 1 and claims.take(spark, f"{tmp_path}/work") is not None and isinstance(got[0], bool)


def test_claims_end(spark, tmp_path):
    now = [1000.0]
    first = claims.take(spark, f"{tmp_path}/w", 60, clock=lambda: now[0])
    assert first and claims.take(spark, f"{tmp_path}/w", 60, clock=lambda: now[0]) is None
    now[0] = 1061.0
    second = claims.take(spark, f"{tmp_path}/w", 60, clock=lambda: now[0])
    assert second and not files.exists(spark, first.path)
    second.release()
    assert claims.take(spark, f"{tmp_path}/w", 60, clock=lambda: now[0])


# --- runs over days

SPEC = parse_spec("""
version: 2
tables:
  seen: {src: '', src_type: dict, columns: [{log_key: id, sql_attr: int8}], sortkey_attr: []}
  tags: {src: tags, src_type: list, columns: [{log_key: value, name: tag, sql_attr: varchar(9)}], sortkey_attr: []}
""")


def day_files(tmp_path, *numbers, complete=True):
    for n in numbers:
        folder = tmp_path / "in" / f"{day(n):%Y/%m/%d}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / "part-0.json").write_text(json.dumps({"id": n, "tags": ["x"] * n}) + "\n")
        if complete:
            (folder / "COMPLETE").touch()


def run(spark, tmp_path, last, **options):
    got = days.run_days(spark, SPEC, [str(tmp_path / "in")], FIRST, day(last), f"{tmp_path}/stage", f"{tmp_path}/out", suffix="/part-*.json", **options)
    return [tuple(r)[:4] for r in got.collect()]


def runs(spark, tmp_path):
    found = ledger.run_rows(days.ledger_steps(spark, f"{tmp_path}/out/_ledger")).collect()
    return {(r.data_date - FIRST).days: (r.etl_status, r.et_starttime is not None, r.load_starttime is not None, r.etl_error) for r in found}


def test_a_stopped_run_resumes_at_the_next_day(spark, tmp_path, monkeypatch):
    day_files(tmp_path, 0, 1, 2)
    replace, calls = day_tables.FolderTable.replace, []

    def stop(self, rows, part=None):
        calls.append((self.name, part))
        if len(calls) == 5:  # second table of the second day
            raise Stopped
        return replace(self, rows, part)

    with monkeypatch.context() as patch:
        patch.setattr(day_tables.FolderTable, "replace", stop)
        with pytest.raises(Stopped):
            run(spark, tmp_path, 2, days_at_once=1)
    assert runs(spark, tmp_path) == {0: ("load_success", True, True, None), 1: ("load_started", True, True, None), 2: ("et_success", True, False, None)}
    again = run(spark, tmp_path, 2, days_at_once=1)
    assert [r for r in again if r[1] == "load"] == [
        (day(1), "load", "tags", "success"), (day(1), "load", "pipeline_errors", "success"),
        *[(day(2), "load", name, "success") for name in ("seen", "tags", "pipeline_errors")]]
    assert set(runs(spark, tmp_path).values()) == {("load_success", True, True, None)}
    counts = {(r.table_name, r.data_date): r.n_rows for r in days.loaded_counts(spark, SPEC, f"{tmp_path}/out").collect()}
    assert counts == {("seen", day(n)): 1 for n in range(3)} | {("tags", day(n)): n for n in (1, 2)}


def test_days_claimed_by_another_run_are_left_to_it(spark, tmp_path):
    day_files(tmp_path, 0, 1)
    other = claims.take(spark, f"{days.stage_of(f'{tmp_path}/stage', SPEC)}/claims/{day(1)}")
    first = run(spark, tmp_path, 1)
    assert (day(1), "et", None, "running") in first and (day(0), "load", "seen", "success") in first
    assert 1 not in {n for n, r in runs(spark, tmp_path).items() if r[0].startswith("et")}
    other.release()
    loading = claims.take(spark, f"{tmp_path}/out/_claims/load")
    assert [r for r in run(spark, tmp_path, 1) if r[1] == "load"] == []
    loading.release()
    assert (day(1), "load", "tags", "success") in run(spark, tmp_path, 1)


def test_claims_are_released_when_staging_fails(spark, tmp_path, monkeypatch):
    day_files(tmp_path, 0)
    monkeypatch.setattr(days, "write_stage", lambda *args: (_ for _ in ()).throw(Stopped()))
    with pytest.raises(Stopped):
        run(spark, tmp_path, 0)
    assert files.glob(spark, f"{days.stage_of(f'{tmp_path}/stage', SPEC)}/claims/*/*") == []
    assert runs(spark, tmp_path) == {0: ("et_started", True, False, None)}


def test_days_loaded_into_the_catalog(spark, tmp_path):
    day_files(tmp_path, 0, 1)
    space = f"s{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE NAMESPACE {space}")
    run(spark, tmp_path, 0, namespace=space)
    run(spark, tmp_path, 1, namespace=space)
    assert sorted(r.id for r in spark.table(f"{space}.seen").collect()) == [0, 1] and spark.table(f"{space}.tags").count() == 1
    assert spark.table(f"{space}.pipeline_errors").count() == 0
    spark.sql(f"DROP NAMESPACE {space} CASCADE")


# --- zone maps


def stored_events(spark, stored):
    rows = spark.range(40).select("id", F.when(F.col("id") != 39, F.timestamp_seconds(F.lit(1388534400) + F.col("id") * 6 * 3600)).alias("ts"))
    stored.check()
    stored.replace(rows.withColumn("data_date", F.to_date(F.coalesce("ts", F.lit("2014-01-05").cast("timestamp")))))


def spoil(spark, stored, days_of):
    """Make the files of days unreadable."""
    for at, where in stored.locations().items():
        if at in days_of:
            for path in files.glob(spark, f"{where}/part-*"):
                files.remove(spark, path)
                files.write_text(spark, path, "not a table")


@pytest.mark.parametrize("namespace", [None, "public"])
def test_retention_reads_only_the_days_at_the_cutoff(spark, tmp_path, namespace):
    stored = day_tables.table_of(spark, f"z_{uuid.uuid4().hex[:8]}", EVENTS, str(tmp_path), namespace)
    stored_events(spark, stored)
    zone = zones.read_zone(spark, stored.locations()[dt.date(2014, 1, 5)], "ts")
    assert (zone.rows, zone.undated, zone.first, zone.last) == (5, 1, dt.date(2014, 1, 5), dt.date(2014, 1, 5))
    at = dt.date(2014, 1, 5)  # old rows and one without a date
    spoil(spark, stored, set(stored.locations()) - {at})
    assert retention.delete_old_rows(stored, 3) == 24
    assert sorted(stored.locations()) == [at, *(dt.date(2014, 1, n) for n in range(7, 11))]
    assert stored.rows().where(F.col("data_date") == F.lit(at)).count() == 1
    assert retention.delete_old_rows(stored, 3) == 0


def test_recent_rows_read_only_recent_days(spark, tmp_path):
    stored = day_tables.table_of(spark, "z", EVENTS, str(tmp_path))
    stored_events(spark, stored)
    spoil(spark, stored, {dt.date(2014, 1, n) for n in (1, 2, 3, 4, 6)})
    got = retention.recent_rows(stored, 3).collect()
    assert sorted(r.id for r in got) == list(range(24, 40))
    assert len(retention.recent_rows(day_tables.table_of(spark, "none", EVENTS, str(tmp_path)), 3).collect()) == 0


def test_days_without_a_zone_are_measured(spark, tmp_path):
    stored = day_tables.table_of(spark, "z", EVENTS, str(tmp_path))
    stored_events(spark, stored)
    known = retention.day_zones(stored)
    for where in stored.locations().values():
        files.remove(spark, f"{where}/{zones.ZONE_FILE}")
    assert set(stored.zones().values()) == {None} and retention.day_zones(stored) == known
    assert retention.cutoff_of(known, 3) == dt.date(2014, 1, 7) and retention.cutoff_of(known, 9) is None and retention.cutoff_of({}, 1) is None
