"""Readers, day directories, dumps, scalar helpers."""

import datetime as dt
import gzip
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from logweir.functions import dates, text
from logweir.operators import days as day_runs
from logweir.operators.extract import extract_table
from logweir.operators.quarantine import error_rows
from logweir.plans.spec import SchemaSpec, TableSpec
from logweir.session import scale_settings, shared_folder, small_frame
from logweir.sources import days, dump, files, registry
from logweir.sources.lines import is_document

IDS = TableSpec.from_dict({"src": "", "src_type": "dict", "sortkey_attr": [], "columns": [
    {"log_key": "id", "sql_attr": "int8"}, {"name": "__source_filename__", "sql_attr": "varchar(999)", "is_derived": True}]})


def write_day(root, day, ids, marker=True, broken=False):
    folder = root / day
    folder.mkdir(parents=True)
    data = gzip.compress("".join(json.dumps({"id": i}) + "\n" for i in ids).encode())
    (folder / "part-0000.gz").write_bytes(data[:-12] if broken else data)
    if marker:
        (folder / "COMPLETE").touch()


def test_registry(spark, tmp_path):
    write_day(tmp_path, "2014/01/02", [1, 2])
    docs = registry.read_documents(spark, "json", f"{tmp_path}/2014/01/02/part-*.gz", days.DAY_IN_PATH)
    got = extract_table(docs, IDS).collect()
    assert sorted(r.id for r in got) == [1, 2]
    assert {r.data_date for r in got} == {dt.date(2014, 1, 2)}
    assert all(r["__source_filename__"].endswith("2014/01/02/part-0000.gz") for r in got)
    with pytest.raises(ValueError, match="unknown log format"):
        registry.read_documents(spark, "apache", "x")
    registry.register("twice", lambda s, p, d=None: registry.read_documents(s, "json", p, d))
    assert registry.read_documents(spark, "twice", str(tmp_path / "2014/01/02")).count() == 2


def test_markers_and_prefix_choice(spark, tmp_path):
    write_day(tmp_path / "a", "2014/01/01", [1])
    write_day(tmp_path / "b", "2014/01/01", [1])
    write_day(tmp_path / "b", "2014/01/02", [1])
    write_day(tmp_path / "a", "2014/01/03", [1], marker=False)
    a, b = f"{tmp_path}/a/", f"{tmp_path}/b"
    found = days.list_markers(spark, [a, b, f"{tmp_path}/none"])
    assert sorted((r.prefix[-2:].strip("/"), r.day.day) for r in found.collect()) == [("a", 1), ("b", 1), ("b", 2)]
    ranked = small_frame(spark, [(a, 0), (b, 1)], "prefix string, priority int")
    wanted = small_frame(spark, [(dt.date(2014, 1, d),) for d in (1, 2, 3)], "day date")
    chosen = days.first_complete_prefix(wanted, ranked, found)
    assert sorted(tuple(r) for r in chosen.collect() if r.prefix) == [(dt.date(2014, 1, 1), a), (dt.date(2014, 1, 2), b)]
    assert {r.prefix for r in days.first_complete_prefix(wanted, ranked, found, force=True).collect()} == {a}
    with pytest.raises(PySparkException, match="no complete prefix for 2014-01-03"):
        days.require_prefix(chosen).collect()
    pairs = wanted.select("day", F.lit(b).alias("prefix"))
    assert days.complete_days(pairs, found).count() == 2 and days.complete_days(pairs, found, force=True).count() == 3


@pytest.mark.parametrize("prefix, expected", [
    ("s3://bucket/logs/x/", "s3://bucket/logs/x/2014/07/01/part-*.gz"), ("s3://bucket//logs//x", "s3://bucket/logs/x/2014/07/01/part-*.gz"),
    ("/data/x/", "/data/x/2014/07/01/part-*.gz"),
])
def test_day_input(spark, prefix, expected):
    day = F.lit("2014-07-01").cast("date")
    assert spark.range(1).select(days.day_input(F.lit(prefix), day)).first()[0] == expected


def test_run_days(spark, tmp_path):
    """Day 2 has no marker: later days are extracted, only day 1 is loaded; a second run goes on from there."""
    for day, more in (("2014/01/01", {}), ("2014/01/02", {"marker": False}), ("2014/01/03", {})):
        write_day(tmp_path / "in", day, range(int(day[-1])), **more)
    spec = SchemaSpec({"ids": IDS})
    args = (spark, spec, [f"{tmp_path}/in"], dt.date(2014, 1, 3), dt.date(2014, 1, 1), f"{tmp_path}/stage", f"{tmp_path}/out")
    got = [tuple(r)[:4] for r in day_runs.run_days(*args).collect()]
    d1, d2, d3 = (dt.date(2014, 1, n) for n in (1, 2, 3))
    assert got == [(d1, "et", None, "success"), (d2, "et", None, "error"), (d3, "et", None, "success"), (d2, "load", None, "error"),
                   (d1, "load", "ids", "success"), (d1, "load", "pipeline_errors", "success")]
    assert [tuple(r) for r in day_runs.loaded_counts(spark, spec, f"{tmp_path}/out").collect()] == [(d1, "ids", 1)]
    files.touch(spark, f"{tmp_path}/in/2014/01/02/COMPLETE")
    again = [tuple(r)[:4] for r in day_runs.run_days(*args).collect()]
    assert {r[3] for r in again} == {"success"} and [r[0] for r in again if r[1:3] == ("load", "ids")] == [d2, d3]
    assert {r.step for r in day_runs.run_days(*args).collect()} == {"et"}  # nothing is left to load
    counts = day_runs.loaded_counts(spark, spec, f"{tmp_path}/out").collect()
    assert sorted(tuple(r) for r in counts) == [(d1, "ids", 1), (d2, "ids", 2), (d3, "ids", 3)]


def test_a_day_whose_data_stops_the_load(spark, tmp_path):
    """Day 2 fails in the load: day 1 is loaded, 2 is reported, 3 waits; a mended day goes on from there."""
    for n in (1, 2, 3):
        write_day(tmp_path / "in", f"2014/01/0{n}", range(n))
    spec = SchemaSpec({"ids": IDS})
    days, where = [dt.date(2014, 1, n) for n in (1, 2, 3)], (f"{tmp_path}/stage", f"{tmp_path}/out")
    day_runs.extract_days(spark, spec, [f"{tmp_path}/in"], days, where[0])
    broken = files.glob(spark, f"{day_runs.stage_of(where[0], spec)}/rows/table=ids/data_date=2014-01-02/part-*")[0]
    good = open(broken.removeprefix("file:"), "rb").read()
    files.remove(spark, broken)
    open(broken.removeprefix("file:"), "wb").write(b"no parquet at all")
    args = (spark, spec, [f"{tmp_path}/in"], days[0], days[2], *where)
    got = [(r.day.day, r.table_name, r.status) for r in day_runs.run_days(*args).where("step = 'load'").collect()]
    assert got == [(1, "ids", "success"), (1, "pipeline_errors", "success"), (2, "ids", "error")]
    assert day_runs.run_days(*args, retry_errors=False).where("step = 'load'").count() == 0
    open(broken.removeprefix("file:"), "wb").write(good)
    got = [(r.day.day, r.status) for r in day_runs.run_days(*args).where("step = 'load' AND table_name = 'ids'").collect()]
    assert got == [(2, "success"), (3, "success")]


@pytest.mark.parametrize("batches", [[[1], [2], [3], [4], [5]], [[1, 2], [3, 4, 5]], [[1, 2, 3, 4, 5]]])
def test_retention_while_loading(spark, tmp_path, batches):
    """However the days are batched, three days stay besides the one just loaded."""
    spec = SchemaSpec({"t": TableSpec.from_dict({"src": "", "src_type": "dict", "sortkey_attr": ["ts"], "columns": [
        {"log_key": "ts", "sql_attr": "TIMESTAMP"}, {"log_key": "id", "sql_attr": "int8"}]})})
    for n in range(1, 6):
        folder = tmp_path / f"in/2014/01/0{n}"
        folder.mkdir(parents=True)
        stamp = int(dt.datetime(2014, 1, n, 12, tzinfo=dt.timezone.utc).timestamp())
        (folder / "part-0.gz").write_bytes(gzip.compress(json.dumps({"ts": stamp, "id": n}).encode()))
        (folder / "COMPLETE").touch()
    for batch in batches:
        made = [dt.date(2014, 1, n) for n in batch]
        day_runs.extract_days(spark, spec, [f"{tmp_path}/in"], made, f"{tmp_path}/stage")
        got = day_runs.load_days(spark, spec, made, f"{tmp_path}/stage", f"{tmp_path}/out", 3, dt.date(2014, 1, 4))
        assert {r[3] for r in got} == {"success"}
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/out/t").collect()) == [2, 3, 4, 5]


def test_one_unreadable_day_does_not_fail_the_others(spark, tmp_path):
    for n in (1, 2, 3):
        write_day(tmp_path / "in", f"2014/01/0{n}", range(5000), broken=n == 2)
    (tmp_path / "in/2014/01/04").mkdir()
    (tmp_path / "in/2014/01/04/COMPLETE").touch()
    wanted = day_runs.day_list(dt.date(2014, 1, 1), dt.date(2014, 1, 4))
    got = day_runs.extract_days(spark, SchemaSpec({"ids": IDS}), [f"{tmp_path}/in"], wanted, f"{tmp_path}/stage")
    assert [r[3] for r in got] == ["success", "error", "success", "error"]
    assert got[3][4] == "no input files"


def test_day_list():
    assert [d.day for d in day_runs.day_list(dt.date(2014, 1, 9), dt.date(2014, 1, 1), 3)] == [1, 4, 7]


@pytest.mark.parametrize("line, row", [
    (r"INSERT INTO `t` (`a`, `b`) VALUES (1, 'it\'s, (x)');", ("1", "it's, (x)")),
    (r"INSERT INTO t (a,b) VALUES (-1.5e3,'it''s');", ("-1.5e3", "it's")),
    (r"insert into t (a, b) values (NULL, '\\\'\n\t\0')", (None, "\\'\n\t\x00")),
    (r"INSERT INTO t (a, b) VALUES ('NULL', '');", ("NULL", "")),
    (r"INSERT INTO t (a, b) VALUES ('a\\', 'b');", ("a\\", "b")),
    (r"INSERT INTO t (a, b) VALUES (1);", None), ("DROP TABLE t;", None), ("", None),
])
def test_insert_lines(spark, line, row):
    t = TableSpec.from_dict({"src": "", "src_type": "dict", "sortkey_attr": [], "columns": [
        {"log_key": "a", "sql_attr": "text"}, {"log_key": "b", "sql_attr": "text"}]})
    docs = dump.parse_inserts(spark.createDataFrame([(line,)], "value string"))
    assert [tuple(r) for r in extract_table(docs, t).collect()] == ([row] if row else [])
    assert error_rows(docs, SchemaSpec({"t": t})).count() == (0 if row else 1)


def test_long_insert(spark):
    body = "a'\\,(" * 100_000
    quoted = body.replace("\\", "\\\\").replace("'", "\\'")
    docs = dump.parse_inserts(spark.createDataFrame([(f"INSERT INTO t (a, b) VALUES ('{quoted}', 1);",)], "value string"))
    t = TableSpec.from_dict({"src": "", "src_type": "dict", "sortkey_attr": [], "columns": [{"log_key": "a", "sql_attr": "text"}]})
    assert docs.where(is_document(F.col("doc"))).count() == 1
    assert extract_table(docs, t).first()[0] == body


@pytest.mark.parametrize("given, expected", [
    ("2014-07-01", "2014/07/01"), ("2014-7-1", "2014/07/01"), ("yesterday", "2014/12/31"), ("twodaysago", "2014/12/30"),
    ("2014/07/01", None), ("2014-02-30", None), ("", None), (None, None), ("2014-07-01 10:00", None),
])
def test_day_path(spark, given, expected):
    today = F.lit("2015-01-01").cast("date")
    assert spark.range(1).select(dates.day_path(F.lit(given).cast("string"), today)).first()[0] == expected


@pytest.mark.parametrize("a, b, low, high", [
    ("2014-01-01", "2014-02-01", "2014-01-01", "2014-02-01"), (None, "2014-01-01", "2014-01-01", "2014-01-01"),
    ("2014-01-01", "", "2014-01-01", "2014-01-01"), (None, None, None, None), ("", None, None, None),
])
def test_earlier_and_later(spark, a, b, low, high):
    a, b = F.lit(a).cast("string"), F.lit(b).cast("string")
    assert tuple(spark.range(1).select(dates.earlier(a, b), dates.later(a, b)).first()) == (low, high)


def test_ranges(spark):
    a, b = F.lit("2014-01-01").cast("date"), F.lit("2014-01-08").cast("date")
    got = spark.range(1).select(
        F.size(dates.day_range(a, b, 3)), F.size(dates.day_range(b, a)), F.size(dates.stepper_range(b, a)),
        dates.day_count(a, b), dates.next_day(b, 2).cast("string"), dates.is_saturday(F.lit("2014-01-04").cast("date")),
    ).first()
    assert tuple(got) == (3, 0, 8, 8, "2014-01-10", True)


@pytest.mark.parametrize("delay, arguments, known, expected", [
    (None, "{}", None, "2014-12-30"), ("00:00", "{}", None, "2015-01-01"), ("10:31", None, None, "2014-12-31"),
    ("10:30", "{}", None, "2015-01-01"), ("48:00", '{"time_log_need_to_be_available": "24:00"}', None, "2014-12-31"),
    ("48:00", "{}", "2014-06-01", "2014-06-01"),
])
def test_ready_day(spark, delay, arguments, known, expected):
    now = F.lit("2015-01-01 10:30:00").cast("timestamp")
    ready = dates.ready_day(now, F.lit(delay).cast("string"), F.lit(arguments).cast("string"), F.lit(known).cast("date"))
    assert spark.range(1).select(ready.cast("string")).first()[0] == expected


def test_storage_paths(spark):
    p = spark.createDataFrame([("s3://b/logs/x/",), ("s3://b/logs/y",), ("s3://b/",), ("/local/x",)], "p string")
    got = p.select(text.storage_bucket(F.col("p")), text.storage_key(F.col("p")), text.log_name_of_path(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [("b", "logs/x/", "x"), ("b", "logs/y", "y"), ("b", "", None), (None, None, None)]


def test_text_helpers(spark):
    one = spark.range(1)
    assert one.select(text.column_name_of_key(F.lit("..a.b"))).first()[0] == "a_b"
    assert one.select(F.length(text.short_message(F.lit("x" * 300)))).first()[0] == 256
    with pytest.raises(PySparkException, match="does not fit"):
        one.select(text.checked_identity(F.lit("x" * 257))).collect()
    key = [F.lit(x) for x in ("c1", "log", "v1", "2014-01-01")]
    assert one.select(text.job_key(*key, F.lit(None))).first()[0] == "c1:log:v1:2014-01-01:None"
    assert [one.select(text.checked_arguments(F.lit(x).cast("string"))).first()[0] for x in ("", " \n", None, ' {"a": 1} ')] == ["{}", "{}", "{}", '{"a": 1}']
    for bad in ("{", '{"a":1}}', "a"):
        with pytest.raises(PySparkException, match="no JSON"):
            one.select(text.checked_arguments(F.lit(bad))).collect()
    assert [one.select(text.is_plain_name(F.lit(x))).first()[0] for x in ("ad_click", "a-b", "")] == [True, False, False]


def test_settings(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scale_settings(2**40, 100)["spark.sql.shuffle.partitions"] == "8192"
    assert scale_settings(10, 100)["spark.sql.shuffle.partitions"] == "200"
