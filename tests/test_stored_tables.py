"""Evolution, checks, layout, retention, compaction."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from logweir.operators import evolve, retention, sinks
from logweir.plans.spec import SchemaSpec, SpecError, TableSpec
from logweir.sources import files
from logweir.sources.lines import parse_lines


def table(*columns, sortkeys=()):
    return TableSpec.from_dict({"src": "", "src_type": "dict", "sortkey_attr": list(sortkeys),
                                "columns": [{"log_key": n, "sql_attr": a} for n, a in columns]})


V1 = table(("id", "int8 not null"), ("name", "varchar(9)"))


def test_added_columns():
    grown = table(("id", "int8 not null"), ("name", "varchar(9)"), ("size", "int4 default 7"))
    assert [c.out_name for c in evolve.added_columns("t", V1, grown)] == ["size"]
    assert evolve.added_columns("t", V1, V1) == []


@pytest.mark.parametrize("wanted", [
    table(("id", "int8 not null")), table(("name", "varchar(9)"), ("id", "int8 not null")), table(("id", "int4 not null"), ("name", "varchar(9)")),
    table(("id", "int8"), ("name", "varchar(9)")), table(("id", "int8 not null"), ("name", "varchar(10)")),
    table(("id", "int8 not null"), ("name", "varchar(9)"), ("x", "int8 distkey")),
    table(("id", "int8 not null"), ("name", "varchar(9)"), ("x", "int8"), sortkeys=["x"]), table(("id", "int8 not null"), ("name", "varchar(9)"), sortkeys=["id"]),
])
def test_changes_that_are_refused(wanted):
    with pytest.raises(SpecError):
        evolve.added_columns("t", V1, wanted)


def test_catalog_tables(spark):
    first = SchemaSpec({"evo": V1})
    assert evolve.evolve_tables(spark, first)["evo"] == ["id", "name"]
    spark.sql("INSERT INTO evo VALUES (1, 'a', date'2014-01-01')")
    grown = table(("id", "int8 not null"), ("name", "varchar(9)"), ("size", "int4 default 7"), ("note", "varchar(3)"))
    assert evolve.evolve_tables(spark, SchemaSpec({"evo": grown})) == {"evo": ["size", "note"], "pipeline_errors": []}
    spark.sql("INSERT INTO evo (id, name, size, note, data_date) VALUES (2, 'b', NULL, 'n', date'2014-01-02')")
    assert sorted(map(tuple, spark.table("evo").select("id", "size", "note").collect())) == [(1, 7, None), (2, None, "n")]
    assert evolve.evolve_tables(spark, SchemaSpec({"evo": grown}))["evo"] == []
    with pytest.raises(SpecError, match="missing from"):
        evolve.evolve_tables(spark, first)
    with pytest.raises(SpecError, match="differs from"):
        evolve.evolve_tables(spark, SchemaSpec({"evo": table(("id", "int4"), ("name", "varchar(9)"), ("size", "int4"), ("note", "varchar(3)"))}))
    retention.analyze(spark, ["evo"])
    with pytest.raises(RuntimeError, match="1 tables: no_such"):
        retention.analyze(spark, ["no_such", "evo"])


def test_loaded_folders_as_evolving_catalog_tables(spark, tmp_path):
    """Old days get the default of a column added later, through the catalog, without being rewritten."""
    def load(day, spec, *values):
        lines = spark.createDataFrame([(json.dumps(v),) for v in values], "value string")
        docs = parse_lines(lines.withColumn("data_date", F.lit(day).cast("date")))
        assert {r["status"] for r in sinks.load_tables(docs, spec, str(tmp_path))} == {"success"}
        evolve.publish_days(spark, spec)

    first = SchemaSpec({"visits": table(("id", "int8"), ("name", "varchar(9)"))})
    grown = SchemaSpec({"visits": table(("id", "int8"), ("name", "varchar(9)"), ("size", "int4 default 7"))})
    evolve.evolve_tables(spark, first, root=str(tmp_path))
    load("2014-01-01", first, {"id": 1, "name": "a"}, {"id": 2})
    evolve.evolve_tables(spark, grown, root=str(tmp_path))
    load("2014-01-02", grown, {"id": 3, "size": 5}, {"id": 4})
    got = spark.table("visits").select("id", "name", "size", F.dayofmonth("data_date")).collect()
    assert sorted(map(tuple, got)) == [(1, "a", 7, 1), (2, None, 7, 1), (3, None, 5, 2), (4, None, None, 2)]
    evolve.require_columns({"visits": spark.table("visits").drop("data_date")}, grown, spark)


def test_checks(spark):
    stored = {"t": spark.createDataFrame([(1, "a")], "ID bigint, extra string"), "u": spark.createDataFrame([], "id bigint, name string")}
    spec = SchemaSpec({"t": V1, "u": V1})
    assert sorted(map(tuple, evolve.column_diff(stored, spec, spark).collect())) == [("t", "extra", "store"), ("t", "name", "spec")]
    with pytest.raises(ValueError, match="columns differ"):
        evolve.require_columns(stored, spec, spark)
    assert sorted(map(tuple, evolve.row_presence(stored).collect())) == [("t", 1, True), ("u", 0, False)]
    with pytest.raises(ValueError, match="without rows: u"):
        evolve.require_rows(stored)


EVENTS = table(("id", "int8"), ("ts", "TIMESTAMP"), sortkeys=["ts"])


def stored_events(spark, folder, days_late=0):
    rows = spark.range(40).select(
        "id", F.when(F.col("id") != 39, F.timestamp_seconds(F.lit(1388534400) + F.col("id") * 6 * 3600)).alias("ts"))
    rows = rows.withColumn("data_date", F.date_add(F.to_date(F.coalesce("ts", F.lit("2014-01-01").cast("timestamp"))), days_late))
    sinks.write_table(rows, folder, EVENTS)


@pytest.mark.parametrize("ttl, deleted", [(100, 0), (9, 0), (8, 4), (3, 24), (0, 36), (None, 0)])
def test_delete_old(spark, tmp_path, ttl, deleted):
    folder = str(tmp_path / "t")
    stored_events(spark, folder)
    kept = retention.keep_recent(spark.read.parquet(folder), "ts", ttl).count() if ttl is not None else 40
    assert retention.delete_old(spark, folder, EVENTS, ttl) == deleted
    left = spark.read.parquet(folder)
    assert left.count() == kept == 40 - deleted
    assert left.where("ts is null").count() == 1


def test_whole_days_are_dropped_and_only_the_mixed_day_is_rewritten(spark, tmp_path):
    folder = str(tmp_path / "t")
    stored_events(spark, folder)
    before = {p: files.glob(spark, p + "/part-*") for p in files.glob(spark, folder + "/data_date=*")}
    retention.delete_old(spark, folder, EVENTS, 3)
    after = {p: files.glob(spark, p + "/part-*") for p in files.glob(spark, folder + "/data_date=*")}
    # 2014-01-01 keeps its row without a time stamp, 02..06 are gone, later ones are untouched
    assert [p[-2:] for p in after] == ["01", "07", "08", "09", "10"]
    assert all(after[p] == before[p] for p in after if not p.endswith("01"))
    assert retention.delete_old(spark, folder, EVENTS, 3) == 0


def test_retention_column():
    assert retention.retention_column(EVENTS) == "ts"
    assert retention.retention_column(table(("d", "date"), ("x", "int8"), sortkeys=["d", "x"])) == "d"
    assert retention.retention_column(table(("x", "int8"), sortkeys=["x"])) is None
    with pytest.raises(ValueError, match="several"):
        retention.retention_column(table(("a", "TIMESTAMP"), ("b", "timestamp"), sortkeys=["a", "b"]))


def test_rerun_of_a_day_replaces_only_that_day(spark, tmp_path):
    folder = str(tmp_path / "t")
    day = lambda d, n: spark.range(n).select("id", F.lit(d).cast("date").alias("data_date"))
    sinks.write_table(day("2014-01-01", 3).unionByName(day("2014-01-02", 4)), folder)
    sinks.write_table(day("2014-01-02", 1), folder, days=[dt.date(2014, 1, 2), dt.date(2014, 1, 3)])
    counts = spark.read.parquet(folder).groupBy("data_date").count().collect()
    assert sorted((r.data_date.day, r["count"]) for r in counts) == [(1, 3), (2, 1)]


def test_a_day_without_rows_has_none_after_a_rerun(spark, tmp_path):
    folder, first = str(tmp_path / "t"), dt.date(2014, 1, 1)
    rows = spark.range(3).select("id", F.lit(first).alias("data_date"))
    sinks.write_table(rows, folder)
    sinks.write_table(rows.limit(0), folder, days=[first])
    assert evolve.read_stored(spark, folder, table(("id", "int8"))).count() == 0


def test_columns_survive_rewrites_of_days_of_two_versions(spark, tmp_path):
    folder = str(tmp_path / "t")
    old, new = table(("id", "int8")), table(("id", "int8"), ("x", "int4 default 7"), ("y", "varchar(3)"))
    sinks.write_table(spark.range(2).select("id", F.lit("2014-01-01").cast("date").alias("data_date")), folder, old)
    sinks.write_table(spark.range(2, 4).selectExpr("id", "int(nullif(id, 3)) AS x", "'b' AS y", "date'2014-01-02' AS data_date"), folder, new)
    want = [(0, 7, None), (1, 7, None), (2, 2, "b"), (3, None, "b")]
    for _ in range(2):
        assert sorted(map(tuple, evolve.read_stored(spark, folder, new).select("id", "x", "y").collect())) == want
        retention.compact(spark, folder, new)
    assert sorted(map(tuple, spark.read.parquet(folder).select("id", "x", "y").collect())) == want


def test_loads_are_reconciled_with_the_stored_spec(spark, tmp_path):
    folder, grown = str(tmp_path), table(("id", "int8 not null"), ("name", "varchar(9)"), ("size", "int4 default 7"))
    assert len(evolve.reconcile(spark, "t", folder, V1)) == 2 and evolve.reconcile(spark, "t", folder, V1) == []
    assert [c.out_name for c in evolve.reconcile(spark, "t", folder, grown)] == ["size"]
    with pytest.raises(SpecError, match="missing from"):
        evolve.reconcile(spark, "t", folder, V1)
    assert evolve.remembered_spec(spark, folder) == grown


def test_compact(spark, tmp_path):
    folder = str(tmp_path / "t")
    sinks.write_table(spark.range(1000).repartition(8).select("id", F.lit("2014-01-01").cast("date").alias("data_date")), folder)
    plain = table(("id", "int8"))
    assert len(files.glob(spark, folder + "/*/part-*")) == 8
    retention.compact(spark, folder, plain, [dt.date(2014, 1, 1)])
    assert len(files.glob(spark, folder + "/*/part-*")) == 1
    assert spark.read.parquet(folder).agg(F.sum("id")).first()[0] == 499500
