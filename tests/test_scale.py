"""Plan shape and skew: what must hold when the data is large."""

import hashlib
import re
import uuid

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from logweir.catalogue import fixtures as fx
from logweir.catalogue.queries import QUERIES
from logweir.operators import day_tables, ledger, lookup, sinks
from logweir.operators.extract import extract_tables
from logweir.plans.spec import SchemaSpec, TableSpec
from logweir.sources import files
from logweir.sources.lines import parse_lines, read_lines
from logweir.sources.registry import read_documents
from conftest import SMALL


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


NARROW = [
    "extract_dict", "extract_list", "extract_sparse_list", "extract_list_of_scalars", "extract_null_vs_absent", "extract_mandatory",
    "extract_mandatory_quarantine", "extract_json_blob", "extract_derived", "quarantine_bad_lines", "good_lines", "psv_lines",
    "psv_roundtrip", "insert_dump_text", "truncate_columns", "stuck_rows", "retry_due", "retry_plan", "display_status",
]


@pytest.mark.parametrize("name", NARROW)
def test_no_shuffle_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "Exchange" not in text and "Python" not in text and "Pandas" not in text


def test_a_checked_list_is_taken_out_once(spark):
    table = TableSpec.from_dict({"src": "line.charges", "src_type": "list", "sortkey_attr": [], "columns": [
        {"log_key": "kind", "sql_attr": "varchar(16)", "is_mandatory": True}, {"log_key": "amount", "sql_attr": "float8"}]})
    rows = extract_tables(fx.line_docs(spark, SMALL), SchemaSpec({"charges": table}))["charges"]
    assert plan(rows).count("ArrayType(VariantType") == 1 and rows.count() == 4 * fx.table(spark, SMALL, "lineitem").count()


@pytest.mark.parametrize("name", ["extract_dict", "extract_list", "extract_mandatory", "extract_mandatory_quarantine", "good_lines"])
def test_each_line_is_parsed_once(spark, name):
    assert plan(QUERIES[name](spark, SMALL)).count("parseJson") == 1


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_no_cross_join_and_no_gathering_of_rows(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # one partition may only hold the merged result of a global aggregate
    for block in re.split(r"Exchange SinglePartition", text)[1:]:
        assert "Aggregate" in block.splitlines()[1], block[:300]
    if name not in ("versions_by_name",):
        assert "collect_list" not in text


def test_parents_are_not_broadcast(spark):
    assert "BroadcastHashJoin" not in plan(QUERIES["reassemble_parent_child"](spark, SMALL))


def test_only_needed_columns_are_read(spark):
    text = plan(QUERIES["extract_dict"](spark, SMALL))
    assert "o_orderpriority" in text
    narrow = plan(fx.table(spark, SMALL, "lineitem").select("l_orderkey").where("l_orderkey > 5"))
    assert "ReadSchema: struct<l_orderkey:bigint>" in narrow and "GreaterThan(l_orderkey,5)" in narrow


def test_staged_table_reads_only_its_own_column(spark):
    tables = sinks.staged_tables(fx.line_docs(spark, SMALL), fx.spec(fx.LINES_SPEC))
    text = plan(tables["lines"].select("part"))
    assert re.search(r"ReadSchema: struct<lines:struct<part:bigint>>", text), text[-400:]


def test_retention_filter_reaches_the_scan(spark, tmp_path):
    from logweir.operators.retention import keep_recent

    fx.events(spark, SMALL).select("event_id", "ts").write.parquet(str(tmp_path / "e"))
    text = plan(keep_recent(spark.read.parquet(str(tmp_path / "e")), "ts", 7))
    assert re.search(r"DataFilters: \[.*ts#\d+ >= Subquery", text), text


def test_writing_fanned_lines_does_not_sort(spark):
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "32"


def test_fanned_documents_are_walked_once(spark):
    both = fx.spec(fx.LINES_SPEC)
    for fan_out in (sinks.psv_fan_out, sinks.typed_fan_out):
        text = plan(fan_out(fx.line_docs(spark, SMALL), both))
        assert "ArrayType(VariantType" not in text and "['ship_time']" not in text and "['part']" not in text


def test_whole_numbers_of_a_document_are_read_once(spark):
    both = fx.spec(fx.LINES_SPEC)
    for fan_out in (sinks.psv_fan_out, sinks.typed_fan_out):
        text = plan(fan_out(fx.line_docs(spark, SMALL), both))
        casts = [len(re.findall(rf"{key}(?:#\d+)?, \$, StringType", text)) for key in ("order_id", "part", "number")]
        assert casts == [1, 1, 1] and "SchemaOfVariant" not in text


def test_staged_times_are_whole_numbers(spark, tmp_path):
    folder = f"{tmp_path}/stage"
    sinks.write_stage(fx.line_docs(spark, SMALL), fx.spec(fx.LINES_SPEC), folder)
    for name in ("lines", "charges"):
        file = next((tmp_path / "stage" / f"table={name}").glob("*.parquet"))
        columns = pq.ParquetFile(file).schema
        kinds = {columns.column(i).path: columns.column(i).physical_type for i in range(len(columns))}
        assert kinds[f"{name}.ship_time"] == "INT64"


def test_fanned_lines_are_packed_fast(spark, tmp_path):
    fanned = sinks.psv_fan_out(fx.line_docs(spark, SMALL), fx.spec(fx.LINES_SPEC))
    sinks.write_psv(fanned, f"{tmp_path}/fast")
    sinks.write_psv(fanned, f"{tmp_path}/small", level="DEFAULT_COMPRESSION")
    assert files.size(spark, f"{tmp_path}/fast") > files.size(spark, f"{tmp_path}/small")
    fast, small = (spark.read.text(f"{tmp_path}/{name}") for name in ("fast", "small"))
    assert fast.exceptAll(small).isEmpty() and fast.count() == small.count() > 0


def test_hot_dist_key_is_split_over_files(spark, tmp_path):
    """A third of the rows on one key: the layout must not put them all into one task."""
    table = TableSpec.from_dict({"src": "", "src_type": "dict", "sortkey_attr": ["v"], "columns": [
        {"log_key": "k", "sql_attr": "int8 distkey"}, {"log_key": "v", "sql_attr": "int8"}, {"log_key": "pad", "sql_attr": "text"}]})
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).cast("bigint").alias("k"), F.col("id").alias("v"),
        F.sha2(F.col("id").cast("string"), 512).alias("pad"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "300kb")
    try:
        sinks.write_table(rows, str(tmp_path / "t"), table)
    finally:
        spark.conf.set(key, before)
    stored = spark.read.parquet(str(tmp_path / "t"))
    per_file = stored.where("k = 7").groupBy(F.input_file_name()).count().collect()
    assert len(per_file) > 3 and max(r["count"] for r in per_file) < 15_000
    assert stored.count() == 60_000


def test_many_days_are_not_scattered_over_all_files(spark, tmp_path):
    table = TableSpec.from_dict({"src": "", "src_type": "dict", "sortkey_attr": ["v"], "columns": [
        {"log_key": "k", "sql_attr": "int8 distkey"}, {"log_key": "v", "sql_attr": "int8"}]})
    rows = spark.range(20_000).select(
        (F.col("id") % 500).alias("k"), F.col("id").alias("v"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 30).cast("int")).alias("data_date"))
    sinks.write_table(rows, str(tmp_path / "t"), table)
    assert len(files.glob(spark, f"{tmp_path}/t/data_date=*/part-*")) == 30
    assert spark.read.parquet(str(tmp_path / "t")).agg(F.sum("v")).first()[0] == sum(range(20_000))


def test_hot_job_gives_the_same_answers(spark):
    """One job owns most events; results are those of a plain walk, and no window runs over a whole job."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 10 < 8, 1).otherwise(F.col("id") % 50).cast("int").alias("job_id"),
        F.element_at(F.array(*[F.lit(s) for s in ledger.LEGAL_TRANSITIONS]), (F.col("id") * 7 % 8 + 1).cast("int")).alias("status"),
        F.timestamp_seconds(F.lit(1388534400) + F.col("id") * 3).alias("at"), F.col("id").alias("n"))
    got = ledger.transitions(rows, ["at", "n"]).groupBy("job_id").count()
    want = rows.groupBy("job_id").count()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    newest = ledger.latest_per_key(rows, ["job_id"], ["at", "n"])
    assert newest.where("job_id = 1").first().n == 29_997


def test_slots_are_cut_until_none_is_too_large(spark, monkeypatch):
    """A burst, a job without an id, and many events of one instant, which can't be cut by time."""
    monkeypatch.setattr(ledger, "SLOT_ROWS", 40)
    monkeypatch.setattr(ledger, "CUTS", 3)
    kinds = F.element_at(F.array(*[F.lit(k) for k in ledger.LEGAL_TRANSITIONS]), (F.col("id") * 7 % 8 + 1).cast("int"))
    burst = F.when(F.col("id") % 3 == 0, F.lit(5000)).when(F.col("id") < 900, 5000 + F.col("id") % 7).otherwise(F.col("id") * 100)
    job = F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 11 < 9, 1).otherwise(F.col("id") % 5)
    rows = spark.range(1500).select(job.cast("int").alias("job_id"), kinds.alias("status"), F.timestamp_seconds(burst).alias("at"), F.col("id").alias("n"))
    slots = ledger._slots(rows, "at").groupBy("job_id", "_slot").agg(F.count("*").alias("n"), F.min("at").alias("low"), F.max("at").alias("high")).collect()
    assert all(r["n"] <= 40 or r["low"] == r["high"] for r in slots) and sum(r["n"] for r in slots) == 1500
    for a in slots:  # slots are in the order of time
        assert all(a["high"] < b["low"] for b in slots if a["job_id"] == b["job_id"] and a["_slot"] < b["_slot"])
    got = sorted((str(r["job_id"]), r["n"], r["from_status"], r["to_status"]) for r in ledger.transitions(rows, ["at", "n"]).collect())
    want, last = [], {}
    for r in sorted(rows.collect(), key=lambda r: (r["at"], r["n"])):
        want.append((str(r["job_id"]), r["n"], last.get(r["job_id"], "null"), r["status"]))
        last[r["job_id"]] = r["status"]
    assert got == sorted(want)


def scanned_rows(frame):
    """Rows that the scans of a frame have put out."""
    frame.collect()
    found, todo = 0, [frame._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            found += node.metrics().apply("numOutputRows").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_lookups_skip_row_groups(spark, tmp_path):
    """Ids lie in all files and between the same bounds, so only the Bloom filters can tell."""
    rows = spark.range(40_000).select(F.sha2(F.col("id").cast("string"), 256).alias("job_id"), (F.col("id") % 9).alias("kind"), "id")
    plain, indexed = str(tmp_path / "plain"), str(tmp_path / "indexed")
    rows.repartition(16, "id").write.parquet(plain)
    lookup.write_indexed(rows.repartition(16, "id"), indexed, ["job_id", "id"], {"id": 4000})
    wanted = hashlib.sha256(b"77").hexdigest()
    assert [r["id"] for r in lookup.find(spark, indexed, rows.schema, job_id=wanted).collect()] == [77]
    assert scanned_rows(lookup.find(spark, indexed, rows.schema, job_id=wanted)) < 8_000 < scanned_rows(lookup.find(spark, plain, rows.schema, job_id=wanted))
    assert scanned_rows(lookup.find(spark, indexed, rows.schema, id=[5, 6])) < 12_000
    assert lookup.find(spark, indexed, rows.schema, job_id=None).count() == 0 and lookup.find(spark, indexed, rows.schema, kind=3, id=3).count() == 1
    with pytest.raises(ValueError, match="no such columns: x"):
        lookup.write_indexed(rows, indexed, ["x"])


def test_tables_in_buckets_are_joined_where_they_lie(spark, tmp_path):
    name = f"b_{uuid.uuid4().hex[:8]}"
    found = QUERIES["reassemble_stored"](spark, SMALL)
    assert "Exchange" not in plan(found) and "SortMergeJoin" in plan(found)
    table = TableSpec.from_dict({"src": "", "src_type": "dict", "sortkey_attr": [], "columns": [{"log_key": "k", "sql_attr": "int8 distkey"}, {"log_key": "v", "sql_attr": "int8"}]})
    stored = day_tables.table_of(spark, name, table, str(tmp_path), "public", buckets=4)
    stored.check()
    rows = spark.range(1000).selectExpr("id % 50 AS k", "id AS v", "date_add(date'2024-01-01', CAST(id % 3 AS INT)) AS data_date")
    stored.replace(rows)
    stored.replace(rows.where("data_date = date'2024-01-02'").withColumn("v", F.lit(0).cast("long")))  # a day published again
    counted = spark.table(name).groupBy("k").agg(F.count("*").alias("n"), F.sum("v").alias("v"))
    assert "Exchange" not in plan(counted)
    assert (counted.count(), spark.table(name).count()) == (50, 1000) and counted.agg(F.sum("v")).first()[0] == sum(n for n in range(1000) if n % 3 != 1)
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(name)] == [name]
    spark.sql(f"DROP TABLE {name}")


def test_buckets_grow_with_the_input(spark, monkeypatch):
    monkeypatch.setattr(day_tables, "BUCKET_BYTES", files.size(spark, f"{SMALL}/lineitem.parquet") // 20 + 1)
    assert "SelectedBucketsCount: 20 out of 20" in plan(QUERIES["reassemble_stored"](spark, SMALL))


def test_lines_of_one_file_are_spread_before_they_are_parsed(spark, tmp_path):
    (tmp_path / "one.json").write_text("".join(f'{{"order": {{"id": {n}}}}}\n' for n in range(500)))
    docs = read_documents(spark, "json", f"{tmp_path}/one.json", spread=6)
    rows = extract_tables(docs, fx.spec(fx.ORDERS_SPEC))["orders"]
    text = plan(rows)
    assert text.index("parse_json" if "parse_json" in text else "parseJson") < text.index("RoundRobinPartitioning(6)")
    assert rows.select(F.spark_partition_id()).distinct().count() == 6 and rows.count() == 500
    assert "Exchange" not in plan(read_documents(spark, "json", f"{tmp_path}/one.json"))


def test_file_scan_reads_day_folders_once(spark, tmp_path):
    (tmp_path / "2014/01/01").mkdir(parents=True)
    (tmp_path / "2014/01/01/part-0").write_text('{"order": {"id": 1}}\n')
    lines = read_lines(spark, f"{tmp_path}/*/*/*/part-*", r"(\d{4})/(\d{2})/(\d{2})")
    text = plan(extract_tables(parse_lines(lines), fx.spec(fx.ORDERS_SPEC))["orders"])
    assert text.count("Scan text") == 1 and "Exchange" not in text
    assert files.glob(spark, f"{tmp_path}/nothing/*") == []
