"""One query per operator; each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.catalogue import fixtures as fx
from logweir.functions import dates, text
from logweir.operators import checks, claims, day_tables, days as day_runs, evolve, infer, ledger, lookup, retention, sinks
from logweir.operators.extract import extract_table, extract_tables
from logweir.operators.quarantine import error_rows
from logweir.plans.spec import SchemaSpec, parse_spec
from logweir.session import fresh_folder, small_frame, stored
from logweir.sources import days, dump, files, psv
from logweir.sources.lines import document, parse_lines, read_lines
from logweir.sources.registry import read_documents
from logweir.streaming import audit, daily, ingest, ready

QUERIES = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


def shown(column: str) -> Column:
    """A timestamp as text, so that engines agree on its form."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def fixed_now() -> Column:
    return F.lit(fx.NOW).cast("timestamp")


def _orders(rows: DataFrame) -> DataFrame:
    return rows.select("id", "customer", shown("start_time"), "status", "total", "agent")


def _charges(rows: DataFrame) -> DataFrame:
    return rows.select("index", "kind", "amount", "order_id", "number", shown("ship_time"))


# -- extraction --------------------------------------------------------------------------------------

@query
def extract_dict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(extract_tables(fx.order_docs(spark, sf_dir), fx.spec(fx.ORDERS_SPEC))["orders"])


@query
def extract_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _charges(extract_tables(fx.line_docs(spark, sf_dir), fx.spec(fx.LINES_SPEC))["charges"])


@query
def extract_sparse_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _charges(extract_tables(fx.line_docs(spark, sf_dir, sparse=True), fx.spec(fx.SPARSE_SPEC))["charges"])


@query
def extract_list_of_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_tables(fx.text_docs(spark, sf_dir), fx.spec(fx.TEXT_LINES_SPEC))["text_lines"]


@query
def extract_null_vs_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = document(F.col("doc"))
    path = ["order", "status"]
    state = (
        F.when(doc.is_absent(path), F.lit("absent")).when(doc.is_null(path), F.lit("null")).otherwise(F.lit("present"))
    )
    return fx.order_docs_with_holes(spark, sf_dir).select(
        doc.get("order.id", "bigint").alias("id"), state.alias("state"),
        doc.get("order.status").alias("status"), doc.get_or("order.status", "?").alias("status_or_default"),
    )


def _status_required():
    return fx.spec(fx.ORDERS_SPEC.replace("log_key: status, sql_attr: varchar(1)",
                                          "log_key: status, sql_attr: varchar(1), is_mandatory: true"))


@query
def extract_mandatory(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.order_docs_with_holes(spark, sf_dir)
    return _orders(extract_tables(docs, _status_required())["orders"])


@query
def extract_mandatory_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = error_rows(fx.order_docs_with_holes(spark, sf_dir), _status_required())
    return errors.select(
        F.get_json_object("raw_line", "$.order.id").cast("bigint").alias("id"), "error_reason", "error_detail", "line_number"
    )


@query
def extract_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upper-case TIMESTAMP reads epoch seconds, lower-case timestamp reads epoch millis."""
    table = parse_spec("""
version: 1
tables:
  t:
    src: o
    src_type: dict
    columns:
    - {log_key: id, sql_attr: int8}
    - {log_key: seconds, sql_attr: TIMESTAMP}
    - {log_key: millis, sql_attr: timestamp}
    - {log_key: fraction, sql_attr: TIMESTAMP not null}
    - {log_key: bad, sql_attr: TIMESTAMP}
    sortkey_attr: []
""").tables["t"]
    seconds = fx.epoch("o_orderdate")
    record = F.struct(
        F.col("o_orderkey").alias("id"), seconds.alias("seconds"), (seconds * 1000).alias("millis"),
        (seconds + 0.75).alias("fraction"), F.col("o_orderpriority").alias("bad"),
    )
    lines = fx.table(spark, sf_dir, "orders").select(F.to_json(F.struct(record.alias("o"))).alias("value"))
    rows = extract_table(parse_lines(lines), table)
    return rows.select("id", shown("seconds"), shown("millis"), shown("fraction"), shown("bad"))


@query
def extract_json_blob(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = parse_spec("""
version: 1
tables:
  t:
    src: ''
    src_type: dict
    columns:
    - {log_key: id, sql_attr: int8}
    - {log_key: props, sql_attr: varchar(65535), is_json: true}
    - {log_key: nothing, sql_attr: varchar(65535), is_json: true}
    sortkey_attr: []
""").tables["t"]
    record = F.struct(F.col("event_id").alias("id"), F.try_parse_json("props").alias("props"))
    lines = fx.table(spark, sf_dir, "events").select(F.to_json(record).alias("value"))
    return extract_table(parse_lines(lines), table)


@query
def extract_blob_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = parse_spec("""
version: 1
tables:
  t:
    src: doc
    src_type: dict
    columns:
    - {log_key: id, sql_attr: int8}
    - {log_key: body, sql_attr: varchar(65535), is_json: true}
    sortkey_attr: []
""").tables["t"]
    body = F.struct(F.repeat("text", F.lit(4)).alias("text"))
    record = F.struct(F.struct(F.col("doc_id").alias("id"), body.alias("body")).alias("doc"))
    lines = fx.table(spark, sf_dir, "documents").select(F.to_json(record).alias("value"))
    rows = extract_table(parse_lines(lines), table, json_limit=65535)
    return rows.select("id", F.length("body").cast("bigint").alias("body_length"))


@query
def extract_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = parse_spec("""
version: 1
tables:
  t:
    src: line.charges
    src_type: list
    columns:
    - {log_key: line.order_id, name: order_id, sql_attr: int8, is_foreign: true}
    - {log_key: index, sql_attr: smallint}
    - {name: odd_or_even, sql_attr: bool, is_derived: true}
    - {name: line_and_index, sql_attr: varchar(32), is_derived: true}
    sortkey_attr: []
""").tables["t"]
    metrics = {
        "odd_or_even": lambda row: row.get("line.order_id", "bigint") % 2 == 0,
        "line_and_index": lambda row: F.concat_ws("/", row.get("line.number"), row.position.cast("string")),
    }
    return extract_table(fx.line_docs(spark, sf_dir), table, metrics)


@query
def extract_fanout_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = parse_spec(fx.LINES_SPEC)
    fanned = sinks.psv_fan_out(fx.line_docs(spark, sf_dir), both)
    return fanned.groupBy(F.col("table").alias("table_name")).agg(F.count("*").alias("n_rows"))


@query
def extract_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables from one parse, joined back from the written stage."""
    tables = sinks.staged_tables(fx.line_docs(spark, sf_dir), fx.spec(fx.LINES_SPEC))
    lines = tables["lines"].select(F.lit("lines").alias("table_name"), "order_id", F.col("part").alias("v"))
    charges = tables["charges"].select(F.lit("charges").alias("table_name"), "order_id", F.col("index").alias("v"))
    rows = lines.unionByName(charges)
    return rows.groupBy("table_name").agg(
        F.count("*").alias("n_rows"), F.sum("order_id").alias("order_ids"), F.sum("v").alias("v_sum")
    )


@query
def quarantine_bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = parse_lines(fx.broken_order_lines(spark, sf_dir))
    return error_rows(docs, fx.spec(fx.ORDERS_SPEC)).select(
        F.regexp_extract("raw_line", r'"id":(\d+)', 1).cast("bigint").alias("id"), "error_reason", "line_number"
    )


@query
def good_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of a log with broken lines."""
    docs = parse_lines(fx.broken_order_lines(spark, sf_dir))
    return _orders(extract_tables(docs, fx.spec(fx.ORDERS_SPEC))["orders"])


@query
def truncation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = fx.table_spec(fx.TEXT_SPEC, "texts")
    return checks.truncation_report(extract_table(fx.text_docs(spark, sf_dir), table), table, "texts")


@query
def truncate_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = fx.table_spec(fx.TEXT_SPEC, "texts")
    return checks.truncate_columns(extract_table(fx.text_docs(spark, sf_dir), table), table)


@query
def reassemble_parent_child(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Children joined to parents on the copied key, children reduced to one row per key first.

    Merged, not broadcast: Spark takes rows projected from a parsed document for a fiftieth of their size.
    """
    orders = extract_tables(fx.order_docs(spark, sf_dir), fx.spec(fx.ORDERS_SPEC))["orders"]
    charges = extract_tables(fx.line_docs(spark, sf_dir), fx.spec(fx.LINES_SPEC))["charges"]
    per_order = charges.groupBy("order_id").agg(
        F.count("*").alias("n_charges"),
        F.round(F.sum(F.when(F.col("kind") == "price", F.col("amount"))), 2).alias("price"),
    )
    return orders.hint("merge").join(per_order, orders["id"] == per_order["order_id"]).select(
        "id", "customer", "agent", "n_charges", "price"
    )


@query
def reassemble_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parents and children stored in buckets by their common key: grouped and joined where they lie."""
    root, name = fresh_folder(spark, "buckets"), uuid.uuid4().hex[:12]
    lines_spec, buckets = fx.spec(fx.LINES_SPEC), day_tables.buckets_for(spark, f"{sf_dir}/lineitem.parquet")
    day = F.date_add(F.lit("2024-03-01").cast("date"), (F.col("order_id") % 2).cast("int"))
    for part, rows in extract_tables(fx.line_docs(spark, sf_dir), lines_spec).items():
        table = day_tables.table_of(spark, f"{part}_{name}", lines_spec.tables[part], root, "public", buckets=buckets)
        table.check()
        table.replace(rows.withColumn("data_date", day))
    parents = spark.table(f"lines_{name}").groupBy("order_id").agg(F.count("*").alias("n_lines"), F.sum("part").alias("parts"))
    children = spark.table(f"charges_{name}").groupBy("order_id").agg(
        F.count("*").alias("n_charges"), F.round(F.sum(F.when(F.col("kind") == "price", F.col("amount"))), 2).alias("price"))
    return parents.hint("merge").join(children, "order_id")


@query
def gzip_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders in one compressed file, which one task reads; its lines are parsed by eight."""
    root = fresh_folder(spark, "one-file")
    fx.order_lines(spark, sf_dir).coalesce(1).write.option("compression", "gzip").text(root)
    docs = read_documents(spark, "json", f"{root}/part-*.gz", spread=8)
    return _orders(extract_table(docs, fx.table_spec(fx.ORDERS_SPEC, "orders")))


# -- delimited text ----------------------------------------------------------------------------------

@query
def psv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = fx.table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    return psv.to_psv(documents, ["doc_id", "text", "lang", "source"])


def _round_trip(rows: DataFrame, attrs: dict[str, str], delimiter: str) -> DataFrame:
    columns = [{"log_key": n, "sql_attr": a} for n, a in attrs.items()]
    table = parse_spec_table(columns)
    return psv.from_psv(psv.to_psv(rows, list(attrs), delimiter), table, delimiter)


def parse_spec_table(columns: list[dict]):
    from logweir.plans.spec import TableSpec

    return TableSpec.from_dict({"src": "", "src_type": "dict", "columns": columns, "sortkey_attr": []})


@query
def psv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line feeds, delimiters and backslashes, written as lines and read back."""
    documents = fx.table(spark, sf_dir, "documents").select(
        F.lit("documents").alias("origin"), F.col("doc_id").alias("id"),
        F.concat(F.lit("a\\|b\\"), F.col("text"), F.lit("\\\\n|")).alias("body"),
    )
    pages = fx.table(spark, sf_dir, "pages").select(
        F.lit("pages").alias("origin"), F.col("page_id").alias("id"), F.col("html").alias("body")
    )
    attrs = {"origin": "varchar(16)", "id": "int8", "body": "text"}
    return _round_trip(documents.unionByName(pages), attrs, "|")


@query
def psv_roundtrip_record_separator(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = fx.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.col("text").alias("body"))
    attrs = {"conv_id": "int8", "turn": "int8", "role": "varchar(32)", "body": "text"}
    return _round_trip(turns, attrs, "\x1e")


@query
def psv_files_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables of a spec written as compressed lines in one pass, one of them loaded back."""
    both = fx.spec(fx.LINES_SPEC)
    folder = fresh_folder(spark, "psv")
    sinks.write_psv(sinks.psv_fan_out(fx.line_docs(spark, sf_dir), both), folder)
    lines = read_lines(spark, f"{folder}/table=charges")
    return _charges(psv.from_psv(lines, both.tables["charges"]))


# -- day directories ---------------------------------------------------------------------------------

def _order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()


def _prefixes(spark: SparkSession) -> DataFrame:
    return small_frame(spark, [("s3://logs//main/", 0), ("s3://logs/backup", 1)], "prefix string, priority int")


def _markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even days are complete in the first prefix, every third one in the second."""
    number = F.dayofmonth("day")
    present = F.when(F.col("priority") == 0, number % 2 == 0).otherwise(number % 3 == 0)
    return _wanted(spark, sf_dir).where(present).select("prefix", "day")


def _wanted(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = [F.struct(F.lit(p).alias("prefix"), F.lit(n).alias("priority"))
            for p, n in (("s3://logs//main/", 0), ("s3://logs/backup", 1))]
    return _order_days(spark, sf_dir).select("day", F.inline(F.array(*pair)))


@query
def day_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wanted(spark, sf_dir).select(
        F.date_format("day", "yyyy-MM-dd").alias("day"), "priority",
        days.day_input(F.col("prefix"), F.col("day")).alias("input"),
        days.marker_path(F.col("prefix"), F.col("day")).alias("marker"),
    )


@query
def complete_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = days.complete_days(_wanted(spark, sf_dir), _markers(spark, sf_dir))
    return found.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "priority")


@query
def first_complete_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = days.first_complete_prefix(_order_days(spark, sf_dir), _prefixes(spark), _markers(spark, sf_dir))
    return chosen.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "prefix")


@query
def days_to_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days neither finished (even ones) nor started (those with an urgent order)."""
    all_days = _order_days(spark, sf_dir)
    orders = fx.table(spark, sf_dir, "orders")
    started = orders.where("o_orderpriority = '1-URGENT'").select(F.to_date("o_orderdate").alias("day"))
    left = days.days_to_run(all_days, all_days.where(F.dayofmonth("day") % 2 == 0), started)
    return left.select(F.date_format("day", "yyyy-MM-dd").alias("day"))


def _write_day_files(spark: SparkSession, sf_dir: str, root: str) -> None:
    """All orders spread over three day directories; the third one is not complete."""
    slot = F.col("o_orderkey") % 3
    for number, day in enumerate(("2024/03/01", "2024/03/02", "2024/03/03")):
        fx.order_lines(spark, sf_dir, slot == number).write.option("compression", "gzip").text(f"{root}/{day}")
        if number < 2:
            files.touch(spark, f"{root}/{day}/COMPLETE")


@query
def file_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row knows its file, and the day from the file's path."""
    root = fresh_folder(spark, "days")
    _write_day_files(spark, sf_dir, root)
    table = fx.table_spec(fx.ORDERS_SPEC, "orders").add_column("__source_filename__", "varchar(4096)")
    docs = parse_lines(read_lines(spark, f"{root}/*/*/*/part-*.gz", days.DAY_IN_PATH))
    rows = extract_table(docs, table)
    return rows.select(
        "id", F.date_format("data_date", "yyyy-MM-dd").alias("data_date"),
        F.regexp_extract("__source_filename__", r"(\d{4}/\d{2}/\d{2})/part-[^/]*\.gz$", 1).alias("day_folder"),
    )


@query
def day_range_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three days extracted and loaded; the last has no marker, so it is reported and not loaded."""
    root = fresh_folder(spark, "range")
    _write_day_files(spark, sf_dir, f"{root}/in")
    orders = fx.spec(fx.ORDERS_SPEC)
    args = (spark, orders, [f"{root}/nowhere", f"{root}/in"], date(2024, 3, 1), date(2024, 3, 3), f"{root}/stage", f"{root}/out")
    results = day_runs.run_days(*args)
    again = day_runs.run_days(*args).where("step = 'load' AND status = 'success'")  # nothing is left to load
    results = results.unionByName(again)
    counts = day_runs.loaded_counts(spark, orders, f"{root}/out")
    joined = results.join(
        counts, (results["day"] == counts["data_date"]) & (results["table_name"] == counts["table_name"]), "left"
    )
    return joined.select(
        F.date_format("day", "yyyy-MM-dd").alias("day"), "step",
        results["table_name"], "status", F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
    )


_LATER_SPEC = fx.ORDERS_SPEC.replace("version: 3", "version: 4").replace(
    "    sortkey_attr", "    - {log_key: note, sql_attr: varchar(8) default 'none'}\n    - {log_key: priority, sql_attr: int4 default 7}\n    sortkey_attr")


def _noted_lines(spark: SparkSession, sf_dir: str, where: Column) -> DataFrame:
    """Orders whose documents have the later version's fields."""
    order = fx.order_fields().withField("note", F.lit("new")).withField("priority", F.when(F.col("o_orderkey") % 2 == 0, 1))
    return fx.table(spark, sf_dir, "orders").where(where).select(fx.order_text(order).alias("value"))


@query
def day_range_after_spec_bump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days loaded under one version, the third under the next, which has two more columns with defaults."""
    root, slot = fresh_folder(spark, "bump"), F.col("o_orderkey") % 3
    for n in (0, 1):
        fx.order_lines(spark, sf_dir, slot == n).write.option("compression", "gzip").text(f"{root}/in/2024/03/0{n + 1}")
    _noted_lines(spark, sf_dir, slot == 2).write.option("compression", "gzip").text(f"{root}/in/2024/03/03")
    for n in (1, 2, 3):
        files.touch(spark, f"{root}/in/2024/03/0{n}/COMPLETE")
    old, new = fx.spec(fx.ORDERS_SPEC), fx.spec(_LATER_SPEC)
    where = (f"{root}/stage", f"{root}/out")
    day_runs.run_days(spark, old, [f"{root}/in"], date(2024, 3, 1), date(2024, 3, 2), *where)
    day_runs.run_days(spark, new, [f"{root}/in"], date(2024, 3, 3), date(2024, 3, 3), *where)
    rows = evolve.read_stored(spark, f"{root}/out/orders", new.tables["orders"])
    return rows.select("id", "note", "priority", F.date_format("data_date", "yyyy-MM-dd").alias("data_date"))


@query
def day_rerun_replaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days with broken lines, loaded again after they were mended: no row of the first load is left."""
    root, orders = fresh_folder(spark, "rerun"), fx.spec(fx.ORDERS_SPEC)
    day = F.date_add(F.lit("2024-03-01").cast("date"), (F.get_json_object("value", "$.order.id").cast("bigint") % 2).cast("int"))
    for lines in (fx.broken_order_lines(spark, sf_dir), fx.order_lines(spark, sf_dir)):
        dated = lines.withColumn("data_date", F.coalesce(day, F.lit("2024-03-01").cast("date")))
        sinks.load_tables(parse_lines(dated), orders, root, days=[date(2024, 3, 1), date(2024, 3, 2)])
    errors = evolve.read_stored(spark, f"{root}/pipeline_errors", sinks.stored_error_table()).select(F.lit("errors").alias("table_name"), "data_date")
    rows = evolve.read_stored(spark, f"{root}/orders", orders.tables["orders"]).select(F.lit("orders").alias("table_name"), "data_date")
    counted = rows.unionByName(errors).groupBy("table_name", "data_date").agg(F.count("*").alias("n_rows"))
    return counted.select("table_name", F.date_format("data_date", "yyyy-MM-dd").alias("data_date"), "n_rows")


@query
def day_load_interrupted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load of new rows stops between write and publish: readers of the catalog table find all old rows, then a whole load the new ones."""
    name, root = f"orders_{uuid.uuid4().hex[:12]}", fresh_folder(spark, "published")
    table = day_tables.table_of(spark, name, fx.table_spec(fx.ORDERS_SPEC, "orders"), root, "public")
    day = F.date_add(F.lit("2024-03-01").cast("date"), (F.col("id") % 3).cast("int"))
    rows = extract_table(fx.order_docs(spark, sf_dir), table.table).withColumn("data_date", day)
    table.check()
    table.replace(rows)
    changed = rows.withColumn("total", F.lit(0.0)).where(day != F.lit("2024-03-03").cast("date"))
    table.write(changed)  # and then the load is stopped
    before = spark.table(name).groupBy("data_date").agg(F.count("*").alias("n_rows"), F.round(F.sum("total"), 2).alias("total"))
    before = stored(before.withColumn("seen", F.lit("stopped")), "seen")
    table.replace(changed, [date(2024, 3, 1), date(2024, 3, 2), date(2024, 3, 3)])
    table.sweep(grace_seconds=-60)
    after = spark.table(name).groupBy("data_date").agg(F.count("*").alias("n_rows"), F.round(F.sum("total"), 2).alias("total"))
    found = before.unionByName(after.withColumn("seen", F.lit("loaded")))
    return found.select("seen", F.date_format("data_date", "yyyy-MM-dd").alias("data_date"), "n_rows", "total")


@query
def day_claimed_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the same days at the same time, one on top of a claim left by a third: who staged and loaded what, by the ledger."""
    root = fresh_folder(spark, "claims")
    _write_day_files(spark, sf_dir, f"{root}/in")
    orders, stage = fx.spec(fx.ORDERS_SPEC), f"{root}/stage"
    other = claims.take(spark, f"{day_runs.stage_of(stage, orders)}/claims/2024-03-02")
    args = (spark, orders, [f"{root}/in"], date(2024, 3, 1), date(2024, 3, 2), stage, f"{root}/out")
    with ThreadPoolExecutor(2) as both:
        list(both.map(lambda _: day_runs.run_days(*args), range(2)))
    other.release()
    day_runs.run_days(*args)
    events = day_runs.ledger_events(spark, f"{root}/out/_ledger").where("status IN ('started', 'success') AND step = 'et'")
    staged = events.groupBy("day", "status").agg(F.count_distinct("seq").alias("n_events"))
    counts = day_runs.loaded_counts(spark, orders, f"{root}/out").where("table_name = 'orders'")
    started = staged.where("status = 'started'").select(F.col("day").alias("data_date"), F.col("n_events").alias("n_started"))
    return counts.join(started, "data_date").select(F.date_format("data_date", "yyyy-MM-dd").alias("data_date"), "n_started", "n_rows")


@query
def ledger_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range that is stopped after its first day, then run again: runs by the library's own ledger, and what was loaded when."""
    root = fresh_folder(spark, "resumed")
    _write_day_files(spark, sf_dir, f"{root}/in")
    orders, ledger_folder = fx.spec(fx.ORDERS_SPEC), f"{root}/out/_ledger"
    where = (f"{root}/stage", f"{root}/out")
    one, two = date(2024, 3, 1), date(2024, 3, 2)
    note = lambda made: day_runs.record(spark, orders, ledger_folder, made)
    day_runs.extract_days(spark, orders, [f"{root}/in"], [one, two], where[0], note=note)
    day_runs.load_days(spark, orders, [one], *where, note=note)  # here the first run stops
    again = day_runs.run_days(spark, orders, [f"{root}/in"], one, date(2024, 3, 3), *where, days_at_once=1)
    loaded = again.where("step = 'load' AND status = 'success'").groupBy("day").agg(F.count("*").alias("n_loaded_again"))
    runs = ledger.run_rows(day_runs.ledger_steps(spark, ledger_folder))
    known = runs.withColumn("timed", (F.col("et_runtime") >= 0) & (F.coalesce("load_runtime", F.lit(0)) >= 0) & F.coalesce(F.col("updated_at") >= F.col("et_starttime"), F.lit(True)))
    return known.join(loaded, known["data_date"] == loaded["day"], "left").select(
        F.date_format("data_date", "yyyy-MM-dd").alias("data_date"), "etl_status", F.col("load_starttime").isNotNull().alias("load_started"),
        "timed", "etl_error", F.coalesce("n_loaded_again", F.lit(0)).alias("n_loaded_again"))


# -- SQL dumps ---------------------------------------------------------------------------------------

@query
def insert_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [
        ("s_suppkey", F.col("s_suppkey").cast("string")), ("s_name", fx.sql_quoted(F.col("s_name"))),
        ("s_nationkey", F.col("s_nationkey").cast("string")), ("s_acctbal", F.col("s_acctbal").cast("string")),
        ("s_note", F.lit(None).cast("string")),
    ]
    lines = fx.table(spark, sf_dir, "supplier").select(fx.insert_line("supplier", columns).alias("value"))
    table = parse_spec_table([
        {"log_key": "s_suppkey", "sql_attr": "int8 not null", "is_mandatory": True},
        {"log_key": "s_name", "sql_attr": "varchar(32)"}, {"log_key": "s_nationkey", "sql_attr": "int4"},
        {"log_key": "s_acctbal", "sql_attr": "float8"}, {"log_key": "s_note", "sql_attr": "varchar(8)"},
    ])
    return extract_table(dump.parse_inserts(lines), table)


@query
def insert_dump_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with quotes, commas, brackets and escapes inside quoted values."""
    body = F.concat(F.lit("it's (a), \\ 'b'"), F.col("text"))
    columns = [("doc_id", F.col("doc_id").cast("string")), ("body", fx.sql_quoted(body)), ("lang", fx.sql_quoted(F.col("lang")))]
    lines = fx.table(spark, sf_dir, "documents").select(fx.insert_line("documents", columns).alias("value"))
    table = parse_spec_table([
        {"log_key": "doc_id", "sql_attr": "int8"}, {"log_key": "body", "sql_attr": "text"},
        {"log_key": "lang", "sql_attr": "varchar(8)"},
    ])
    return extract_table(dump.parse_inserts(lines), table)


@query
def insert_dump_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth row names a column twice: it goes to the error table, the others are read."""
    twice = F.col("s_suppkey") % 5 == 0
    columns = [("s_suppkey", F.col("s_suppkey").cast("string")), ("s_name", fx.sql_quoted(F.col("s_name")))]
    broken = fx.insert_line("supplier", [columns[0], columns[1], columns[0]])
    lines = fx.table(spark, sf_dir, "supplier").select(F.when(twice, broken).otherwise(fx.insert_line("supplier", columns)).alias("value"))
    docs = dump.parse_inserts(lines)
    spec = SchemaSpec({"supplier": parse_spec_table([{"log_key": "s_suppkey", "sql_attr": "int8"}])})
    rows = extract_tables(docs, spec)["supplier"].select("s_suppkey", F.lit("row").alias("outcome"))
    errors = error_rows(docs, spec).select(F.regexp_extract("raw_line", r"VALUES \((\d+)", 1).cast("bigint").alias("s_suppkey"), F.lit("error").alias("outcome"))
    return rows.unionByName(errors)


# -- inference and evolution -------------------------------------------------------------------------

@query
def infer_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = infer.fold_types(infer.leaf_summary(fx.order_lines(spark, sf_dir)))
    return folded.select("path", "type", "max_len", "is_json", "is_foreign")


@query
def infer_depth_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Limited depth, an excluded path, a foreign path and a list source."""
    shallow = infer.leaf_summary(
        fx.item_lines(spark, sf_dir), infer.InferOptions(depth=2, exclude=("line.part",), prune=("flags",)), lengths=False
    )
    listed = infer.leaf_summary(
        fx.item_lines(spark, sf_dir), infer.InferOptions("line.charges", "list", foreign=("line.order_id",)), lengths=False
    )
    first, second = infer.fold_types(shallow), infer.fold_types(listed)
    return first.withColumn("source", F.lit("depth")).unionByName(second.withColumn("source", F.lit("list"))).select(
        "source", "path", "type", "is_json", "is_foreign"
    )


@query
def infer_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inferred table is used to extract the log it was inferred from."""
    lines = fx.order_lines(spark, sf_dir)
    table = infer.infer_table(lines)
    rows = extract_table(parse_lines(lines), table)
    # integer columns are as wide as the data needs; one type for all scales here
    wide = [F.col(c).cast("bigint").alias(c) for c in ("order_id", "order_customer", "order_start_time")]
    return rows.select(*wide, "order_status", "order_total", "session_agent")


_PART_V1 = [{"log_key": "p_partkey", "sql_attr": "int8"}, {"log_key": "p_name", "sql_attr": "varchar(64)"}]
_PART_V2 = _PART_V1 + [{"log_key": "p_size", "sql_attr": "int4 default 7"}, {"log_key": "p_note", "sql_attr": "varchar(8)"}]


@query
def evolve_add_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows stored before a column existed get its default, later ones keep their value."""
    part = fx.table(spark, sf_dir, "part")
    root = fresh_folder(spark, "evolve")
    old, new = parse_spec_table(_PART_V1), parse_spec_table(_PART_V2)
    early, late = F.col("p_partkey") % 2 == 0, F.col("p_partkey") % 2 == 1
    sinks.write_table(evolve.conform(part.where(early), old), f"{root}/v1")
    sized = part.where(late).withColumn("p_size", F.when(F.col("p_size") != 5, F.col("p_size")))
    sinks.write_table(evolve.conform(sized, new), f"{root}/v2")
    evolve.added_columns("part", old, new)
    return evolve.read_evolved(spark, [f"{root}/v1", f"{root}/v2"], new)


@query
def evolve_catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table extended by columns: stored rows get their defaults, new ones keep NULL."""
    name = f"part_{uuid.uuid4().hex[:12]}"
    old, new = SchemaSpec({name: parse_spec_table(_PART_V1)}), SchemaSpec({name: parse_spec_table(_PART_V2)})
    part, even = fx.table(spark, sf_dir, "part"), F.col("p_partkey") % 2 == 0
    root = fresh_folder(spark, "catalog")
    day = F.date_add(F.lit("2024-03-01").cast("date"), (F.col("p_partkey") % 2).cast("int")).alias("data_date")
    with_day = part.select("*", day)
    evolve.evolve_tables(spark, old, root=root, with_errors=False)
    sinks.write_table(evolve.conform(with_day.where(even), old.tables[name]), f"{root}/{name}")
    evolve.evolve_tables(spark, new, root=root, with_errors=False)
    sized = with_day.where(~even).withColumn("p_size", F.when(F.col("p_size") != 5, F.col("p_size")))
    sinks.write_table(evolve.conform(sized, new.tables[name]), f"{root}/{name}")
    evolve.publish_days(spark, new, with_errors=False)
    return spark.table(name).select("p_partkey", "p_name", "p_size", "p_note")


@query
def column_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A spec of every sample table that lacks its first column and has one of its own, against the tables."""
    stored = {n: fx.table(spark, sf_dir, n) for n in ("nation", "part", "orders", "lineitem", "events")}
    columns = {n: [{"log_key": c, "sql_attr": "text"} for c in [*t.columns[1:], "added"]] for n, t in stored.items()}
    return evolve.column_diff(stored, SchemaSpec({n: parse_spec_table(c) for n, c in columns.items()}), spark)


@query
def row_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("region", "nation", "supplier", "customer", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
             "benchmark", "labels", "conversations")
    return evolve.row_presence({n: fx.table(spark, sf_dir, n) for n in names})


# -- retention and layout ----------------------------------------------------------------------------

@query
def ttl_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retention.keep_recent(fx.events(spark, sf_dir), "ts", 7).select("event_id", "user_id", shown("ts"))


def _stored_events(spark: SparkSession, sf_dir: str):
    """Events stored by the day after they happened, so day partitions and time stamps do not line up."""
    table = parse_spec_table([
        {"log_key": "event_id", "sql_attr": "int8"}, {"log_key": "user_id", "sql_attr": "int8 distkey"},
        {"log_key": "ts", "sql_attr": "TIMESTAMP"},
    ]).with_sortkeys(["ts"])
    folder = fresh_folder(spark, "events")
    shifted = F.to_date(F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(12)))
    rows = fx.events(spark, sf_dir).select("event_id", "user_id", "ts", shifted.alias("data_date"))
    sinks.write_table(rows, folder, table)
    return folder, table


@query
def ttl_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old rows deleted from a table stored by day: whole days dropped, the boundary day rewritten."""
    folder, table = _stored_events(spark, sf_dir)
    retention.delete_old(spark, folder, table, 7)
    stored = spark.read.parquet(folder)
    return stored.select("event_id", shown("ts"), F.date_format("data_date", "yyyy-MM-dd").alias("data_date"))


@query
def ttl_delete_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retention of a published table by its zone maps; then the kept rows of the last three days, also by these."""
    name, root = f"events_{uuid.uuid4().hex[:12]}", fresh_folder(spark, "zones")
    table = day_tables.table_of(spark, name, parse_spec_table(_EVENTS_V1).with_sortkeys(["ts"]), root, "public")
    table.check()
    shifted = F.to_date(F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(12)))
    table.replace(fx.events(spark, sf_dir).select("event_id", "user_id", "ts", shifted.alias("data_date")))
    retention.delete_old_rows(table, 7)
    recent = retention.recent_rows(table, 3).select("event_id", F.lit(True).alias("recent"))
    return spark.table(name).join(recent, "event_id", "left").select(
        "event_id", shown("ts"), F.date_format("data_date", "yyyy-MM-dd").alias("data_date"), F.coalesce("recent", F.lit(False)).alias("recent"))


@query
def compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, table = _stored_events(spark, sf_dir)
    retention.compact(spark, folder, table)
    return spark.read.parquet(folder).groupBy("data_date").agg(F.count("*").alias("n_rows")).select(
        F.date_format("data_date", "yyyy-MM-dd").alias("data_date"), "n_rows"
    )


_EVENTS_V1 = [{"log_key": "event_id", "sql_attr": "int8"}, {"log_key": "user_id", "sql_attr": "int8 distkey"}, {"log_key": "ts", "sql_attr": "TIMESTAMP"}]
_EVENTS_V2 = [*_EVENTS_V1, {"log_key": "event_type", "sql_attr": "varchar(16) default 'before'"}, {"log_key": "value", "sql_attr": "float8"}]


def _events_of_two_versions(spark: SparkSession, sf_dir: str):
    """Events stored by the day after they happened, those of odd days under a version that lacks two columns."""
    old, new = (parse_spec_table(c).with_sortkeys(["ts"]) for c in (_EVENTS_V1, _EVENTS_V2))
    folder = fresh_folder(spark, "events")
    shifted = F.to_date(F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(12)))
    rows = fx.events(spark, sf_dir).withColumn("data_date", shifted)
    odd = F.dayofmonth("data_date") % 2 == 1
    sinks.write_table(evolve.conform(rows.where(odd), old), folder, old)
    sinks.write_table(evolve.conform(rows.where(~odd), new), folder, new)
    return folder, new


def _seen_events(spark: SparkSession, folder: str, table) -> DataFrame:
    rows = evolve.read_stored(spark, folder, table)
    return rows.select("event_id", shown("ts"), "event_type", "value", F.date_format("data_date", "yyyy-MM-dd").alias("data_date"))


@query
def compacted_after_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compaction keeps the columns that only some days have, and writes the defaults into the others."""
    folder, table = _events_of_two_versions(spark, sf_dir)
    retention.compact(spark, folder, table)
    return _seen_events(spark, folder, table)


@query
def ttl_delete_after_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retention rewrites the boundary day with all of its columns."""
    folder, table = _events_of_two_versions(spark, sf_dir)
    retention.delete_old(spark, folder, table, 7)
    return _seen_events(spark, folder, table)


@query
def layout_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rewriting by dist and sort key changes where rows are, not what they are."""
    table = parse_spec_table([
        {"log_key": "l_orderkey", "sql_attr": "int8"}, {"log_key": "l_suppkey", "sql_attr": "int8 distkey"},
        {"log_key": "l_quantity", "sql_attr": "float8"}, {"log_key": "l_shipdate", "sql_attr": "TIMESTAMP"},
    ]).with_sortkeys(["l_shipdate"])
    folder = fresh_folder(spark, "layout")
    lines = fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_quantity", F.col("l_shipdate").cast("timestamp").alias("l_shipdate")
    )
    sinks.write_table(lines, folder, table)
    return spark.read.parquet(folder).groupBy("l_suppkey").agg(
        F.count("*").alias("n_rows"), F.sum("l_orderkey").alias("order_keys"),
        F.round(F.sum("l_quantity"), 2).alias("quantity"), F.date_format(F.max("l_shipdate"), "yyyy-MM-dd").alias("last_ship"),
    )


# -- ledger ------------------------------------------------------------------------------------------

def _first_day(spark: SparkSession, sf_dir: str) -> Column:
    first = fx.events(spark, sf_dir).agg(F.to_date(F.min("ts")).alias("d"))
    return first.scalar()


def _job_day(rows: DataFrame) -> DataFrame:
    return rows.select("job_id", F.date_format("day", "yyyy-MM-dd").alias("day"))


@query
def load_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _job_day(ledger.load_frontier(fx.status_days(spark, sf_dir), _first_day(spark, sf_dir)))


@query
def load_frontier_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _job_day(ledger.load_frontier(fx.status_days(spark, sf_dir), _first_day(spark, sf_dir), retry_errors=True))


@query
def stand_in_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = fx.events(spark, sf_dir).select(F.col("user_id").alias("job_id")).distinct()
    first = F.lit("2024-01-01").cast("date")
    return _job_day(ledger.stand_in_status(jobs, first, F.lit("2024-01-10").cast("date")))


@query
def success_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = fx.step_results(spark, sf_dir)
    ends = results.groupBy("job_id").agg(F.max("day").alias("end_date"))
    folded = ledger.result_fold(results, ends)
    return folded.select("job_id", "status", F.date_format("last_ok_day", "yyyy-MM-dd").alias("last_ok_day"), "error_info")


@query
def next_loadable_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _job_day(ledger.next_loadable_day(fx.step_results(spark, sf_dir), _first_day(spark, sf_dir)))


@query
def run_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = ledger.run_rows(fx.step_events(spark, sf_dir))
    return runs.select(
        "job_id", F.date_format("data_date", "yyyy-MM-dd").alias("data_date"), "etl_status",
        shown("et_starttime"), F.round("et_runtime", 3).alias("et_runtime"),
        shown("load_starttime"), F.round("load_runtime", 3).alias("load_runtime"), "etl_error",
    )


@query
def ledger_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = ledger.latest_per_key(fx.events(spark, sf_dir), ["user_id"], ["ts", "event_id"])
    key = text.job_key(F.lit("c1"), F.col("event_type"), F.col("user_id"), F.to_date("ts"), F.lit(None).cast("string"))
    return newest.select("user_id", "event_id", shown("ts"), "event_type", "value", key.alias("job_key"))


@query
def stuck_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.lit("2024-01-20 00:00:00").cast("timestamp")
    return ledger.stuck_rows(fx.job_rows(spark, sf_dir), now, 4 * 86400).select("job_id", "et_status")


@query
def retry_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.retry_due(fx.job_rows(spark, sf_dir), fixed_now()).select("job_id", "et_num_error_retries")


@query
def retry_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retry counters and next attempts after each job's run ended as its event says."""
    jobs = fx.job_rows(spark, sf_dir)
    after = ledger.after_run(jobs, F.col("et_status"), F.lit(None).cast("date"), F.col("at"))
    return after.select("job_id", "et_status", "et_num_error_retries", shown("et_next_error_retry_attempt"))


@query
def display_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = ledger.with_defaults(fx.job_rows(spark, sf_dir))
    return jobs.select("job_id", ledger.display_status().alias("shown_status"))


@query
def work_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = ledger.work_plan(fx.planned_jobs(spark, sf_dir), fx.clusters(spark, sf_dir), fixed_now())
    return plan.select("job_id", "cluster_id", "host", "port", "db_schema", F.date_format("day", "yyyy-MM-dd").alias("day"))


@query
def earlier_later_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds of day ranges; an empty or missing day counts for nothing."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    other = F.when(F.col("o_orderkey") % 3 == 0, "").when(F.col("o_orderkey") % 3 == 1, F.date_format(F.date_add(F.to_date("o_orderdate"), 3), "yyyy-MM-dd"))
    return fx.table(spark, sf_dir, "orders").select("o_orderkey", dates.earlier(day, other).alias("first"), dates.later(day, other).alias("last"))


@query
def transition_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = ledger.transitions(fx.status_events(spark, sf_dir), ["at", "event_id"])
    return ledger.illegal_transitions(changes).select("job_id", "event_id", "from_status", "to_status")


@query
def job_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of some jobs by id, and of one log by name, from a ledger with Bloom filters on both."""
    root, events = fresh_folder(spark, "ledger"), fx.events(spark, sf_dir)
    rows = events.select("event_id", F.col("user_id").alias("job_id"), F.concat(F.lit("log-"), (F.col("user_id") % 7).cast("string"), F.col("event_type")).alias("log_name"))
    lookup.write_indexed(rows, root, ["job_id", "log_name"])
    by_id = lookup.find(spark, root, rows.schema, job_id=[3, 14, 15]).withColumn("by", F.lit("id"))
    by_name = lookup.find(spark, root, rows.schema, log_name="log-5error").withColumn("by", F.lit("name"))
    return by_id.unionByName(by_name)


@query
def versions_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = fx.table(spark, sf_dir, "part")
    name = F.when(F.col("p_partkey") % 10 == 0, F.lit("bad-name")).otherwise(F.replace("p_brand", F.lit("#"), F.lit("_")))
    key = F.concat(F.lit("specs/stream/"), name, F.lit("/schema/v"), F.col("p_size").cast("string"), F.lit("/schema.yaml"))
    listed = ledger.versions_by_name(part.select(key.alias("key")), "specs/stream")
    return listed.select("log_name", F.array_join("versions", ",").alias("versions"))


@query
def job_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = fx.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return text.search(customers, c_name=["00007", "#00000012"], c_mktsegment=["build", "MACH"])


# -- scalar helpers ----------------------------------------------------------------------------------

@query
def normalise_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    today = F.to_date("o_orderdate")
    given = (
        F.when(key % 5 == 0, F.lit("yesterday")).when(key % 5 == 1, F.lit("twodaysago"))
        .when(key % 5 == 2, F.date_format("o_orderdate", "yyyy/MM/dd")).when(key % 5 == 3, F.lit("2014-02-30"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    return fx.table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.day_path(given, today).alias("day"),
        dates.day_count(today, F.date_add(today, (key % 9).cast("int") - 1), 3).cast("bigint").alias("n_days"),
    )


@query
def log_name_of_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.when(F.col("page_id") % 2 == 0, F.replace("url", F.lit("http://"), F.lit("s3://"))).otherwise(
        F.concat(F.lit("s3://bucket/logs/"), F.col("page_id").cast("string"), F.lit("//")))
    return fx.table(spark, sf_dir, "pages").select(
        "page_id", text.storage_bucket(path).alias("bucket"), text.log_name_of_path(path).alias("log_name")
    )


@query
def ready_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = fx.planned_jobs(spark, sf_dir)
    ready = dates.ready_day(fixed_now(), F.col("time_log_need_to_be_available"), F.col("additional_arguments"))
    return jobs.select("job_id", F.date_format(ready, "yyyy-MM-dd").alias("ready"))


# -- streaming ---------------------------------------------------------------------------------------

@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_folder(spark, "stream")
    fx.order_lines(spark, sf_dir).write.text(f"{root}/in")
    ingest.ingest_stream(
        spark, f"{root}/in", fx.spec(fx.ORDERS_SPEC), f"{root}/out", f"{root}/checkpoint"
    ).awaitTermination()
    return _orders(ingest.ingested(spark, f"{root}/out", fx.spec(fx.ORDERS_SPEC), "orders"))


@query
def stream_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events streamed into day tables, then aged out and compacted there."""
    root = fresh_folder(spark, "aged")
    event = F.struct("event_id", "user_id", F.unix_timestamp("ts").alias("ts"))
    rows = fx.events(spark, sf_dir).select(F.to_json(event).alias("value"), F.date_format("ts", "yyyy-MM-dd").alias("day"))
    rows.write.partitionBy("day").text(f"{root}/in")
    spec = SchemaSpec({"events": parse_spec_table(_EVENTS_V1).with_sortkeys(["ts"])})
    ingest.ingest_stream(spark, f"{root}/in/*", spec, f"{root}/out", f"{root}/checkpoint", day_pattern=r"day=(\d{4})-(\d{2})-(\d{2})",
                         max_files_per_batch=20).awaitTermination()
    retention.delete_old(spark, f"{root}/out/events", spec.tables["events"], 7)
    retention.compact(spark, f"{root}/out/events", spec.tables["events"])
    kept = ingest.ingested(spark, f"{root}/out", spec, "events")
    return kept.select("event_id", shown("ts"), F.date_format("data_date", "yyyy-MM-dd").alias("data_date"))


@query
def stream_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_folder(spark, "daily")
    # a pattern, because a file stream takes a directory or a pattern but no single file
    source = spark.readStream.schema(fx.table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events.parque[t]")
    counts = daily.daily_counts(source.withColumn("ts", F.col("ts").cast("timestamp")))
    daily.write_final_days(counts, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema("day date, n_rows bigint").parquet(f"{root}/out").select(
        F.date_format("day", "yyyy-MM-dd").alias("day"), "n_rows"
    )


@query
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in three batches, the last with rows of all times: each is in a final day, in an open one or among the late rows."""
    root, events = fresh_folder(spark, "late"), fx.events(spark, sf_dir).select("event_id", "ts")
    held_back = F.col("event_id") % 10 == 0
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp")
    for part in (~held_back & early, ~held_back & ~early, held_back):
        events.where(part).write.mode("append").parquet(f"{root}/in")
        source = spark.readStream.schema(events.schema).parquet(f"{root}/in")
        daily.count_days(source, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return daily.counted_days(spark, f"{root}/out").select("state", F.date_format("day", "yyyy-MM-dd").alias("day"), "n_rows")


@query
def stream_ready_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six days whose markers appear in three batches, out of order, one never: what is extracted and loaded after each."""
    root, slot = fresh_folder(spark, "ready"), F.col("o_orderkey") % 6
    for n in range(6):
        fx.order_lines(spark, sf_dir, slot == n).write.option("compression", "gzip").text(f"{root}/in/2024/03/0{n + 1}")
    orders, seen = fx.spec(fx.ORDERS_SPEC), None
    for batch, marked in enumerate(([2, 3], [5, 1], [6]), 1):
        for n in marked:
            files.touch(spark, f"{root}/in/2024/03/0{n}/COMPLETE")
        ready.follow_days(spark, orders, [f"{root}/in"], date(2024, 3, 1), f"{root}/stage", f"{root}/out", f"{root}/checkpoint").awaitTermination()
        days = small_frame(spark, [(date(2024, 3, n),) for n in range(1, 7)], "day date")
        events = day_runs.ledger_events(spark, f"{root}/out/_ledger").where("status = 'success'")
        extracted = events.where("step = 'et'").select("day", F.lit(True).alias("extracted")).distinct()
        counts = day_runs.loaded_counts(spark, orders, f"{root}/out").where("table_name = 'orders'").select(F.col("data_date").alias("day"), "n_rows")
        rows = days.join(extracted, "day", "left").join(counts, "day", "left").select(
            F.lit(batch).alias("batch"), F.date_format("day", "yyyy-MM-dd").alias("day"), F.coalesce("extracted", F.lit(False)).alias("extracted"),
            F.coalesce("n_rows", F.lit(0)).alias("n_rows"))
        rows = stored(rows, "ready-seen")
        seen = rows if seen is None else seen.unionByName(rows)
    return seen


@query
def stream_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches, each with events of all times, and one later event that ends the wait for more."""
    root, order = fresh_folder(spark, "audit"), ["at", "event_id"]
    events = fx.status_events(spark, sf_dir)
    end = events.agg(F.lit(None).cast("bigint").alias("job_id"), F.lit(None).cast("string").alias("status"),
                     F.max(F.col("at") + F.make_dt_interval(F.lit(60))).alias("at"), F.lit(-1).cast("bigint").alias("event_id"))
    for part in (*[events.where(F.col("event_id") % 3 == n) for n in (2, 0, 1)], end):
        # a batch takes eight files: as many batches, however many tasks read the events
        part.repartition(8).write.mode("append").parquet(f"{root}/in")
    source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 8).parquet(f"{root}/in")
    audit.audit_stream(source, order, f"{root}/out", f"{root}/checkpoint", delay="40 days", slot="5 days").awaitTermination()
    return audit.audited(spark, f"{root}/out", events.schema, order).select("job_id", "event_id", "from_status", "to_status")
