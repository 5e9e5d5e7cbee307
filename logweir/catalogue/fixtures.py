"""Logs derived from the sample tables.

Documents are built row by row (one order, one line item, one text each), so making them needs no shuffle and
no document grows with the size of a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.plans.spec import SchemaSpec, TableSpec, parse_spec
from logweir.session import configure
from logweir.sources.lines import parse_lines

NOW = "2024-02-01 10:20:00"

ORDERS_SPEC = """
version: 3
tables:
  orders:
    src: order
    src_type: dict
    columns:
    - {log_key: id, sql_attr: int8 not null, is_mandatory: true}
    - {log_key: customer, sql_attr: int8}
    - {log_key: start_time, sql_attr: TIMESTAMP}
    - {log_key: status, sql_attr: varchar(1)}
    - {log_key: total, sql_attr: float8}
    - {log_key: session.agent, name: agent, sql_attr: varchar(16), is_foreign: true}
    sortkey_attr: [start_time]
"""

LINES_SPEC = """
version: 3
tables:
  lines:
    src: line
    src_type: dict
    columns:
    - {log_key: order_id, sql_attr: int8 not null distkey, is_mandatory: true}
    - {log_key: part, sql_attr: int8}
    - {log_key: number, sql_attr: int4}
    - {log_key: ship_time, sql_attr: TIMESTAMP}
    - {log_key: flags.status, name: flag_status, sql_attr: varchar(1), is_foreign: true}
    sortkey_attr: [ship_time]
  charges:
    src: line.charges
    src_type: list
    columns:
    - {log_key: index, sql_attr: smallint not null, is_mandatory: true}
    - {log_key: kind, sql_attr: varchar(16)}
    - {log_key: amount, sql_attr: float8}
    - {log_key: line.order_id, name: order_id, sql_attr: int8 distkey, is_foreign: true}
    - {log_key: line.number, name: number, sql_attr: int4, is_foreign: true}
    - {log_key: line.ship_time, name: ship_time, sql_attr: TIMESTAMP, is_foreign: true}
    sortkey_attr: [ship_time]
"""

SPARSE_SPEC = LINES_SPEC.replace("src_type: list", "src_type: sparse_list")

TEXT_SPEC = """
version: 1
tables:
  texts:
    src: doc
    src_type: dict
    columns:
    - {log_key: id, sql_attr: int8}
    - {log_key: lang, sql_attr: varchar(1)}
    - {log_key: source, sql_attr: varchar(12)}
    - {log_key: text, sql_attr: varchar(200)}
    sortkey_attr: []
"""

TEXT_LINES_SPEC = """
version: 1
tables:
  text_lines:
    src: doc.lines
    src_type: list
    columns:
    - {log_key: index, sql_attr: int4 not null, is_mandatory: true}
    - {log_key: value, sql_attr: varchar(65535)}
    - {log_key: doc.id, name: doc_id, sql_attr: int8, is_foreign: true}
    sortkey_attr: []
"""

CHARGES = (("quantity", "l_quantity"), ("price", "l_extendedprice"), ("discount", "l_discount"), ("tax", "l_tax"))


def spec(text: str) -> SchemaSpec:
    return parse_spec(text)


def table_spec(text: str, name: str) -> TableSpec:
    return parse_spec(text).tables[name]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def epoch(column: str) -> Column:
    return F.unix_timestamp(F.col(column).cast("timestamp"))


def order_fields(status: bool = True) -> Column:
    fields = [
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer"),
        epoch("o_orderdate").alias("start_time"),
        F.col("o_totalprice").alias("total"),
    ]
    if status:
        fields.insert(3, F.col("o_orderstatus").alias("status"))
    return F.struct(*fields)


def order_text(order: Column, **options) -> Column:
    session = F.struct(F.col("o_orderpriority").alias("agent"))
    return F.to_json(F.struct(order.alias("order"), session.alias("session")), options)


def order_lines(spark: SparkSession, sf_dir: str, where: Column | None = None) -> DataFrame:
    """``{"order": {...}, "session": {...}}`` per order."""
    orders = table(spark, sf_dir, "orders")
    orders = orders if where is None else orders.where(where)
    return orders.select(order_text(order_fields()).alias("value"))


def order_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_lines(order_lines(spark, sf_dir))


def order_docs_with_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status is absent for every fifth order and JSON null for the one after it."""
    slot = F.col("o_orderkey") % 5
    nulled = order_fields().withField("status", F.lit(None).cast("string"))
    text = (
        F.when(slot == 0, order_text(order_fields(status=False)))
        .when(slot == 1, order_text(nulled, ignoreNullFields="false"))
        .otherwise(order_text(order_fields()))
    )
    return parse_lines(table(spark, sf_dir, "orders").select(text.alias("value")))


def broken_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh line is cut in half, the one after it holds two documents."""
    text = F.col("value")
    number = F.get_json_object(text, "$.order.id").cast("bigint")
    broken = (
        F.when(number % 7 == 0, F.left(text, F.floor(F.length(text) / 2).cast("int")))
        .when(number % 7 == 1, F.concat(text, text))
        .otherwise(text)
    )
    return order_lines(spark, sf_dir).select(broken.alias("value"))


def line_docs(spark: SparkSession, sf_dir: str, sparse: bool = False) -> DataFrame:
    return parse_lines(item_lines(spark, sf_dir, sparse))


def item_lines(spark: SparkSession, sf_dir: str, sparse: bool = False) -> DataFrame:
    """``{"line": {..., "charges": [...]}, "flags": {...}}`` per line item; sparse: charges keyed by position."""
    charges = [F.struct(F.lit(k).alias("kind"), F.col(c).alias("amount")) for k, c in CHARGES]
    if sparse:
        listed = F.struct(*[c.alias(str(i)) for i, c in enumerate(charges)])
    else:
        listed = F.array(*charges)
    line = F.struct(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("part"),
        F.col("l_linenumber").alias("number"),
        epoch("l_shipdate").alias("ship_time"),
        listed.alias("charges"),
    )
    flags = F.struct(F.col("l_linestatus").alias("status"))
    text = F.to_json(F.struct(line.alias("line"), flags.alias("flags")))
    return table(spark, sf_dir, "lineitem").select(text.alias("value"))


def text_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``{"doc": {"id", "lang", "source", "text", "lines"}}`` per document; lines are a list of scalars."""
    doc = F.struct(
        F.col("doc_id").alias("id"), "lang", "source", "text", F.split("text", "\n", -1).alias("lines")
    )
    return parse_lines(
        table(spark, sf_dir, "documents").select(F.to_json(F.struct(doc.alias("doc"))).alias("value"))
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def status_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(job_id, day, load_status): a user is a job; a day with an error failed, one with a purchase is loaded."""
    kinds = F.col("event_type")
    failed, bought = F.bool_or(kinds == "error"), F.bool_or(kinds == "purchase")
    return (
        events(spark, sf_dir)
        .groupBy(F.col("user_id").alias("job_id"), F.to_date("ts").alias("day"))
        .agg(F.when(failed, F.lit("error")).when(bought, F.lit("complete")).alias("load_status"))
    )


def step_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(job_id, day, step, seq, status, error_info) from the events of each user."""
    kind, value = F.col("event_type"), F.col("value")
    status = (
        F.when((kind == "error") & (value >= 5), F.lit("error"))
        .when((kind == "signup") & (value >= 20), F.lit("cancelled"))
        .otherwise(F.lit("success"))
    )
    return events(spark, sf_dir).select(
        F.col("user_id").alias("job_id"), F.to_date("ts").alias("day"),
        F.when(kind.isin("purchase", "signup"), F.lit("load")).otherwise(F.lit("et")).alias("step"),
        F.col("event_id").alias("seq"), status.alias("status"),
        F.when(status == "error", F.concat(F.lit("event "), F.col("event_id").cast("string"))).alias("error_info"),
    )


def step_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(job_id, data_date, step, result, at, error_info): clicks and views start a step, the rest finishes one."""
    kind = F.col("event_type")
    result = F.when(kind.isin("purchase", "signup"), F.lit("success")).when(kind == "error", F.lit("error"))
    return events(spark, sf_dir).select(
        F.col("user_id").alias("job_id"), F.to_date("ts").alias("data_date"),
        F.when(F.col("event_id") % 2 == 0, F.lit("et")).otherwise(F.lit("load")).alias("step"),
        result.alias("result"), F.col("ts").alias("at"),
        F.when((kind == "error") & (F.col("value") >= 5), F.lit("boom")).alias("error_info"),
    )


def status_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(job_id, status, at, event_id): the events of a user read as status changes of a job; every ninth has no status."""
    kind = F.col("event_type")
    status = (
        F.when(F.col("event_id") % 9 == 0, F.lit(None).cast("string"))
        .when(kind == "signup", F.lit("scheduled")).when(kind == "click", F.lit("running"))
        .when(kind == "view", F.lit("success")).when(kind == "purchase", F.lit("null")).otherwise(F.lit("error"))
    )
    return events(spark, sf_dir).select(
        F.col("user_id").alias("job_id"), status.alias("status"), F.col("ts").alias("at"), "event_id"
    )


def job_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job records, one per event: status, update time, retry state and requested actions."""
    kind, number = F.col("event_type"), F.col("event_id")
    status = (
        F.when(kind == "click", F.lit("scheduled")).when(kind == "view", F.lit("running"))
        .when(kind == "error", F.lit("error")).when(kind == "purchase", F.lit("success")).otherwise(F.lit("paused"))
    )
    return events(spark, sf_dir).select(
        number.alias("job_id"), F.col("user_id"), F.col("ts").alias("at"), status.alias("et_status"),
        F.when(number % 11 != 0, F.col("ts")).alias("et_status_last_updated_at"),
        F.when(number % 13 != 0, (number % 20).cast("int")).alias("et_num_error_retries"),
        F.when(number % 5 != 0, F.timestamp_seconds(F.unix_seconds("ts") + number % 40 * 86400))
            .alias("et_next_error_retry_attempt"),
        F.to_date("ts").alias("et_last_successful_date"),
        F.when(number % 3 != 0, (number % 17 == 0).cast("int")).alias("cancel_requested"),
        F.when(number % 3 != 1, (number % 19 == 0).cast("int")).alias("pause_requested"),
        F.when(number % 3 != 2, (number % 23 == 0).cast("int")).alias("delete_requested"),
    )


def planned_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as jobs with a day range, a cluster and a readiness delay."""
    key = F.col("c_custkey")
    start = F.date_add(F.lit("2024-01-01").cast("date"), (key % 40).cast("int"))
    segment = F.col("c_mktsegment")
    return table(spark, sf_dir, "customer").select(
        key.alias("job_id"), F.col("c_nationkey").alias("cluster_id"), start.alias("start_date"),
        F.when(key % 3 != 0, F.date_add(start, (key % 50).cast("int"))).alias("end_date"),
        F.when(key % 4 != 0, F.date_add(start, (key % 7).cast("int"))).alias("et_last_successful_date"),
        F.when(segment == "BUILDING", F.lit("error")).when(segment == "MACHINERY", F.lit("success"))
            .otherwise(F.lit("null")).alias("et_status"),
        F.when(key % 6 == 0, F.lit("24:30")).alias("time_log_need_to_be_available"),
        F.when(key % 9 == 0, F.lit('{"time_log_need_to_be_available": "12:15"}')).otherwise(F.lit("{}"))
            .alias("additional_arguments"),
        (key % 31 == 0).cast("int").alias("cancel_requested"),
        F.lit(0).alias("pause_requested"), F.lit(0).alias("delete_requested"),
    )


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("cluster_id"), F.concat(F.lower("n_name"), F.lit(".example.org")).alias("host"),
        (F.lit(5000) + F.col("n_nationkey")).alias("port"), F.lit("public").alias("db_schema"),
    )


def sql_quoted(text: Column) -> Column:
    """A text as a quoted literal of a SQL dump."""
    for plain, escaped in (("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return F.concat(F.lit("'"), text, F.lit("'"))


def insert_line(name: str, columns: list[tuple[str, Column]]) -> Column:
    """One INSERT statement; NULL values are written as the word."""
    names = ", ".join(f"`{n}`" for n, _ in columns)
    values = F.concat_ws(", ", *[F.coalesce(c, F.lit("NULL")) for _, c in columns])
    return F.concat(F.lit(f"INSERT INTO `{name}` ({names}) VALUES ("), values, F.lit(");"))
