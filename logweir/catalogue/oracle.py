"""DuckDB SQL per query, over the same tables."""

from __future__ import annotations

NOW = "TIMESTAMP '2024-02-01 10:20:00'"
STAMP = "'%Y-%m-%d %H:%M:%S'"
DAY = "'%Y-%m-%d'"

ORDERS = f"""
SELECT o_orderkey AS id, o_custkey AS customer, strftime(o_orderdate, {STAMP}) AS start_time,
       o_orderstatus AS status, o_totalprice AS total, o_orderpriority AS agent
FROM orders"""

CHARGES = " UNION ALL ".join(
    f"""SELECT CAST({i} AS SMALLINT) AS "index", '{kind}' AS kind, {column} AS amount, l_orderkey AS order_id,
        l_linenumber AS number, strftime(l_shipdate, {STAMP}) AS ship_time FROM lineitem"""
    for i, (kind, column) in enumerate(
        (("quantity", "l_quantity"), ("price", "l_extendedprice"), ("discount", "l_discount"), ("tax", "l_tax"))
    )
)

ESCAPED = r"replace(replace(replace(replace({0}, '\', '\\'), chr(10), '\n'), chr(13), '\r'), '|', '\|')"

ORDER_DAYS = "SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders"

STATUS_DAYS = """
SELECT user_id AS job_id, CAST(ts AS DATE) AS day,
       CASE WHEN bool_or(event_type = 'error') THEN 'error'
            WHEN bool_or(event_type = 'purchase') THEN 'complete' END AS load_status
FROM events GROUP BY 1, 2"""

FIRST_DAY = "(SELECT CAST(min(ts) AS DATE) FROM events)"


def frontier(retry: bool) -> str:
    stop = "false" if retry else "coalesce(load_status = 'error', false)"
    open_day = "load_status IS NULL" + (" OR load_status = 'error'" if retry else "")
    return f"""
WITH s AS ({STATUS_DAYS}),
n AS (SELECT *, day - {FIRST_DAY} AS off, row_number() OVER (PARTITION BY job_id ORDER BY day) - 1 AS rn FROM s),
m AS (SELECT *, max(CASE WHEN off <> rn OR {stop} THEN 1 ELSE 0 END)
             OVER (PARTITION BY job_id ORDER BY day ROWS UNBOUNDED PRECEDING) AS stopped FROM n)
SELECT job_id, strftime(day, {DAY}) AS day FROM m WHERE stopped = 0 AND ({open_day})"""


RESULTS = """
SELECT user_id AS job_id, CAST(ts AS DATE) AS day,
       CASE WHEN event_type IN ('purchase', 'signup') THEN 'load' ELSE 'et' END AS step, event_id AS seq,
       CASE WHEN event_type = 'error' AND value >= 5 THEN 'error'
            WHEN event_type = 'signup' AND value >= 20 THEN 'cancelled' ELSE 'success' END AS status
FROM events"""

JOBS = """
SELECT event_id AS job_id, ts AS stamp,
       CASE event_type WHEN 'click' THEN 'scheduled' WHEN 'view' THEN 'running' WHEN 'error' THEN 'error'
            WHEN 'purchase' THEN 'success' ELSE 'paused' END AS et_status,
       CASE WHEN event_id % 11 <> 0 THEN ts END AS updated_at,
       CASE WHEN event_id % 13 <> 0 THEN CAST(event_id % 20 AS INTEGER) END AS retries,
       CASE WHEN event_id % 5 <> 0
            THEN date_trunc('second', ts) + to_days(CAST(event_id % 40 AS INTEGER)) END AS next_retry,
       CASE WHEN event_id % 3 <> 0 AND event_id % 17 = 0 THEN 1 ELSE 0 END AS cancel_requested,
       CASE WHEN event_id % 3 <> 1 AND event_id % 19 = 0 THEN 1 ELSE 0 END AS pause_requested,
       CASE WHEN event_id % 3 <> 2 AND event_id % 23 = 0 THEN 1 ELSE 0 END AS delete_requested
FROM events"""

PLANNED = f"""
SELECT *, CAST({NOW} - CASE WHEN c_custkey % 9 = 0 THEN INTERVAL '12 hours 15 minutes'
                            WHEN c_custkey % 6 = 0 THEN INTERVAL '24 hours 30 minutes'
                            ELSE INTERVAL '48 hours' END AS DATE) AS ready
FROM (SELECT c_custkey, c_nationkey, c_mktsegment,
             DATE '2024-01-01' + CAST(c_custkey % 40 AS INTEGER) AS start_date,
             CASE WHEN c_custkey % 3 <> 0
                  THEN DATE '2024-01-01' + CAST(c_custkey % 40 + c_custkey % 50 AS INTEGER) END AS end_date,
             CASE WHEN c_custkey % 4 <> 0
                  THEN DATE '2024-01-01' + CAST(c_custkey % 40 + c_custkey % 7 AS INTEGER) END AS last_ok
      FROM customer)"""

EVOLVED_EVENTS = f"""
SELECT event_id, strftime(ts, {STAMP}) AS ts, CASE WHEN day(ts + INTERVAL 12 HOUR) % 2 = 1 THEN 'before' ELSE event_type END AS event_type,
       CASE WHEN day(ts + INTERVAL 12 HOUR) % 2 = 0 THEN value END AS value, strftime(ts + INTERVAL 12 HOUR, {DAY}) AS data_date
FROM events"""

TRANSITIONS = f"""
WITH e AS (SELECT user_id AS job_id, event_id, ts,
       CASE WHEN event_id % 9 = 0 OR event_type = 'purchase' THEN 'null' WHEN event_type = 'signup' THEN 'scheduled'
            WHEN event_type = 'click' THEN 'running' WHEN event_type = 'view' THEN 'success' ELSE 'error' END AS to_status FROM events),
c AS (SELECT job_id, event_id, to_status,
             coalesce(lag(to_status) OVER (PARTITION BY job_id ORDER BY ts, event_id), 'null') AS from_status FROM e)
SELECT job_id, event_id, from_status, to_status FROM c
WHERE (from_status, to_status) NOT IN (('null', 'scheduled'), ('scheduled', 'null'), ('scheduled', 'running'),
  ('running', 'cancelled'), ('running', 'null'), ('running', 'running'), ('running', 'success'),
  ('running', 'error'), ('running', 'complete'), ('running', 'paused'), ('success', 'scheduled'),
  ('cancelled', 'null'), ('complete', 'null'), ('error', 'null'), ('paused', 'null'), ('paused', 'success'))"""

PREFIXED = """
SELECT day, priority, CASE priority WHEN 0 THEN 's3://logs/main' ELSE 's3://logs/backup' END AS clean,
       CASE priority WHEN 0 THEN 's3://logs//main/' ELSE 's3://logs/backup' END AS prefix
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders), (VALUES (0), (1)) AS p(priority)"""

TTL = """ts >= (SELECT CASE WHEN CAST(max(ts) AS DATE) - CAST(min(ts) AS DATE) > 7
                     THEN CAST(CAST(max(ts) AS DATE) - 7 AS TIMESTAMP) ELSE min(ts) END FROM events)"""

ORACLE = {
    "extract_dict": ORDERS,
    "extract_list": CHARGES,
    "extract_sparse_list": CHARGES,
    "extract_list_of_scalars": """
SELECT CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS "index", unnest(parts) AS value, doc_id
FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)""",
    "extract_null_vs_absent": """
SELECT o_orderkey AS id,
       CASE o_orderkey % 5 WHEN 0 THEN 'absent' WHEN 1 THEN 'null' ELSE 'present' END AS state,
       CASE WHEN o_orderkey % 5 > 1 THEN o_orderstatus END AS status,
       CASE WHEN o_orderkey % 5 > 1 THEN o_orderstatus ELSE '?' END AS status_or_default
FROM orders""",
    "extract_mandatory": f"""
SELECT o_orderkey AS id, o_custkey AS customer, strftime(o_orderdate, {STAMP}) AS start_time,
       CASE WHEN o_orderkey % 5 <> 1 THEN o_orderstatus END AS status, o_totalprice AS total,
       o_orderpriority AS agent
FROM orders WHERE o_orderkey % 5 <> 0""",
    "extract_mandatory_quarantine": """
SELECT o_orderkey AS id, 'required key missing' AS error_reason, 'orders: order: status' AS error_detail,
       CAST(NULL AS BIGINT) AS line_number
FROM orders WHERE o_orderkey % 5 = 0""",
    "extract_timestamp": f"""
SELECT o_orderkey AS id, strftime(o_orderdate, {STAMP}) AS seconds, strftime(o_orderdate, {STAMP}) AS millis,
       strftime(o_orderdate, {STAMP}) AS fraction, CAST(NULL AS VARCHAR) AS bad
FROM orders""",
    "extract_json_blob": """
SELECT event_id AS id, '{"k":' || (props->>'k') || '}' AS props, 'null' AS nothing FROM events""",
    "extract_blob_limit": """
SELECT doc_id AS id, CASE WHEN n <= 65535 THEN n END AS body_length
FROM (SELECT doc_id, length(CAST(to_json({'text': repeat(text, 4)}) AS VARCHAR)) AS n FROM documents)""",
    "extract_derived": """
SELECT l_orderkey AS order_id, CAST(i AS SMALLINT) AS "index", l_orderkey % 2 = 0 AS odd_or_even,
       l_linenumber || '/' || i AS line_and_index
FROM lineitem, (VALUES (0), (1), (2), (3)) AS p(i)""",
    "extract_fanout_counts": """
SELECT 'lines' AS table_name, count(*) AS n_rows FROM lineitem
UNION ALL SELECT 'charges', 4 * count(*) FROM lineitem""",
    "extract_staged": """
SELECT 'lines' AS table_name, count(*) AS n_rows, CAST(sum(l_orderkey) AS BIGINT) AS order_ids,
       CAST(sum(l_partkey) AS BIGINT) AS v_sum FROM lineitem
UNION ALL SELECT 'charges', 4 * count(*), CAST(4 * sum(l_orderkey) AS BIGINT), 6 * count(*) FROM lineitem""",
    "quarantine_bad_lines": """
SELECT o_orderkey AS id, 'line is not one JSON document that can be parsed' AS error_reason, CAST(NULL AS BIGINT) AS line_number
FROM orders WHERE o_orderkey % 7 < 2""",
    "good_lines": ORDERS + " WHERE o_orderkey % 7 >= 2",
    "truncation_report": """
SELECT * FROM (
  SELECT 'texts' AS table_name, 'lang' AS column_name, count(*) FILTER (WHERE length(lang) > 1) AS n_too_long FROM documents
  UNION ALL SELECT 'texts', 'source', count(*) FILTER (WHERE length(source) > 12) FROM documents
  UNION ALL SELECT 'texts', 'text', count(*) FILTER (WHERE length(text) > 200) FROM documents)
WHERE n_too_long > 0""",
    "truncate_columns": """
SELECT doc_id AS id, left(lang, 1) AS lang, left(source, 12) AS source, left(text, 200) AS text FROM documents""",
    "reassemble_parent_child": """
SELECT o_orderkey AS id, o_custkey AS customer, o_orderpriority AS agent, n_charges, price
FROM orders JOIN (SELECT l_orderkey, 4 * count(*) AS n_charges, round(sum(l_extendedprice), 2) AS price
                  FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""",
    "psv_lines": f"""
SELECT doc_id || '|' || coalesce({ESCAPED.format('text')}, '') || '|' || coalesce({ESCAPED.format('lang')}, '')
       || '|' || coalesce({ESCAPED.format('source')}, '') AS value
FROM documents""",
    "psv_roundtrip": r"""
SELECT 'documents' AS origin, doc_id AS id, 'a\|b\' || text || '\\n|' AS body FROM documents
UNION ALL SELECT 'pages', page_id, coalesce(html, '') FROM pages""",
    "psv_roundtrip_record_separator": """
SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS body FROM conversations""",
    "psv_files_roundtrip": CHARGES,
    "day_paths": f"""
SELECT strftime(day, {DAY}) AS day, CAST(priority AS INTEGER) AS priority,
       clean || '/' || strftime(day, '%Y/%m/%d') || '/part-*.gz' AS input,
       clean || '/' || strftime(day, '%Y/%m/%d') || '/COMPLETE' AS marker
FROM ({PREFIXED})""",
    "complete_days": f"""
SELECT strftime(day, {DAY}) AS day, CAST(priority AS INTEGER) AS priority FROM ({PREFIXED})
WHERE CASE priority WHEN 0 THEN day(day) % 2 = 0 ELSE day(day) % 3 = 0 END""",
    "first_complete_prefix": f"""
SELECT strftime(day, {DAY}) AS day,
       CASE WHEN day(day) % 2 = 0 THEN 's3://logs//main/' WHEN day(day) % 3 = 0 THEN 's3://logs/backup' END AS prefix
FROM ({ORDER_DAYS})""",
    "days_to_run": f"""
SELECT strftime(CAST(o_orderdate AS DATE), {DAY}) AS day FROM orders
GROUP BY CAST(o_orderdate AS DATE)
HAVING day(CAST(o_orderdate AS DATE)) % 2 = 1 AND NOT bool_or(o_orderpriority = '1-URGENT')""",
    "file_lineage": """
SELECT o_orderkey AS id, '2024-03-0' || (o_orderkey % 3 + 1) AS data_date,
       '2024/03/0' || (o_orderkey % 3 + 1) AS day_folder
FROM orders""",
    "day_range_results": """
SELECT '2024-03-01' AS day, 'et' AS step, CAST(NULL AS VARCHAR) AS table_name, 'success' AS status, 0 AS n_rows
UNION ALL SELECT '2024-03-02', 'et', NULL, 'success', 0
UNION ALL SELECT '2024-03-03', 'et', NULL, 'error', 0
UNION ALL SELECT '2024-03-03', 'load', NULL, 'error', 0
UNION ALL SELECT '2024-03-01', 'load', 'orders', 'success', count(*) FROM orders WHERE o_orderkey % 3 = 0
UNION ALL SELECT '2024-03-02', 'load', 'orders', 'success', count(*) FROM orders WHERE o_orderkey % 3 = 1
UNION ALL SELECT '2024-03-01', 'load', 'pipeline_errors', 'success', 0
UNION ALL SELECT '2024-03-02', 'load', 'pipeline_errors', 'success', 0""",
    "insert_dump": """
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, CAST(NULL AS VARCHAR) AS s_note FROM supplier""",
    "day_range_after_spec_bump": """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 2 THEN 'new' ELSE 'none' END AS note,
       CAST(CASE WHEN o_orderkey % 3 < 2 THEN 7 WHEN o_orderkey % 2 = 0 THEN 1 END AS INTEGER) AS priority,
       '2024-03-0' || (o_orderkey % 3 + 1) AS data_date
FROM orders""",
    "day_rerun_replaces": """
SELECT 'orders' AS table_name, '2024-03-0' || (o_orderkey % 2 + 1) AS data_date, count(*) AS n_rows FROM orders GROUP BY 2""",
    "insert_dump_quarantine": """
SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN 'error' ELSE 'row' END AS outcome FROM supplier""",
    "insert_dump_text": r"""
SELECT doc_id, 'it''s (a), \ ''b''' || text AS body, lang FROM documents""",
    "infer_columns": """
WITH o AS (SELECT *, CAST(epoch(o_orderdate) AS BIGINT) AS st FROM orders)
SELECT 'order.id' AS path, 'int' AS type, max(length(CAST(o_orderkey AS VARCHAR))) AS max_len, false AS is_json, false AS is_foreign FROM o
UNION ALL SELECT 'order.customer', 'int', max(length(CAST(o_custkey AS VARCHAR))), false, false FROM o
UNION ALL SELECT 'order.start_time', 'int', max(length(CAST(st AS VARCHAR))), false, false FROM o
UNION ALL SELECT 'order.status', 'str', max(length(o_orderstatus)) + 2, false, false FROM o
UNION ALL SELECT 'order.total', 'float', max(length(CAST(o_totalprice AS VARCHAR))), false, false FROM o
UNION ALL SELECT 'session.agent', 'str', max(length(o_orderpriority)) + 2, false, false FROM o""",
    "infer_depth_prune": """
SELECT * FROM (VALUES
  ('depth', 'line.order_id', 'int', false, false), ('depth', 'line.number', 'int', false, false),
  ('depth', 'line.ship_time', 'int', false, false), ('depth', 'line.charges', 'list', true, false),
  ('depth', 'flags', 'dict', true, false), ('list', 'kind', 'str', false, false),
  ('list', 'amount', 'float', false, false), ('list', 'line.order_id', 'int', false, true))
AS t(source, path, type, is_json, is_foreign)""",
    "infer_spec": """
SELECT o_orderkey AS order_id, o_custkey AS order_customer, CAST(epoch(o_orderdate) AS BIGINT) AS order_start_time,
       o_orderstatus AS order_status, o_totalprice AS order_total, o_orderpriority AS session_agent
FROM orders""",
    "evolve_add_column": """
SELECT p_partkey, p_name,
       CAST(CASE WHEN p_partkey % 2 = 0 THEN 7 WHEN p_size <> 5 THEN p_size END AS INTEGER) AS p_size,
       CAST(NULL AS VARCHAR) AS p_note
FROM part""",
    "evolve_catalog_tables": """
SELECT p_partkey, p_name,
       CAST(CASE WHEN p_partkey % 2 = 0 THEN 7 WHEN p_size <> 5 THEN p_size END AS INTEGER) AS p_size,
       CAST(NULL AS VARCHAR) AS p_note
FROM part""",
    "column_diff": """
WITH first AS (SELECT table_name, column_name FROM information_schema.columns WHERE ordinal_position = 1
               AND table_name IN ('nation', 'part', 'orders', 'lineitem', 'events'))
SELECT table_name, column_name, 'store' AS side FROM first UNION ALL SELECT table_name, 'added', 'spec' FROM first""",
    "row_presence": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, count(*) > 0 AS has_rows FROM {t}"
        for t in ("region", "nation", "supplier", "customer", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
                  "benchmark", "labels", "conversations")
    ),
    "ttl_keep": f"SELECT event_id, user_id, strftime(ts, {STAMP}) AS ts FROM events WHERE {TTL}",
    "ttl_delete": f"""
SELECT event_id, strftime(ts, {STAMP}) AS ts, strftime(ts + INTERVAL 12 HOUR, {DAY}) AS data_date
FROM events WHERE {TTL}""",
    "compacted": f"""
SELECT strftime(ts + INTERVAL 12 HOUR, {DAY}) AS data_date, count(*) AS n_rows FROM events GROUP BY 1""",
    "compacted_after_evolution": EVOLVED_EVENTS,
    "ttl_delete_after_evolution": f"{EVOLVED_EVENTS} WHERE {TTL}",
    "layout_stats": f"""
SELECT l_suppkey, count(*) AS n_rows, CAST(sum(l_orderkey) AS BIGINT) AS order_keys,
       round(sum(l_quantity), 2) AS quantity, strftime(max(l_shipdate), {DAY}) AS last_ship
FROM lineitem GROUP BY 1""",
    "load_frontier": frontier(False),
    "load_frontier_retry": frontier(True),
    "stand_in_status": f"""
SELECT job_id, strftime(DATE '2024-01-01' + CAST(n AS INTEGER), {DAY}) AS day
FROM (SELECT DISTINCT user_id AS job_id FROM events), range(10) AS r(n)""",
    "success_prefix": f"""
WITH r AS ({RESULTS}),
w AS (SELECT *, sum(CASE WHEN status <> 'success' THEN 1 ELSE 0 END)
             OVER (PARTITION BY job_id ORDER BY day, seq ROWS UNBOUNDED PRECEDING) AS bad FROM r),
f AS (SELECT job_id, min(day) AS stop_day, min_by(status, (day, seq)) AS stop_status, min_by(seq, (day, seq)) AS stop_seq
      FROM w WHERE bad = 1 AND status <> 'success' GROUP BY 1),
j AS (SELECT r.job_id, max(r.day) AS end_date, any_value(f.stop_status) AS stop_status, any_value(f.stop_seq) AS stop_seq,
             max(CASE WHEN f.stop_day IS NULL OR r.day < f.stop_day THEN r.day END) AS last_ok
      FROM r LEFT JOIN f USING (job_id) GROUP BY 1)
SELECT job_id, CASE WHEN stop_status = 'error' THEN 'error' WHEN stop_status IS NULL AND last_ok = end_date THEN 'complete'
                    ELSE 'success' END AS status,
       strftime(last_ok, {DAY}) AS last_ok_day,
       CASE WHEN stop_status = 'error' THEN 'event ' || stop_seq END AS error_info
FROM j""",
    "next_loadable_day": f"""
WITH r AS ({RESULTS}),
d AS (SELECT job_id, day, max_by(status, seq) FILTER (WHERE step = 'et') AS et_status,
             max_by(status, seq) FILTER (WHERE step = 'load') AS load_status FROM r GROUP BY 1, 2),
n AS (SELECT *, day - {FIRST_DAY} AS off, row_number() OVER w - 1 AS rn,
             coalesce(min(CASE WHEN load_status = 'success' THEN 1 ELSE 0 END)
                      OVER (PARTITION BY job_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS before
      FROM d WINDOW w AS (PARTITION BY job_id ORDER BY day))
SELECT job_id, strftime(day, {DAY}) AS day FROM n
WHERE off = rn AND before = 1 AND load_status IS NULL AND et_status = 'success'""",
    "run_rows": f"""
WITH s AS (SELECT user_id AS job_id, CAST(ts AS DATE) AS data_date, ts AS stamp,
                  CASE WHEN event_id % 2 = 0 THEN 'et' ELSE 'load' END AS step,
                  CASE WHEN event_type IN ('purchase', 'signup') THEN 'success' WHEN event_type = 'error' THEN 'error' END AS result,
                  CASE WHEN event_type = 'error' AND value >= 5 THEN 'boom' END AS info FROM events),
b AS (SELECT *, max(CASE WHEN result IS NULL THEN stamp END)
             OVER (PARTITION BY job_id, data_date, step ORDER BY stamp ROWS UNBOUNDED PRECEDING) AS begun FROM s),
f AS (SELECT *, row_number() OVER (PARTITION BY job_id, data_date, step ORDER BY stamp DESC) AS nth FROM b WHERE result IS NOT NULL),
t AS (SELECT job_id, data_date,
             max(CASE WHEN step = 'et' THEN epoch_us(stamp) - epoch_us(coalesce(begun, stamp)) END) AS et_us,
             max(CASE WHEN step = 'load' THEN epoch_us(stamp) - epoch_us(coalesce(begun, stamp)) END) AS load_us,
             arg_max(CASE WHEN result <> 'success' THEN coalesce(info, 'None') ELSE '' END, stamp) AS err
      FROM f WHERE nth = 1 GROUP BY 1, 2),
a AS (SELECT job_id, data_date, arg_max(step || '_' || coalesce(result, 'started'), stamp) AS etl_status,
             max(CASE WHEN step = 'et' AND result IS NULL THEN stamp END) AS et_start,
             max(CASE WHEN step = 'load' AND result IS NULL THEN stamp END) AS load_start FROM s GROUP BY 1, 2)
SELECT a.job_id, strftime(a.data_date, {DAY}) AS data_date, etl_status, strftime(et_start, {STAMP}) AS et_starttime,
       round(et_us / 1e6, 3) AS et_runtime, strftime(load_start, {STAMP}) AS load_starttime,
       round(load_us / 1e6, 3) AS load_runtime, nullif(err, '') AS etl_error
FROM a LEFT JOIN t USING (job_id, data_date)""",
    "ledger_current": f"""
SELECT user_id, event_id, strftime(ts, {STAMP}) AS ts, event_type, value,
       'c1:' || event_type || ':' || user_id || ':' || strftime(ts, {DAY}) || ':None' AS job_key
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS nth FROM events) WHERE nth = 1""",
    "stuck_rows": f"""
SELECT job_id, et_status FROM ({JOBS})
WHERE (et_status = 'scheduled' AND TIMESTAMP '2024-01-20' - updated_at > INTERVAL '349200 seconds')
   OR (et_status = 'running' AND TIMESTAMP '2024-01-20' - updated_at > INTERVAL '300 seconds')""",
    "retry_due": f"""
SELECT job_id, retries AS et_num_error_retries FROM ({JOBS})
WHERE et_status = 'error' AND ((coalesce(next_retry, {NOW}) <= {NOW} AND coalesce(retries, 16) < 16)
      OR cancel_requested = 1 OR pause_requested = 1 OR delete_requested = 1)""",
    "retry_plan": f"""
SELECT job_id, et_status,
       CASE WHEN et_status = 'error' THEN coalesce(retries, -1) + 1 WHEN et_status <> 'success' THEN retries END AS et_num_error_retries,
       strftime(CASE WHEN et_status = 'error' AND coalesce(retries, -1) + 1 < 16
                     THEN stamp + to_seconds(CAST(300 * 2 ** (coalesce(retries, -1) + 1) AS BIGINT))
                     WHEN et_status <> 'success' THEN next_retry END, {STAMP}) AS et_next_error_retry_attempt
FROM ({JOBS})""",
    "display_status": f"""
SELECT job_id, CASE WHEN delete_requested = 1 THEN 'deleting' WHEN cancel_requested = 1 THEN 'cancelling'
                    WHEN pause_requested = 1 AND et_status <> 'paused' THEN 'pausing'
                    WHEN pause_requested = 0 AND et_status = 'paused' THEN 'resuming' ELSE et_status END AS shown_status
FROM ({JOBS})""",
    "work_plan": f"""
SELECT c_custkey AS job_id, c_nationkey AS cluster_id, lower(n_name) || '.example.org' AS host,
       CAST(5000 + n_nationkey AS INTEGER) AS port, 'public' AS db_schema, strftime(d, {DAY}) AS day
FROM (SELECT *, unnest(generate_series(CAST(greatest(start_date, last_ok + 1) AS TIMESTAMP),
                                       CAST(least(end_date, ready) AS TIMESTAMP), INTERVAL 1 DAY)) AS d
      FROM ({PLANNED})
      WHERE c_mktsegment <> 'BUILDING'
        AND ((start_date <= ready AND (last_ok IS NULL OR last_ok + 1 <= ready)) OR c_custkey % 31 = 0))
JOIN nation ON n_nationkey = c_nationkey""",
    "transition_audit": TRANSITIONS,
    "stream_audit": TRANSITIONS,
    "versions_by_name": """
SELECT log_name, string_agg(version, ',' ORDER BY version) AS versions
FROM (SELECT DISTINCT replace(p_brand, '#', '_') AS log_name, 'v' || p_size AS version FROM part WHERE p_partkey % 10 <> 0)
GROUP BY 1""",
    "job_search": """
SELECT c_custkey, c_name, c_mktsegment FROM customer
WHERE (contains(lower(c_name), '00007') OR contains(lower(c_name), '#00000012'))
  AND (contains(lower(c_mktsegment), 'build') OR contains(lower(c_mktsegment), 'mach'))""",
    "normalise_days": """
SELECT o_orderkey,
       CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate - INTERVAL 1 DAY, '%Y/%m/%d')
            WHEN 1 THEN strftime(o_orderdate - INTERVAL 2 DAY, '%Y/%m/%d') WHEN 4 THEN strftime(o_orderdate, '%Y/%m/%d') END AS day,
       CAST(ceil((o_orderkey % 9) / 3.0) AS BIGINT) AS n_days
FROM orders""",
    "log_name_of_path": r"""
WITH p AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN replace(url, 'http://', 's3://')
                                ELSE 's3://bucket/logs/' || page_id || '//' END AS path FROM pages)
SELECT page_id, nullif(regexp_extract(path, '^s3://([^/]*)/', 1), '') AS bucket,
       CASE WHEN regexp_matches(path, '^s3://[^/]*/')
            THEN nullif(regexp_extract(path, '^s3://[^/]*/(?:.*/)?([^/]+)/*$', 1), '') END AS log_name
FROM p""",
    "ready_days": f"SELECT c_custkey AS job_id, strftime(ready, {DAY}) AS ready FROM ({PLANNED})",
    "stream_ingest": ORDERS,
    "stream_retention": f"""
SELECT event_id, strftime(ts, {STAMP}) AS ts, strftime(ts, {DAY}) AS data_date FROM events
WHERE date_trunc('second', ts) >= CAST((SELECT CAST(max(ts) AS DATE) - 7 FROM events) AS TIMESTAMP)""",
    "earlier_later_days": f"""
WITH d AS (SELECT o_orderkey, strftime(o_orderdate, {DAY}) AS a,
                  CASE WHEN o_orderkey % 3 = 1 THEN strftime(CAST(o_orderdate AS DATE) + 3, {DAY}) END AS b FROM orders)
SELECT o_orderkey, least(a, coalesce(b, a)) AS first, greatest(a, coalesce(b, a)) AS last FROM d""",
    "stream_daily_counts": f"""
SELECT strftime(CAST(ts AS DATE), {DAY}) AS day, count(*) AS n_rows FROM events GROUP BY CAST(ts AS DATE)
HAVING CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) <= (SELECT max(ts) - INTERVAL 48 HOUR FROM events)""",
    "day_load_interrupted": """
WITH o AS (SELECT '2024-03-0' || (o_orderkey % 3 + 1) AS data_date, o_totalprice AS total FROM orders)
SELECT 'stopped' AS seen, data_date, count(*) AS n_rows, round(sum(total), 2) AS total FROM o GROUP BY data_date
UNION ALL SELECT 'loaded', data_date, count(*), 0.0 FROM o WHERE data_date < '2024-03-03' GROUP BY data_date""",
    "day_claimed_once": """
SELECT '2024-03-0' || (o_orderkey % 3 + 1) AS data_date, 1 AS n_started, count(*) AS n_rows FROM orders WHERE o_orderkey % 3 < 2 GROUP BY 1""",
    "ledger_runs": """
SELECT '2024-03-01' AS data_date, 'load_success' AS etl_status, true AS load_started, true AS timed, CAST(NULL AS VARCHAR) AS etl_error, 0 AS n_loaded_again
FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1
UNION ALL SELECT '2024-03-02', 'load_success', true, true, NULL, 2 FROM orders WHERE o_orderkey % 3 = 1 GROUP BY 1
UNION ALL SELECT '2024-03-03', 'load_error', false, true, 'not extracted: no complete prefix', 0 FROM orders WHERE o_orderkey % 3 = 2 GROUP BY 1""",
    "ttl_delete_catalog": f"""
SELECT event_id, strftime(ts, {STAMP}) AS ts, strftime(ts + INTERVAL 12 HOUR, {DAY}) AS data_date,
       ts >= (SELECT CAST(max(ts) AS DATE) - 3 FROM events) AS recent
FROM events WHERE {TTL}""",
    "stream_late_rows": f"""
WITH b AS (SELECT CAST(max(ts) FILTER (event_id % 10 <> 0) - INTERVAL 48 HOUR AS DATE) AS before, CAST(max(ts) - INTERVAL 48 HOUR AS DATE) AS after FROM events),
e AS (SELECT CAST(ts AS DATE) AS day, CASE WHEN event_id % 10 = 0 AND CAST(ts AS DATE) < before THEN 'late' WHEN CAST(ts AS DATE) < after THEN 'final' ELSE 'open' END AS state
      FROM events, b)
SELECT state, strftime(day, {DAY}) AS day, count(*) AS n_rows FROM e GROUP BY ALL""",
    "stream_ready_days": """
WITH n AS (SELECT o_orderkey % 6 + 1 AS d, count(*) AS n FROM orders GROUP BY 1),
m(d, since) AS (VALUES (2, 1), (3, 1), (5, 2), (1, 2), (6, 3)),
b(batch) AS (VALUES (1), (2), (3))
SELECT batch, '2024-03-0' || n.d AS day, coalesce(since <= batch, false) AS extracted, CASE WHEN n.d <= 3 AND batch >= 2 THEN n ELSE 0 END AS n_rows
FROM n CROSS JOIN b LEFT JOIN m USING (d)""",
    "reassemble_stored": """
SELECT l_orderkey AS order_id, count(*) AS n_lines, CAST(sum(l_partkey) AS BIGINT) AS parts, 4 * count(*) AS n_charges, round(sum(l_extendedprice), 2) AS price
FROM lineitem GROUP BY 1""",
    "gzip_spread": ORDERS,
    "job_lookup": """
WITH e AS (SELECT event_id, user_id AS job_id, 'log-' || (user_id % 7) || event_type AS log_name FROM events)
SELECT *, 'id' AS by FROM e WHERE job_id IN (3, 14, 15) UNION ALL SELECT *, 'name' FROM e WHERE log_name = 'log-5error'""",
}
