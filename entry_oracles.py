"""SQL over the same test tables, one text per registered query."""

from __future__ import annotations

_STATES = """
ranked AS (
  SELECT user_id, event_type, strftime(ts, '%Y%m%d') AS day,
         row_number() OVER (PARTITION BY user_id, strftime(ts, '%Y%m%d') ORDER BY ts DESC, event_id DESC) AS rn
  FROM events),
states AS (
  SELECT user_id, event_type, day, lag(event_type) OVER (PARTITION BY user_id ORDER BY day) AS before
  FROM ranked WHERE rn = 1),
versions AS (
  SELECT day AS etl_dt, day AS start_dt, user_id, event_type,
         lead(day, 1, '30001231') OVER (PARTITION BY user_id ORDER BY day) AS end_dt
  FROM states WHERE before IS DISTINCT FROM event_type)
"""

_HISTORY = f"WITH {_STATES} SELECT * FROM versions"

_ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"

_RUNS = """
runs AS (
  SELECT *, strftime(ts, '%Y%m%d') AS biz_end_date, strftime(ts, '%Y%m%d%H') || '00' AS run FROM events)
"""

_NEXT_CUSTOMERS = """
later AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal,
         CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS c_mktsegment
  FROM customer WHERE c_acctbal >= 0
  UNION ALL
  SELECT -1 - s_suppkey, s_name, s_nationkey, s_acctbal, 'SUPPLIER' FROM supplier)
"""

_PER_DAY = "SELECT CAST(o_orderdate AS DATE) AS data_date, count(*) AS n FROM orders {where} GROUP BY 1"

_DETAIL = """
detail AS (
  SELECT o_orderkey AS parent_id, l_orderkey AS order_id, o_custkey AS cust_id,
         l_returnflag AS cust_type, l_linestatus AS order_type,
         CASE WHEN l_quantity < 50 THEN CAST(l_quantity AS INTEGER) END AS allot_quantity,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS bargin_price,
         CAST(1 AS INTEGER) AS receiver_country_id, l_linenumber AS receiver_province_id,
         l_partkey AS receiver_city_id,
         CASE WHEN l_suppkey % 3 > 0 THEN l_suppkey END AS shop_id,
         o_orderpriority AS order_source, l_suppkey * 2 AS from_platform, l_partkey AS product_id,
         o_orderstatus AS order_status, strftime(o_orderdate, '%Y-%m-%d') AS order_creation_date,
         strftime(l_shipdate, '%Y-%m-%d') AS send_date, strftime(o_orderdate, '%Y-%m-%d') AS data_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
product AS (
  SELECT p_partkey AS product_id, p_type || '/' || p_brand AS category_path, p_type AS category_path2,
         p_type AS path2_name, p_brand AS category_path3, p_name AS path3_name,
         CASE WHEN p_size < 40 THEN p_size END AS bd_id
  FROM part),
sold AS (SELECT * FROM product WHERE bd_id IS NOT NULL),
lines AS (
  SELECT d.*, ifnull(shop_id, 0) AS shop, ifnull(from_platform, 0) AS platform
  FROM detail d WHERE data_date BETWEEN '1995-01-01' AND '2001-12-31'),
mapped AS (
  SELECT * EXCLUDE (shop, platform, data_date) REPLACE (
           ifnull(allot_quantity, 0) AS allot_quantity, ifnull(bargin_price, 0) AS bargin_price,
           CAST(shop > 0 AS INTEGER) AS shop_id,
           CASE WHEN platform BETWEEN 1 AND 20 OR platform > 120 THEN 2 ELSE 1 END AS from_platform)
  FROM lines),
clean AS (SELECT DISTINCT * FROM mapped JOIN sold USING (product_id))
"""


def _repurchase(start: str, end: str, bds: str) -> str:
    return f"""
WITH {_DETAIL},
info AS (
  SELECT cust_id, bd_id, shop_id, CAST(sum(allot_quantity * bargin_price) AS BIGINT) AS ck_amt,
         count(DISTINCT parent_id) AS ck_parent_id
  FROM clean WHERE send_date >= '{start}' AND send_date < '{end}' AND {bds}
  GROUP BY cust_id, bd_id, shop_id)
SELECT CASE WHEN grouping(bd_id) = 1 THEN 'rbz' ELSE CAST(bd_id AS VARCHAR) END AS bd_id,
       CASE WHEN grouping(shop_id) = 1 THEN 'zy+pt' ELSE CAST(shop_id AS VARCHAR) END AS shop_id,
       ck_parent_id, count(DISTINCT cust_id) AS ck_custnum, CAST(sum(ck_amt) AS BIGINT) AS ck_amt
FROM info
GROUP BY GROUPING SETS ((bd_id, shop_id, ck_parent_id), (bd_id, ck_parent_id), (shop_id, ck_parent_id), (ck_parent_id))
"""


_MOVED = """
SELECT '20240101' AS etl_dt, '19000101' AS start_dt, c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
       CASE WHEN c_acctbal > 0 AND c_mktsegment <> 'MACHINERY' THEN '20240102' ELSE '30001231' END AS end_dt
FROM customer
UNION ALL
SELECT '20240102', '20240102', c_custkey, c_name, c_nationkey, c_acctbal, 'MACHINERY', '30001231'
FROM customer WHERE c_acctbal > 0 AND c_mktsegment <> 'MACHINERY'
"""

_LAYOUTS = {
    "base": ("c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment,biz_end_date", "biz_end_date"),
    "slice": ("etl_dt,c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment,data_dt", "data_dt"),
    "append": ("c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment,etl_dt", "etl_dt"),
    "chain": ("etl_dt,start_dt,c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment,end_dt", "end_dt"),
    "staging": ("c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment,etl_dt", "etl_dt"),
    "old_chain": ("c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment,s_dt,e_dt", "e_dt"),
    "replace": ("c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment", ""),
}

ORACLES: dict[str, str] = {
    "scd2_history": _HISTORY,
    "scd2_merge": _HISTORY,
    "scd2_daily": _HISTORY,
    "scd2_as_of_epochs": f"""
WITH {_STATES}
SELECT etl_dt, start_dt, user_id, event_type FROM versions WHERE start_dt <= '20240115' AND end_dt > '20240115'""",
    "stored_counts": """
SELECT strftime(o_orderdate, '%Y') AS year, count(*) AS n_rows FROM orders GROUP BY 1
UNION ALL SELECT 'all', count(*) FROM orders""",
    "scd2_replay": _HISTORY,
    "scd2_stream": _HISTORY,
    "latest_document": """
SELECT doc_id, text, lang, source, n_chars FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, n_chars ORDER BY doc_id DESC) AS nth FROM documents)
WHERE nth = 1
""",
    "snapshot_changes": """
WITH later AS (
  SELECT doc_id, CASE WHEN source = 'src3' THEN substring(text, 1, 100) ELSE text END AS text, n_chars
  FROM documents WHERE n_chars >= 50
  UNION ALL SELECT -1 - item_id, text, length(text) FROM benchmark)
SELECT coalesce(o.doc_id, n.doc_id) AS doc_id,
       CASE WHEN o.doc_id IS NULL THEN 'inserted' WHEN n.doc_id IS NULL THEN 'deleted' ELSE 'changed' END AS outcome,
       md5(o.text) AS old_md5, md5(n.text) AS new_md5, n.n_chars AS new_chars
FROM documents o FULL JOIN later n USING (doc_id)
WHERE o.doc_id IS NULL OR n.doc_id IS NULL OR o.text IS DISTINCT FROM n.text
""",
    "scd2_as_of": f"{_HISTORY} WHERE start_dt <= '20240115' AND end_dt > '20240115'",
    "scd2_current": f"{_HISTORY} WHERE end_dt = '30001231'",
    "scd2_init": """
SELECT '20240101' AS etl_dt, '19000101' AS start_dt, *, '30001231' AS end_dt FROM customer""",
    "scd2_init_old_layout": """
SELECT *, '19000000' AS s_dt, '30001231' AS e_dt FROM customer""",
    "scd2_init_stored": _MOVED,
    "scd2_bucketed": _MOVED,
    "cdc_latest": """
WITH last AS (
  SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn
  FROM events WHERE strftime(ts, '%Y%m%d') BETWEEN '20240101' AND '20240131')
SELECT user_id AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, event_type AS cdc_type
FROM last LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) base ON user_id = c_custkey
WHERE rn = 1""",
    "latest_event": """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1""",
    "snapshot_diff": f"""
WITH {_NEXT_CUSTOMERS}
SELECT coalesce(a.c_custkey, b.c_custkey) AS c_custkey,
       CASE WHEN a.c_custkey IS NULL THEN 'inserted' WHEN b.c_custkey IS NULL THEN 'deleted'
            WHEN a.c_name IS DISTINCT FROM b.c_name OR a.c_nationkey IS DISTINCT FROM b.c_nationkey
              OR a.c_acctbal IS DISTINCT FROM b.c_acctbal OR a.c_mktsegment IS DISTINCT FROM b.c_mktsegment
            THEN 'changed' ELSE 'same' END AS outcome,
       a.c_mktsegment AS old_segment, b.c_mktsegment AS new_segment
FROM customer a FULL JOIN later b ON a.c_custkey = b.c_custkey""",
    "all_columns_diff": f"""
WITH {_NEXT_CUSTOMERS},
sides AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 1 AS o, 0 AS n FROM customer
  UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 0, 1 FROM later),
counted AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
         CAST(sum(o) AS BIGINT) AS n_old, CAST(sum(n) AS BIGINT) AS n_new
  FROM sides GROUP BY ALL)
SELECT *, CASE WHEN n_old = 0 THEN 'inserted' WHEN n_new = 0 THEN 'deleted' ELSE 'same' END AS outcome
FROM counted""",
    "slice_load": f"""
SELECT day AS etl_dt, {_ORDER_COLUMNS}, day AS data_dt
FROM orders CROSS JOIN (VALUES ('20240101'), ('20240102')) days(day)""",
    "increment_load": "SELECT *, strftime(ts, '%Y%m%d') AS etl_dt FROM events",
    "full_replace": f"SELECT '20240102' AS etl_dt, {_ORDER_COLUMNS} FROM orders",
    "archive_reload": f"SELECT '20240101' AS etl_dt, {_ORDER_COLUMNS}, '20240101' AS data_dt FROM orders",
    "layout_tables": " UNION ALL ".join(
        f"SELECT '{name}' AS layout, '{cols}' AS columns, '{part}' AS partition, count(*) AS n_rows FROM customer"
        for name, (cols, part) in _LAYOUTS.items()
    ),
    "drop_partitions": """
SELECT *, strftime(ts, '%Y%m%d') AS etl_dt FROM events WHERE ts >= TIMESTAMP '2024-01-16'""",
    "read_run": "SELECT * FROM events",
    "copy_partition": """
SELECT *, strftime(ts, '%Y%m%d') AS etl_dt FROM events""",
    "latest_run": f"WITH {_RUNS} SELECT * FROM runs WHERE run = (SELECT max(run) FROM runs)",
    "latest_run_per_date": f"""
WITH {_RUNS}, top AS (SELECT biz_end_date, max(run) AS run FROM runs GROUP BY 1)
SELECT runs.* FROM runs JOIN top ON runs.biz_end_date = top.biz_end_date AND runs.run = top.run""",
    "newest_run_names": f"WITH {_RUNS} SELECT biz_end_date, max(run) AS run FROM runs GROUP BY 1",
    "resolve_chain_runs": f"""
WITH {_RUNS},
named AS (
  SELECT biz_end_date, run || '00_' || event_id AS name,
         row_number() OVER (PARTITION BY biz_end_date ORDER BY run DESC, event_id DESC) AS rn,
         row_number() OVER (ORDER BY run DESC, event_id DESC) AS rank
  FROM runs),
top AS (SELECT name FROM named WHERE rank = 1)
SELECT biz_end_date AS partition, name AS run, 'later' AS resolved FROM named WHERE rn = 1
UNION ALL SELECT '20991231', name, 'later' FROM top
UNION ALL SELECT biz_end_date, top.name, 'run day' FROM named CROSS JOIN top WHERE rn = 1
UNION ALL SELECT '20991231', name, 'run day' FROM top""",
    "mount_runs": """
WITH halves AS (
  SELECT *, strftime(ts, '%Y%m%d') AS biz_end_date, hour(ts) >= 12 AS half FROM events),
top AS (SELECT biz_end_date, max(half) AS half FROM halves GROUP BY 1)
SELECT h.* EXCLUDE (half) FROM halves h JOIN top t ON h.biz_end_date = t.biz_end_date AND h.half = t.half""",
    "mount_newest": """
WITH halves AS (
  SELECT *, strftime(ts, '%Y%m%d') AS biz_end_date,
         strftime(ts, '%Y%m%d') || CASE WHEN hour(ts) < 12 THEN '0000' ELSE '1200' END AS process_start_datetime
  FROM events),
top AS (SELECT biz_end_date, max(process_start_datetime) AS run FROM halves GROUP BY 1)
SELECT h.* FROM halves h JOIN top t ON h.biz_end_date = t.biz_end_date AND h.process_start_datetime = t.run""",
    "chain_mount": """
WITH halves AS (
  SELECT *, strftime(ts, '%Y%m%d') AS biz_end_date, hour(ts) >= 12 AS half FROM events),
top AS (SELECT biz_end_date, max(half) AS half FROM halves GROUP BY 1)
SELECT h.* EXCLUDE (half) FROM halves h JOIN top t ON h.biz_end_date = t.biz_end_date AND h.half = t.half
UNION ALL SELECT *, '20991231' FROM events
UNION ALL SELECT *, 'current' FROM events""",
    "all_data_refresh": """
WITH halves AS (
  SELECT *, strftime(ts, '%Y%m%d') AS biz_end_date, hour(ts) >= 12 AS half FROM events),
top AS (SELECT biz_end_date, max(half) AS half FROM halves GROUP BY 1),
newest AS (
  SELECT h.* EXCLUDE (half) FROM halves h JOIN top t ON h.biz_end_date = t.biz_end_date AND h.half = t.half)
SELECT * FROM newest
UNION ALL SELECT * REPLACE ('current' AS biz_end_date) FROM newest WHERE biz_end_date = (SELECT max(biz_end_date) FROM top)""",
    "intake_stream": """
SELECT *, strftime(ts, '%Y%m%d') AS date,
       strftime(ts, '%Y%m%d') || CASE WHEN hour(ts) < 12 THEN '0000' ELSE '1200' END AS run
FROM events""",
    "readiness": """
SELECT event_type, max(ts) AS newest, max(ts) > TIMESTAMP '2024-01-30 23:30:00' AS ready
FROM events GROUP BY event_type""",
    "row_counts": "SELECT count(*) AS n_rows FROM events WHERE event_type = 'click'",
    "reconcile_counts": """
WITH counts AS (
  SELECT strftime(o_orderdate, '%Y%m%d') AS data_dt, count(*) AS source_count_1,
         count(*) FILTER (WHERE o_totalprice > 100000) AS source_count_2,
         count(*) FILTER (WHERE o_orderstatus <> 'P') AS target_count
  FROM orders GROUP BY 1)
SELECT *, CASE WHEN source_count_1 <> source_count_2 THEN 'moving'
               WHEN source_count_1 <> target_count THEN 'differs' ELSE 'ok' END AS status
FROM counts""",
    "etl_log_upsert": f"""
WITH full_days AS ({_PER_DAY.format(where="")}),
rerun AS ({_PER_DAY.format(where="WHERE o_orderstatus = 'P'")}),
loaded AS ({_PER_DAY.format(where="WHERE o_orderpriority = '1-URGENT'")}),
again AS ({_PER_DAY.format(where="WHERE o_totalprice > 400000")})
SELECT 'shop' AS db_name, 'orders' AS table_name, f.data_date,
       TIMESTAMP '2024-01-01 06:00:00' AS run_time,
       coalesce(r.n, f.n) AS source_count_1,
       CASE WHEN a.n IS NOT NULL THEN a.n WHEN r.n IS NULL THEN f.n + 1 END AS source_count_2,
       CASE WHEN l.n IS NOT NULL THEN l.n WHEN r.n IS NULL THEN f.n + 2 END AS target_count
FROM full_days f LEFT JOIN rerun r ON f.data_date = r.data_date
LEFT JOIN loaded l ON f.data_date = l.data_date LEFT JOIN again a ON f.data_date = a.data_date""",
    "batch_log": """
SELECT event_type AS sys, user_id AS step, strftime(ts, '%Y%m%d') AS data_dt, max(ts) AS complete_time
FROM events GROUP BY 1, 2, 3""",
    "stored_load_log": f"""
WITH full_days AS ({_PER_DAY.format(where="")}),
kept AS ({_PER_DAY.format(where="WHERE o_orderstatus <> 'P'")}),
rerun AS ({_PER_DAY.format(where="WHERE o_orderstatus = 'P'")}),
loaded AS ({_PER_DAY.format(where="WHERE o_orderpriority = '1-URGENT'")}),
again AS ({_PER_DAY.format(where="WHERE o_totalprice > 400000")})
SELECT 'shop' AS db_name, 'orders' AS table_name, f.data_date,
       TIMESTAMP '2024-01-01 06:00:00' AS run_time,
       coalesce(r.n, f.n) AS source_count_1,
       CASE WHEN a.n IS NOT NULL THEN a.n WHEN r.n IS NULL THEN f.n END AS source_count_2,
       CASE WHEN l.n IS NOT NULL THEN l.n WHEN r.n IS NULL THEN k.n END AS target_count
FROM full_days f LEFT JOIN kept k ON f.data_date = k.data_date LEFT JOIN rerun r ON f.data_date = r.data_date
LEFT JOIN loaded l ON f.data_date = l.data_date LEFT JOIN again a ON f.data_date = a.data_date""",
    "stored_batch_log": """
SELECT event_type AS sys, CAST(user_id AS VARCHAR) AS step, strftime(ts, '%Y%m%d') AS data_dt, max(ts) AS complete_time
FROM events GROUP BY 1, 2, 3""",
    "staged_runs": """
WITH recent AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
sums AS (
  SELECT 'append' AS layout, count(*) AS n, sum(o_orderkey) AS keys FROM recent
  UNION ALL SELECT 'staging', count(*), sum(o_orderkey) FROM recent
  UNION ALL SELECT unnest(['replace', 'base', 'append_init']), count(*), sum(o_orderkey) FROM orders)
SELECT layout, n AS source_count_1, n AS source_count_2, n AS target_count, CAST(keys AS BIGINT) AS keys FROM sums""",
    "daily_cdc": """
WITH last AS (
  SELECT user_id, arg_max(event_type, event_id) AS cdc_type FROM events
  WHERE CAST(ts AS DATE) = DATE '2024-01-10' GROUP BY user_id),
n AS (SELECT count(*) AS n FROM last)
SELECT user_id AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, cdc_type, '20240110' AS etl_dt,
       n AS source_count_1, n AS source_count_2, n AS target_count
FROM n, last LEFT JOIN customer ON c_custkey = user_id AND c_acctbal > 0""",
    "conform_losses": """
WITH lost AS (
  SELECT 'o_orderpriority' AS col, o_orderpriority AS v FROM orders
  UNION ALL SELECT 'o_orderstatus', o_orderstatus FROM orders)
SELECT col AS "column", count(*) AS n_lost, min(v) AS example FROM lost GROUP BY 1""",
    "lost_fields": """
WITH lines AS (
  SELECT unnest(string_split(concat_ws(chr(1), CAST(doc_id AS VARCHAR), coalesce(lang, '\\N'), coalesce(CAST(n_chars AS VARCHAR), '\\N'),
                coalesce(translate(text, chr(13) || chr(1), ''), '\\N'), coalesce(source, '\\N')), chr(10))) AS line FROM documents),
fields AS (SELECT string_split(line, chr(1)) AS p FROM lines),
told AS (
  SELECT unnest(['doc_id', 'lang', 'n_chars', 'text', 'source']) AS "column",
         unnest([false, len(p) < 2, len(p) < 3, len(p) < 4, len(p) < 5]) AS gone,
         unnest([try_cast(p[1] AS BIGINT) IS NULL, false, p[3] IS NOT NULL AND try_cast(p[3] AS BIGINT) IS NULL, false, false]) AS bad,
         unnest([p[1], NULL, p[3], NULL, NULL]) AS v
  FROM fields)
SELECT "column", count(*) FILTER (gone) AS n_missing, count(*) FILTER (bad) AS n_unparsed, min(v) FILTER (bad) AS example
FROM told GROUP BY 1 HAVING count(*) FILTER (gone OR bad) > 0""",
    "audited_load": """
SELECT 'shop' AS db_name, 'orders' AS table_name, DATE '2024-01-01' AS data_date,
       TIMESTAMP '2024-01-01 06:00:00' AS run_time,
       count(*) AS source_count_1, count(*) AS source_count_2, count(*) AS target_count
FROM orders""",
    "daily_runs": """
WITH runs(layout, day, since, early) AS (
  VALUES ('slice', DATE '2024-01-01', TIMESTAMP '1900-01-01', false), ('append', DATE '1998-01-01', TIMESTAMP '1998-01-01', false),
         ('replace', DATE '2024-01-01', TIMESTAMP '1900-01-01', false), ('chain', DATE '2000-12-31', TIMESTAMP '1900-01-01', true),
         ('chain', DATE '2001-01-01', TIMESTAMP '1900-01-01', false))
SELECT 'orders' AS table_name, day AS data_date, TIMESTAMP '2024-01-01 06:00:00' AS run_time,
       count(*) AS source_count_1, count(*) AS source_count_2, count(*) AS target_count, layout
FROM runs JOIN orders ON o_orderdate >= since
  AND NOT (early AND o_orderdate >= TIMESTAMP '2001-01-01' AND o_orderpriority = '1-URGENT')
GROUP BY layout, day""",
    "daily_chain": """
WITH sorted AS (
  SELECT *, o_orderdate >= TIMESTAMP '2001-01-01' AND o_orderpriority = '1-URGENT' AS fresh,
         o_orderdate >= TIMESTAMP '2001-01-01' AND o_orderpriority = '2-HIGH' AS moved
  FROM orders)
SELECT o_orderkey, o_custkey, CASE WHEN moved THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice, o_orderdate,
       o_orderpriority, '19000101' AS start_dt, CASE WHEN moved THEN '20010101' ELSE '30001231' END AS end_dt
FROM sorted WHERE NOT fresh
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, '20010101', '30001231'
FROM sorted WHERE fresh OR moved""",
    "convert_mysql": """
SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, CAST(NULL AS VARCHAR) AS o_orderpriority
FROM orders""",
    "convert_oracle": """
SELECT CAST(o_orderkey AS VARCHAR) AS g_o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CAST(NULL AS VARCHAR) AS o_orderpriority
FROM orders""",
    "conform_schema": """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority, 'u' AS cdc_type
FROM orders""",
    "read_table": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, CAST(NULL AS VARCHAR) AS o_orderpriority
FROM orders""",
    "read_increment": f"SELECT {_ORDER_COLUMNS} FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'",
    "drop_delims": """
SELECT doc_id, translate(text, chr(10) || chr(13) || chr(1), '') AS text, lang, source, n_chars FROM documents""",
    "row_fingerprint": """
SELECT o_orderkey,
       md5('{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey
           || CASE WHEN o_orderpriority <> '5-LOW' THEN ',"priority":"' || o_orderpriority || '"' ELSE '' END
           || ',"price":' || CAST(o_totalprice AS DECIMAL(18,2)) || '}') AS json_md5,
       md5(o_orderkey || '|' || o_custkey || '|' || CAST(o_totalprice AS DECIMAL(18,2))) AS joined_md5
FROM orders""",
    "base64_text": r"""
SELECT doc_id, regexp_replace(base64(encode(text)), '(.{1,76})', '\1' || chr(10), 'g') AS encoded, text AS decoded
FROM documents""",
    "scalar_functions": """
SELECT event_id, CASE WHEN event_type <> 'error' THEN user_id ELSE 0 END AS zeroed,
       CASE WHEN user_id > 0 THEN 1 ELSE 0 END AS shop,
       CASE WHEN (user_id > 0 AND user_id < 21) OR user_id > 120 THEN 2 ELSE 1 END AS platform,
       strftime(ts, '%Y%m%d') AS day, strftime(ts, '%Y-%m-%d %H:%M:%S') AS second,
       CAST(ts AS DATE) AS parsed_day,
       CASE WHEN event_type <> 'view' THEN date_trunc('minute', ts) END AS run,
       strftime(ts, '%Y%m%d%H%M%S') AS run_ts, event_id AS run_id, event_type AS tail
FROM events""",
    "schema_drift": f"""
WITH {_RUNS},
wanted(name, type) AS (
  VALUES ('click', 'double'), ('error', 'double'), ('purchase', 'int'), ('signup', 'double'), ('view', 'double')),
seen AS (SELECT DISTINCT run, event_type FROM runs)
SELECT r.run, w.name AS "column", w.type AS expected, CASE WHEN s.run IS NOT NULL THEN 'double' END AS actual
FROM (SELECT DISTINCT run FROM runs) r CROSS JOIN wanted w
LEFT JOIN seen s ON s.run = r.run AND s.event_type = w.name
WHERE s.run IS NULL OR w.type <> 'double'""",
    "delimited_roundtrip": """
SELECT doc_id, translate(text, chr(10) || chr(13) || chr(1), '') AS text,
       CASE WHEN lang <> 'en' THEN lang END AS lang, source, n_chars
FROM documents""",
    "export_manifest": f"SELECT {_ORDER_COLUMNS} FROM orders WHERE o_orderdate < TIMESTAMP '2002-01-01'",
    "sql_steps": """
WITH user_day AS (
  SELECT user_id, strftime(ts, '%Y%m%d') AS day, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY 1, 2),
users AS (SELECT user_id, count(*) AS days, sum(n) AS events FROM user_day GROUP BY 1)
SELECT days, count(*) AS users, CAST(sum(events) AS BIGINT) AS events FROM users GROUP BY days""",
    "sql_file": """
SELECT o_orderstatus, ';' AS mark, count(*) AS n FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderpriority <> '5-LOW' GROUP BY o_orderstatus""",
    "clean_detail": f"WITH {_DETAIL} SELECT * FROM clean",
    "repurchase_job": f"""
SELECT *, 'repurchase_60' AS "window" FROM ({_repurchase("2001-05-01", "2001-07-01", "bd_id IN (1, 16, 4, 9)")})
UNION ALL
SELECT *, 'repurchase_90' FROM ({_repurchase("2001-04-01", "2001-07-01", "bd_id IN (1, 16, 4, 9)")})""",
    "repurchase_60": _repurchase("2001-05-01", "2001-07-01", "bd_id IN (1, 16, 4, 9)"),
    "repurchase_90": _repurchase("2001-04-01", "2001-07-01", "bd_id IN (1, 16, 4, 9)"),
    "repurchase_full": _repurchase("1995-01-01", "2002-01-01", "bd_id BETWEEN 1 AND 39"),
}
