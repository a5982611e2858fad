"""DuckDB SQL equal to each registered scenario, over the same tables."""

from __future__ import annotations

from landfall.plans.api_job import DEVICE_FIELDS
from landfall.scenarios import SQL_TS, SQL_TS_2

NESTED = f"""
SELECT CAST(l_orderkey AS VARCHAR) AS approvableid, CAST(l_partkey AS VARCHAR) AS approver,
       l_linestatus AS approvalactivationdate, strftime(l_shipdate, '%Y-%m-%d') AS timeupdated,
       l_returnflag AS sourcesystem, CAST(l_linenumber AS VARCHAR) AS userid, {SQL_TS} AS update_ts
FROM lineitem"""


def _api_sql() -> str:
    filled = {
        "status": "o_orderstatus",
        "device_status": "o_orderpriority",
        "mendix_uid": "CAST(o_orderkey AS VARCHAR)",
        "patient_id": "CAST(o_custkey AS VARCHAR)",
        "serial_number": "CAST(o_orderkey AS VARCHAR)",
        "procedure_date": "o_orderdate",          # ISO text, lenient parse
        "input_date": "o_orderdate",              # MM/dd/yyyy HH:mm:ss, strict parse
        "modified_date": "o_orderdate",
        "isresolving": "o_totalprice > 200000",
        # completedDate arrives as MM/dd/yyyy: the lenient default parse gives NULL
    }
    sql_type = {"string": "VARCHAR", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN"}
    cols = [f"{filled.get(t, f'CAST(NULL AS {sql_type[ty]})')} AS {t}" for _, t, ty, _, _ in DEVICE_FIELDS]
    return "SELECT " + ", ".join(cols) + f", {SQL_TS} AS update_ts FROM orders"


ORACLES = {
    "q01_csv_ingest": f"""
SELECT CAST(c_custkey AS VARCHAR) AS network_id, c_name AS nleader_name, {SQL_TS} AS update_ts FROM customer""",
    "q02_tsv_ingest": f"""
SELECT CAST(c_custkey AS VARCHAR) AS division_id, c_name AS division_name,
       CAST(c_nationkey AS VARCHAR) AS parent_division_id, c_mktsegment AS parent_division_name,
       'R' || CAST(c_nationkey AS VARCHAR) AS region_code, CAST(NULL AS VARCHAR) AS _rescued_data,
       {SQL_TS} AS update_ts
FROM customer WHERE c_acctbal >= 0""",
    "q03_json_flat": f"""
SELECT CAST(conv_id AS VARCHAR) AS taskid, role AS timecreated, CAST(turn AS VARCHAR) AS timeupdated,
       text AS activeapprovers_userid, {SQL_TS} AS update_ts FROM conversations""",
    "q04_json_nested": NESTED,
    "q05_glob_filter": "SELECT * FROM events",
    "q06_changed_files": """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, 'v1' AS ver FROM orders
UNION ALL
SELECT CAST(o_orderkey AS VARCHAR), o_orderstatus, 'v2' FROM orders WHERE o_orderstatus = 'P'""",
    "q07_schema_memory": """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus,
       CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority FROM orders""",
    "q08_rescued": """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus,
       CASE WHEN o_orderstatus = 'P' THEN '{"o_orderpriority":"' || o_orderpriority || '"}' END AS _rescued_data
FROM orders""",
    "q09_paged_api": _api_sql(),
    "q10_zip_explode": NESTED,
    "q11_load_stamp": f"SELECT c_custkey, {SQL_TS} AS update_ts FROM customer",
    "q12_high_watermark": """
SELECT MAX(ts) AS latest_update_dt FROM events WHERE upper(event_type) = 'PURCHASE'""",
    "q13_dynamic_max": "SELECT MAX(o_orderdate) AS latest_update_dt FROM orders",
    "q14_map_lookup": """
SELECT event_id, props ->> '$.k' AS k FROM events WHERE event_type = 'purchase'""",
    "q15_strict_ts": "SELECT event_id, date_trunc('second', ts) AS parsed FROM events",
    "q16_lenient_ts": """
SELECT event_id, CASE WHEN event_type = 'purchase' THEN ts END AS parsed FROM events""",
    "q17_config_lookup": """
SELECT CAST(c_custkey AS INTEGER) AS ref_id,
       '/landing/' || lower(c_mktsegment) || '/' || CAST(c_custkey AS VARCHAR) AS input_path,
       CASE WHEN c_nationkey < 10 THEN 'csv' ELSE 'json' END AS file_format,
       '/schemas/' || CAST(c_custkey AS VARCHAR) AS schema_path,
       '/checkpoints/' || CAST(c_custkey AS VARCHAR) AS checkpoint_path,
       'main' AS table_catalog, lower(c_mktsegment) AS table_schema,
       't_' || CAST(c_custkey AS VARCHAR) AS ingst_tbl_name, '*.csv' AS glob_filter
FROM customer WHERE c_custkey = 7""",
    "q18_changed_rows": """
WITH b AS (
  SELECT c_custkey, c_name, c_nationkey,
         CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN c_acctbal END AS c_acctbal,
         CASE WHEN c_nationkey = 3 THEN 'CHANGED' ELSE c_mktsegment END AS c_mktsegment
  FROM customer)
SELECT b.* FROM customer a JOIN b ON a.c_custkey = b.c_custkey
WHERE a.c_name IS DISTINCT FROM b.c_name OR a.c_nationkey IS DISTINCT FROM b.c_nationkey
   OR a.c_acctbal IS DISTINCT FROM b.c_acctbal OR a.c_mktsegment IS DISTINCT FROM b.c_mktsegment""",
    "q19_merge_upsert": f"""
WITH s AS (
  SELECT CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_custkey END AS c_custkey, c_name, c_nationkey,
         CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN c_acctbal END AS c_acctbal,
         CASE WHEN c_acctbal < 1000 THEN 'CHANGED' ELSE c_mktsegment END AS c_mktsegment
  FROM customer WHERE c_nationkey >= 10),
t AS (SELECT CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_custkey END AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
  FROM customer WHERE c_nationkey < 15)
SELECT COALESCE(s.c_custkey, t.c_custkey) AS c_custkey,
       CASE WHEN s.c_name IS NULL THEN t.c_name ELSE s.c_name END AS c_name,
       CASE WHEN s.c_name IS NULL THEN t.c_nationkey ELSE s.c_nationkey END AS c_nationkey,
       CASE WHEN s.c_name IS NULL THEN t.c_acctbal ELSE s.c_acctbal END AS c_acctbal,
       CASE WHEN s.c_name IS NULL THEN t.c_mktsegment ELSE s.c_mktsegment END AS c_mktsegment,
       CASE WHEN s.c_name IS NULL THEN {SQL_TS}
            WHEN t.c_name IS NULL THEN {SQL_TS_2}
            WHEN s.c_name IS DISTINCT FROM t.c_name OR s.c_nationkey IS DISTINCT FROM t.c_nationkey
              OR s.c_acctbal IS DISTINCT FROM t.c_acctbal OR s.c_mktsegment IS DISTINCT FROM t.c_mktsegment
            THEN {SQL_TS_2} ELSE {SQL_TS} END AS update_ts
FROM t FULL JOIN s ON t.c_custkey = s.c_custkey""",
    "q20_last_page_wins": """
SELECT CAST(o_custkey AS VARCHAR) AS patient_id, CAST(o_orderkey AS VARCHAR) AS mendix_uid FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1""",
    "q21_duplicate_keys": """
SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey HAVING COUNT(*) > 1""",
    "q22_audit_duration": """
SELECT 'run-' || CAST(user_id AS VARCHAR) AS run_id, MIN(ts) AS start_time, MAX(ts) AS end_time,
       (date_diff('microsecond', MIN(ts), MAX(ts)) // 1000000) || '.'
         || lpad(CAST(date_diff('microsecond', MIN(ts), MAX(ts)) % 1000000 AS VARCHAR), 6, '0') AS duration_sec,
       CASE WHEN arg_max(event_type, ts) = 'error' THEN 'FAILURE' ELSE 'SUCCESS' END AS run_status,
       'n' || CAST(user_id AS VARCHAR) AS notebook_name
FROM events GROUP BY user_id""",
    "q23_replay_safe": "SELECT * FROM orders",
    "q24_snapshot_replace": """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, 'run2' AS ver FROM orders""",
    "q25_add_columns": """
SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS o_orderstatus
FROM orders""",
    "q26_api_cdc_job": f"""
SELECT CAST(o_orderkey AS VARCHAR) AS mendix_uid, CAST(o_custkey AS VARCHAR) AS patient_id,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'X' ELSE o_orderstatus END AS status,
       o_orderpriority AS device_status,
       CASE WHEN o_orderpriority = '1-URGENT' THEN TIMESTAMP '2030-01-01 12:30:00' ELSE o_orderdate END AS modified_date,
       CASE WHEN o_orderpriority = '1-URGENT' THEN {SQL_TS_2} ELSE {SQL_TS} END AS update_ts
FROM orders""",
    "q27_include_existing": "SELECT * FROM orders WHERE o_orderstatus <> 'F'",
    "q28_cdc_failure_audit": """
SELECT 'FAILURE' AS run_status, 'device' AS object_name, 'mdx' AS source_name, true AS has_run_id,
       CAST(NULL AS TIMESTAMP) AS latest_update_dt
UNION ALL
SELECT 'SUCCESS', 'device', 'mdx', true, MAX(o_orderdate) FROM orders""",
    "q29_late_files": "SELECT * FROM orders",
    "q30_infer_every_file": """
SELECT c_custkey, c_name, CASE WHEN c_nationkey IN ('3', '4') THEN c_nationkey END AS c_nationkey,
       CASE WHEN c_nationkey IN ('3', '4') THEN c_mktsegment END AS c_mktsegment,
       CASE WHEN c_nationkey = '4' THEN upper(c_name) END AS c_note
FROM (SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment FROM customer)""",
    "q31_key_in_odd_places": "SELECT CAST(o_orderkey AS VARCHAR) AS mendix_uid FROM orders",
    "q32_request_attempts": """
WITH pages AS (SELECT DISTINCT CAST(floor(o_orderkey / 1000) + 1 AS BIGINT) AS page FROM orders)
SELECT 'FAILURE' AS run_status, 'REQUEST of page 2: attempt 1: ApiError: HTTP 503 for page 2' AS log_step FROM pages WHERE page = 2
UNION ALL SELECT 'FAILURE', 'REQUEST of page 2: ApiError: page 2 failed after 2 attempts: HTTP 503 for page 2' FROM pages WHERE page = 2
UNION ALL SELECT 'FAILURE', 'CDC_RUN: FetchFailed: page 2: ApiError: page 2 failed after 2 attempts: HTTP 503 for page 2' FROM pages WHERE page = 2
UNION ALL SELECT 'FAILURE', 'REQUEST of page ' || page || ': attempt 1: ApiError: HTTP 503 for page ' || page FROM pages WHERE page IN (1, 2)
UNION ALL SELECT 'SUCCESS', 'CDC_RUN'""",
    "q33_catalog_table": f"""
SELECT CAST(c_custkey AS VARCHAR) AS network_id, c_name AS nleader_name, {SQL_TS} AS update_ts FROM customer""",
    "q34_catalog_watermark": "SELECT MAX(ts) AS latest_update_dt FROM events WHERE event_type = 'purchase'",
    "q35_csv_layouts": """
SELECT lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS id, CASE WHEN c_nationkey % 4 <> 2 THEN c_name END AS name,
       CASE WHEN c_nationkey % 4 = 2 THEN c_mktsegment END AS segment,
       CASE WHEN c_nationkey % 4 = 2 THEN CAST(c_nationkey AS VARCHAR) END AS nation
FROM customer""",
    "q36_rescue_everything": """
SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS k, CASE WHEN o_orderstatus NOT IN ('F', 'P') THEN 5 END AS n,
       CASE o_orderstatus WHEN 'P' THEN '{"k": ' || o_orderkey || ', "n": {"z":' WHEN 'F' THEN '{"n":"{\\"z\\":1}"}'
            ELSE '{"more":"x"}' END AS _rescued_data
FROM orders""",
    "q37_csv_rewritten": f"""
SELECT CAST(c_custkey AS VARCHAR) AS network_id, c_name || v AS nleader_name, {SQL_TS} AS update_ts
FROM customer, (VALUES ('-v1'), ('-v2')) AS t(v) WHERE v = '-v1' OR c_custkey % 3 = 0""",
    "q38_records_lost": """
WITH pages AS (SELECT CAST(floor(o_orderkey / 1000) + 1 AS BIGINT) AS page, count(*) AS n FROM orders GROUP BY 1)
SELECT 'FAILURE' AS run_status, 'page ' || page || ': ' || (n + 1) || ' records sent, 0 read' AS step, CAST(0 AS BIGINT) AS rows_after
FROM pages WHERE page = (SELECT min(page) FROM pages WHERE page % 2 = 0)
UNION ALL SELECT 'SUCCESS', '', (SELECT count(*) FROM orders)""",
    "q40_late_field": """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus,
       CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority FROM orders""",
    "q39_rescue_nested": """
SELECT form, o_orderkey AS k, o_custkey AS x, CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END AS n, o_orderstatus AS q,
       CASE WHEN o_orderstatus = 'P' THEN '{"a":"[{\\"y\\":\\"' || o_orderpriority || '\\"},null]","s":"{\\"p\\":{\\"r\\":[1,2]},\\"z\\":{}}"}' END
           AS _rescued_data
FROM orders, (VALUES ('lines'), ('arrays')) AS t(form)""",
}
