"""DuckDB oracle SQL for the registered queries.

The log-message oracles never parse message text: they compute the
expected answer from the ``events`` columns that the messages were rendered
from (recipe in ``lograft.sources.messages``), so they are an independent
check of the Spark parsing code, not a translation of it.
"""

from __future__ import annotations

# Per event: message id, record position, message day/arrival and the flags
# of the recipe.  Shared by every log-message oracle.
_EV = """
ev AS (
  SELECT event_id AS eid, ts, user_id AS uid, event_type,
         event_id // 3 AS msg_id,
         CAST(row_number() OVER (PARTITION BY event_id // 3 ORDER BY event_id) - 1 AS INTEGER)
           AS rec_pos,
         min(event_id) OVER (PARTITION BY event_id // 3) AS first_eid,
         CAST(min(ts) OVER (PARTITION BY event_id // 3) AS DATE) AS mday,
         (event_id % 17 <> 0) AS hdr_ok,
         CAST(event_id % 11 = 0 AS INTEGER) AS b11,
         CAST(event_id % 13 = 0 AS INTEGER) AS b13,
         CAST(event_id % 5 = 0 AS INTEGER) AS b5,
         CAST(event_id % 4 IN (0, 1) AS INTEGER) AS bm,
         CAST(event_id % 6 < 3 AS INTEGER) AS bu
  FROM events)"""

# Expected T9 output per record.
_T9 = _EV + """,
t9raw AS (
  SELECT msg_id, rec_pos, mday, first_eid,
         CASE eid % 3 WHEN 0 THEN '20109' WHEN 1 THEN '10001' ELSE '999' END AS action,
         CASE WHEN b13 = 1 THEN 'r' || (uid % 5) ELSE 's' || (uid % 50) END AS stockcode0,
         CASE WHEN b5 = 1 THEN 'c' || (uid % 9) END AS code0,
         CASE WHEN eid % 4 = 0 THEN '' WHEN eid % 4 = 1 THEN 'm' || uid END AS mobilecode,
         CASE WHEN bu = 1 THEN 'u' || uid END AS uniqueid
  FROM ev),
t9 AS (
  SELECT msg_id, rec_pos, mday AS day,
         CASE WHEN action = '10001' AND coalesce(code0, '') <> '' THEN code0 ELSE stockcode0 END
           AS stockcode,
         CASE WHEN action = '10001' AND coalesce(code0, '') <> '' THEN NULL ELSE code0 END AS code,
         CASE WHEN coalesce(mobilecode, '') = '' AND coalesce(uniqueid, '') <> '' THEN uniqueid
              ELSE coalesce(mobilecode, '') END AS usersign,
         1 AS total_number
  FROM t9raw WHERE action IN ('20109', '10001'))"""

# Expected T6 pairs: the first stockcode line always parses, the second one
# exists when event_id % 13 = 0, the "x=y" line is rejected.
_PAIRS = _EV + """,
pairs AS (
  SELECT msg_id, first_eid, 's' || (uid % 50) AS stockcode FROM ev
  UNION ALL
  SELECT msg_id, first_eid, 'r' || (uid % 5) FROM ev WHERE b13 = 1)"""

_RECORD_TEXT = """
  (CASE WHEN event_type = 'error' THEN '异常' ELSE '正常' END || ':<' ||
   strftime(ts, '%H:%M:%S.%g') || CASE WHEN hdr_ok THEN '>' ELSE '' END ||
   'K' || eid || '[1]' || chr(10) ||
   CASE WHEN eid % 7 = 0 THEN 'StockCode' ELSE 'stockcode' END || '= S' || (uid % 50) ||
   chr(13) || chr(10) ||
   CASE WHEN b11 = 1 THEN 'stockcode=x=y' || chr(10) ELSE '' END ||
   CASE WHEN b13 = 1 THEN 'stockcode=R' || (uid % 5) || chr(10) ELSE '' END ||
   'action=' || CASE eid % 3 WHEN 0 THEN '20109' WHEN 1 THEN '10001' ELSE '999' END ||
   chr(10) ||
   CASE WHEN b5 = 1 THEN 'code=C' || (uid % 9) || chr(10) ELSE '' END ||
   CASE WHEN eid % 4 = 0 THEN 'mobilecode= ' || chr(10)
        WHEN eid % 4 = 1 THEN 'mobilecode=M' || uid || chr(10) ELSE '' END ||
   CASE WHEN bu = 1 THEN 'uniqueid=U' || uid || chr(10) ELSE '' END)"""

# Expected accepted pairs (T2, values as written) with their line positions.
_KV = _EV + """,
kv AS (
  SELECT msg_id, rec_pos, 1 AS line_pos, 'stockcode' AS key, 'S' || (uid % 50) AS value,
         hdr_ok FROM ev
  UNION ALL SELECT msg_id, rec_pos, 2 + b11, 'stockcode', 'R' || (uid % 5), hdr_ok
    FROM ev WHERE b13 = 1
  UNION ALL SELECT msg_id, rec_pos, 2 + b11 + b13, 'action',
    CASE eid % 3 WHEN 0 THEN '20109' WHEN 1 THEN '10001' ELSE '999' END, hdr_ok FROM ev
  UNION ALL SELECT msg_id, rec_pos, 3 + b11 + b13, 'code', 'C' || (uid % 9), hdr_ok
    FROM ev WHERE b5 = 1
  UNION ALL SELECT msg_id, rec_pos, 3 + b11 + b13 + b5, 'mobilecode',
    CASE WHEN eid % 4 = 0 THEN '' ELSE 'M' || uid END, hdr_ok FROM ev WHERE bm = 1
  UNION ALL SELECT msg_id, rec_pos, 3 + b11 + b13 + b5 + bm, 'uniqueid', 'U' || uid, hdr_ok
    FROM ev WHERE bu = 1)"""

_HOT = _T9 + """
SELECT stockcode AS stock_code, strftime(day, '%Y-%m-%d') AS day,
       CAST(sum(total_number) AS BIGINT) AS total_number
FROM t9 WHERE stockcode IS NOT NULL AND strlen(stockcode) <= 128
GROUP BY stockcode, day"""

_WINDOWS = _PAIRS + """,
win AS (
  SELECT ((1704067200000 + first_eid * 200) // 60000) * 60 AS window_start, stockcode,
         count(*) AS n
  FROM pairs GROUP BY 1, 2)"""

_PAYLOADS = _PAIRS + """
SELECT CAST(msg_id % 2 AS INTEGER) AS shard, 'K' || msg_id AS uniqueid,
       '2024-01-15 00:00:00' AS provider, true AS envelope_ok
FROM pairs"""

_ROUTINE = """
SELECT c_custkey AS user_id, c_name AS name, c_nationkey AS age FROM customer"""

ORACLE_SQL = {
    "log_records": "WITH" + _EV + """
SELECT msg_id, rec_pos, """ + _RECORD_TEXT + """ AS record FROM ev""",

    "log_kv": "WITH" + _KV + """
SELECT msg_id, rec_pos, CAST(line_pos AS INTEGER) AS line_pos, key, value FROM kv""",

    "log_header": "WITH" + _EV + """
SELECT msg_id, rec_pos, hdr_ok AS header_ok,
       CASE WHEN hdr_ok THEN CASE WHEN event_type = 'error' THEN '异常' ELSE '正常' END END
         AS logtype,
       CASE WHEN hdr_ok THEN 'K' || eid END AS uniquestr
FROM ev""",

    "log_to_json": "WITH" + _KV + """,
good AS (SELECT msg_id FROM ev GROUP BY msg_id HAVING bool_and(hdr_ok)),
last_kv AS (
  SELECT msg_id, rec_pos, key, arg_max(value, line_pos) AS value FROM kv GROUP BY ALL),
docs AS (
  SELECT msg_id, rec_pos, key, value FROM last_kv
  UNION ALL SELECT msg_id, rec_pos, 'logtype',
    CASE WHEN event_type = 'error' THEN '异常' ELSE '正常' END FROM ev
  UNION ALL SELECT msg_id, rec_pos, 'uniquestr', 'K' || eid FROM ev)
SELECT d.msg_id, d.rec_pos AS doc_pos, d.key, d.value
FROM docs d JOIN good g ON d.msg_id = g.msg_id""",

    "log_rejects": "WITH" + _EV + """
SELECT msg_id, CAST(min(rec_pos) FILTER (WHERE NOT hdr_ok) AS INTEGER) AS first_bad
FROM ev GROUP BY msg_id HAVING NOT bool_and(hdr_ok)""",

    # the rendered headers have one fault only (no ">"), and every third-piece line is the "x=y" one
    "stream_accounting": "WITH" + _PAIRS + """,
m AS (SELECT msg_id, bool_and(hdr_ok) AS ok FROM ev GROUP BY msg_id),
books AS (
  SELECT 'message' AS kind, unnest(['seen', 'accepted', 'rejected', 'no_id', 'null_message', 'short_type', 'only_brackets']) AS outcome,
         unnest([count(*), count(*) FILTER (WHERE ok), count(*) FILTER (WHERE NOT ok), count(*) FILTER (WHERE NOT ok), 0, 0, 0]) AS n
  FROM m
  UNION ALL
  SELECT 'line', unnest(['accepted', 'shard_0', 'shard_1', 'no_shard']),
         unnest([count(*), count(*) FILTER (WHERE msg_id % 2 = 0), count(*) FILTER (WHERE msg_id % 2 = 1), 0]) FROM pairs
  UNION ALL
  SELECT 'line', unnest(['seen', 'not_a_pair']), unnest([count(*) + sum(b11) + sum(b13), sum(b11)]) FROM ev
  UNION ALL
  SELECT 'batch', 'out_of_balance', 0)
SELECT kind, outcome, CAST(n AS BIGINT) AS n FROM books""",

    "stockcode_pairs": "WITH" + _PAIRS + """
SELECT msg_id, stockcode, 1 AS n FROM pairs""",

    "synthetic_events": "WITH" + _PAIRS + """
SELECT msg_id, count(*) AS n, true AS uuid_ok, true AS time_ok, true AS shard_ok
FROM pairs GROUP BY msg_id""",

    "shard_split": "WITH" + _PAIRS + """
SELECT CAST(msg_id % 2 AS INTEGER) AS sink,
       '{"uniqueid":"K' || msg_id || '","provider":"2024-01-15 00:00:00"}' AS payload
FROM pairs""",

    "host_search_events": "WITH" + _T9 + """
SELECT msg_id, rec_pos, stockcode, code, usersign, total_number,
       strftime(day, '%Y-%m-%d') AS day FROM t9""",

    "stockcode_count_60s": "WITH" + _WINDOWS + """
SELECT window_start, stockcode, n FROM win""",

    "stream_count_to_jdbc": "WITH" + _WINDOWS + """
SELECT stockcode AS name, CAST(n AS INTEGER) AS age FROM win""",

    "stockcode_latest_count": "WITH" + _WINDOWS + """
SELECT stockcode, arg_max(n, window_start) AS n, max(window_start) AS window_start
FROM win GROUP BY stockcode""",

    "hot_stock_daily": "WITH" + _HOT,

    "active_user_daily": "WITH" + _T9 + """
SELECT usersign, strftime(day, '%Y-%m-%d') AS day,
       CAST(sum(total_number) AS BIGINT) AS total_number
FROM t9 WHERE strlen(usersign) <= 128 GROUP BY usersign, day""",

    "sum_merge": "WITH" + _HOT,

    "stream_load_batches": "WITH" + _PAYLOADS,

    "append_duplicates": _ROUTINE + " UNION ALL " + _ROUTINE,

    "unique_upsert": """
SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type
FROM events GROUP BY user_id""",

    "daily_retention": "WITH" + _HOT.replace(
        "GROUP BY stockcode, day",
        "AND day BETWEEN DATE '2024-01-08' AND DATE '2024-01-22'\nGROUP BY stockcode, day"),

    "load_constraints": "WITH" + _T9 + """
SELECT msg_id, rec_pos,
       CASE WHEN stockcode IS NULL THEN 'null:stock_code'
            WHEN strlen(stockcode) > 128 THEN 'too_long:stock_code' END AS reject_reason
FROM t9""",

    "csv_ingest": _ROUTINE,

    "json_ingest": _ROUTINE,

    "csv_ingest_rejects": """
SELECT CASE c_custkey % 15 WHEN 0 THEN c_custkey || ',' || c_name || ',x' || c_nationkey
            WHEN 5 THEN c_custkey || ',' || c_name
            ELSE c_custkey || ',' || c_name || ',' || c_nationkey || ',extra' END AS line,
       'malformed' AS reject_reason
FROM customer WHERE c_custkey % 5 = 0""",

    "json_ingest_rejects": """
SELECT '{"user_id":' || c_custkey || ',"name":"' || c_name || '","age":"' ||
         CASE WHEN c_custkey % 15 = 0 THEN 'x' ELSE '' END || c_nationkey || '"' ||
         CASE WHEN c_custkey % 15 = 0 THEN '}' ELSE '' END AS line,
       CASE WHEN c_custkey % 15 = 0 THEN 'bad:age' ELSE 'malformed' END AS reject_reason
FROM customer WHERE c_custkey % 15 IN (0, 5)""",

    "csv_project": """
SELECT CAST(CAST(l_extendedprice AS DECIMAL(20,6)) AS VARCHAR) AS sum_e FROM lineitem""",

    "jdbc_age_increment": """
SELECT c_name AS name, c_nationkey AS age FROM customer
UNION ALL
SELECT c_name AS name, c_nationkey + 1 AS age FROM customer""",

    "event_count_5min": """
SELECT CAST(time_bucket(INTERVAL 5 MINUTE, ts) AS VARCHAR) AS window_start, event_type,
       count(*) AS n
FROM events GROUP BY 1, 2""",

    "word_count": """
WITH lines AS (
  SELECT unnest(CASE WHEN text <> '' AND rtrim(text, chr(10)) = '' THEN []::VARCHAR[]
                     ELSE string_split(rtrim(text, chr(10)), chr(10)) END) AS line
  FROM documents),
words AS (
  SELECT unnest(CASE WHEN line <> '' AND rtrim(line, ' ') = '' THEN []::VARCHAR[]
                     ELSE string_split(rtrim(line, ' '), ' ') END) AS word
  FROM lines)
SELECT word, count(*) AS n FROM words GROUP BY word""",

    "labelled_load": "WITH" + _PAIRS + """
SELECT CAST(msg_id % 2 AS INTEGER) AS shard, 'K' || msg_id AS uniqueid,
       '2024-01-15 00:00:00' AS provider
FROM pairs""",

    "json_ingest_nested": """
SELECT CASE WHEN c_custkey % 15 <> 5 THEN c_custkey END AS user_id,
       CASE WHEN c_custkey % 15 <> 5 THEN c_name END AS name,
       CASE WHEN c_custkey % 15 NOT IN (0, 5) THEN c_nationkey END AS age,
       CASE WHEN c_custkey % 15 NOT IN (5, 10) THEN c_custkey * 2 END AS second,
       CASE c_custkey % 15 WHEN 0 THEN 'bad:age' WHEN 5 THEN 'malformed' END AS reject_reason
FROM customer""",

    "jdbc_split_plan": """
SELECT CASE WHEN o_orderkey % 7 <> 0
            THEN (o_orderkey % 1000) * (o_orderkey % 1000) * (o_orderkey % 1000) END AS key,
       count(*) AS n_rows, count(*) AS n_read
FROM orders GROUP BY 1""",

    "keyed_handover": "WITH" + _PAIRS + """
SELECT CAST(msg_id % 2 AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY msg_id % 2 ORDER BY msg_id) - 1 AS seq,
       '{"uniqueid":"K' || msg_id || '","provider":"2024-01-15 00:00:00"}' AS payload
FROM pairs""",
}
ORACLE_SQL["sql_log_kv"] = ORACLE_SQL["log_kv"]
ORACLE_SQL["sql_log_header"] = ORACLE_SQL["log_header"]
