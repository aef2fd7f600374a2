"""DuckDB oracle SQL for every registered query with a SQL form.

Written from the fixture rules and the job semantics directly against the
base tables (``events orders customer nation region``), independent of the
Spark code paths.
"""

from __future__ import annotations

from tidemark.plans.registry import CURRENT_HOUR_NOW

FX_ORDERS_TIME = """fx_orders_time AS (
  SELECT event_id AS orderId, user_id AS userId, event_type AS province,
         value AS realTotalMoney, ts AS createTime FROM events)"""

FX_BEHAVIOR = """fx_behavior AS (
  SELECT user_id, event_id % 500 AS item_id,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS category_id,
         CASE WHEN event_type = 'purchase' THEN 'buy' ELSE event_type END AS behavior,
         ts FROM events)"""

FX_CATEGORY = """fx_category AS (
  SELECT n_nationkey AS sub_category_id, n_regionkey * 2 + 1 AS parent_category_id,
         r_name AS parent_category_name
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey)"""

FX_ORDERS = """fx_orders AS (
  SELECT o_orderkey AS orderId, o_orderpriority AS orderNo, o_custkey AS userId,
         o_orderkey % 1000 AS goodId,
         CAST(o_totalprice AS DECIMAL(11,2)) AS goodsMoney,
         CAST(o_totalprice AS DECIMAL(11,2)) AS realTotalMoney,
         o_orderkey % 3 AS payFrom, n_name AS province, o_orderdate AS createTime
  FROM orders
  LEFT JOIN (SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey) cn
    ON o_custkey = cn.c_custkey)"""

FX_TEXT = """fx_text AS (
  SELECT strftime(createTime, '%Y-%m-%d %H:%M:%S') AS createTime,
         CAST(goodId AS VARCHAR) AS goodId, CAST(goodsMoney AS VARCHAR) AS goodsMoney,
         CAST(orderId AS VARCHAR) AS orderId, orderNo, CAST(payFrom AS VARCHAR) AS payFrom,
         province, CAST(realTotalMoney AS VARCHAR) AS realTotalMoney,
         CAST(userId AS VARCHAR) AS userId
  FROM fx_orders)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _rk(expr: str) -> str:
    return f"(substr(md5({expr}), 1, 8) || '_' || {expr})"


def _j(a: str, b: str) -> str:
    return f"(coalesce({a}, '') || '|' || coalesce({b}, ''))"


ORDER_FIELDS = ["createTime", "goodId", "goodsMoney", "orderId", "orderNo",
                "payFrom", "province", "realTotalMoney", "userId"]


def _cells(source: str, rowkey: str, extra: str, fields: dict[str, str] | None = None) -> str:
    """Unpivot the order text fields of ``source`` into non-null put cells."""
    parts = []
    for f in ORDER_FIELDS:
        v = (fields or {}).get(f, f)
        parts.append(f"SELECT {rowkey} AS rowkey, {extra}, 'CF' AS family, "
                     f"'{f.upper()}' AS qualifier, {v} AS value FROM {source} WHERE {v} IS NOT NULL")
    return "\n  UNION ALL ".join(parts)


CDC_BASE = _with(FX_ORDERS, FX_TEXT, """img AS (
  SELECT t.*, CAST(t.orderId AS BIGINT) AS oid,
         CAST(CAST(t.orderId AS BIGINT) // 4 AS BIGINT) AS block,
         CASE WHEN CAST(t.orderId AS BIGINT) % 3 = 0
              THEN CAST(CAST(t.realTotalMoney AS DECIMAL(11,2)) + 1 AS VARCHAR)
              ELSE t.realTotalMoney END AS rtm1,
         CASE WHEN CAST(t.orderId AS BIGINT) % 7 = 0 THEN NULL ELSE t.province END AS prov2,
         CAST(CAST(t.orderId AS BIGINT) + (SELECT max(o_orderkey) + 1 FROM orders) AS VARCHAR) AS oid3
  FROM fx_text t)""", """ph AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY phase, block ORDER BY oid) - 1 AS INTEGER) AS pos,
         phase * 1000000000000 + block AS "offset",
         """ + _rk(_j("orderId", "orderNo")) + """ AS rk0,
         """ + _rk(_j("oid3", "orderNo")) + """ AS rk3
  FROM (SELECT 0 AS phase, * FROM img
        UNION ALL SELECT 1, * FROM img WHERE oid % 3 = 0
        UNION ALL SELECT 2, * FROM img WHERE oid % 7 = 0
        UNION ALL SELECT 3, * FROM img WHERE oid % 50 = 0
        UNION ALL SELECT 4, * FROM img WHERE oid % 10 = 1
        UNION ALL SELECT 5, * FROM img WHERE oid % 100 = 1))""")

_PUT = "'dwd:orders' AS hbaseTable, \"offset\", pos, 1 AS kind"
_DEL = "'dwd:orders' AS hbaseTable, \"offset\", pos, 0 AS kind"
_P0 = "(SELECT * FROM ph WHERE phase = 0)"
_P3 = "(SELECT * FROM ph WHERE phase = 3)"
_P5 = "(SELECT * FROM ph WHERE phase = 5)"

CDC_CELLS = CDC_BASE + "SELECT * FROM (\n  " + "\n  UNION ALL ".join([
    _cells(_P0, "rk0", _PUT),
    "SELECT rk0, " + _PUT + ", 'CF', 'REALTOTALMONEY', rtm1 FROM ph WHERE phase = 1",
    "SELECT rk0, " + _PUT + ", 'CF', 'PROVINCE', '' FROM ph WHERE phase = 2",
    "SELECT rk0, " + _DEL + ", NULL, NULL, NULL FROM ph WHERE phase = 3",
    _cells(_P3, "rk3", _PUT, {"orderId": "oid3", "realTotalMoney": "rtm1", "province": "prov2"}),
    "SELECT rk0, " + _DEL + ", NULL, NULL, NULL FROM ph WHERE phase = 4",
    _cells(_P5, "rk0", _PUT),
]) + "\n) ops"

_KEEP = "(SELECT * FROM img WHERE oid % 10 <> 1 AND oid % 50 <> 0)"
_REIN = "(SELECT * FROM img WHERE oid % 100 = 1)"
_MOVED = "(SELECT * FROM img WHERE oid % 50 = 0)"

CDC_STATE = _with(FX_ORDERS, FX_TEXT, """img AS (
  SELECT t.*, CAST(t.orderId AS BIGINT) AS oid,
         CASE WHEN CAST(t.orderId AS BIGINT) % 3 = 0
              THEN CAST(CAST(t.realTotalMoney AS DECIMAL(11,2)) + 1 AS VARCHAR)
              ELSE t.realTotalMoney END AS rtm1,
         CASE WHEN CAST(t.orderId AS BIGINT) % 7 = 0 THEN NULL ELSE t.province END AS prov2,
         CASE WHEN CAST(t.orderId AS BIGINT) % 7 = 0 THEN '' ELSE t.province END AS prov_upd,
         CAST(CAST(t.orderId AS BIGINT) + (SELECT max(o_orderkey) + 1 FROM orders) AS VARCHAR) AS oid3
  FROM fx_text t)""") + "SELECT 'dwd:orders' AS hbaseTable, rowkey, family, qualifier, value FROM (\n  " + "\n  UNION ALL ".join([
    _cells(_KEEP, _rk(_j("orderId", "orderNo")), "1 AS x",
           {"realTotalMoney": "rtm1", "province": "prov_upd"}),
    _cells(_REIN, _rk(_j("orderId", "orderNo")), "1 AS x"),
    _cells(_MOVED, _rk(_j("oid3", "orderNo")), "1 AS x",
           {"orderId": "oid3", "realTotalMoney": "rtm1", "province": "prov2"}),
]) + "\n) s"

CDC_ROUTED = _with(FX_ORDERS) + """
SELECT phase * 1000000000000 + orderId // 4 AS "offset", 'test' AS database, 'orders' AS "table",
       type, 'dwd:orders' AS hbaseTable, 1 AS flowId, count(*) AS n_rows
FROM (SELECT 0 AS phase, 'INSERT' AS type, orderId FROM fx_orders
      UNION ALL SELECT 1, 'UPDATE', orderId FROM fx_orders WHERE orderId % 3 = 0
      UNION ALL SELECT 2, 'UPDATE', orderId FROM fx_orders WHERE orderId % 7 = 0
      UNION ALL SELECT 3, 'UPDATE', orderId FROM fx_orders WHERE orderId % 50 = 0
      UNION ALL SELECT 4, 'DELETE', orderId FROM fx_orders WHERE orderId % 10 = 1
      UNION ALL SELECT 5, 'insert', orderId FROM fx_orders WHERE orderId % 100 = 1) p
GROUP BY ALL"""

CLOSED_USER_HOURS = """dws AS (
  SELECT userId, province, CAST(hour(date_trunc('hour', createTime)) AS BIGINT) AS hour_of_day,
         count(DISTINCT orderId) AS order_num, sum(CAST(realTotalMoney AS DOUBLE)) AS gmv
  FROM fx_orders_time WHERE createTime IS NOT NULL
  GROUP BY userId, province, date_trunc('hour', createTime)
  HAVING date_trunc('hour', createTime) + INTERVAL 1 HOUR
         <= (SELECT max(createTime) FROM fx_orders_time) - INTERVAL 5 SECOND)"""

ORACLE_SQL: dict[str, str] = {
    "orders_per_hour": _with(FX_ORDERS_TIME, """dws AS (
  SELECT strftime(date_trunc('hour', createTime), '%Y-%m-%d %H') AS day_hour_time,
         count(DISTINCT orderId) AS order_num
  FROM fx_orders_time WHERE createTime IS NOT NULL GROUP BY date_trunc('hour', createTime))""")
    + "SELECT day_hour_time, max(order_num) AS buy_cnt FROM dws GROUP BY day_hour_time",

    "orders_per_minute": _with(FX_ORDERS_TIME, """dws AS (
  SELECT strftime(date_trunc('minute', createTime), '%Y-%m-%d %H:%M') AS day_time_str,
         count(DISTINCT orderId) AS order_num
  FROM fx_orders_time WHERE createTime IS NOT NULL GROUP BY date_trunc('minute', createTime))""")
    + "SELECT substring(day_time_str, 1, 10) AS dt, day_time_str, max(order_num) AS buy_cnt "
      "FROM dws GROUP BY day_time_str",

    "user_province_hour_windows": _with(FX_ORDERS_TIME) + """
SELECT userId, province, CAST(hour(date_trunc('hour', createTime)) AS BIGINT) AS hour_of_day,
       count(DISTINCT orderId) AS order_num, round(sum(CAST(realTotalMoney AS DOUBLE)), 2) AS gmv
FROM fx_orders_time WHERE createTime IS NOT NULL
GROUP BY userId, province, date_trunc('hour', createTime)""",

    "user_province_hour_app": _with(FX_ORDERS_TIME, """dws AS (
  SELECT userId, province, CAST(hour(date_trunc('hour', createTime)) AS BIGINT) AS hour_of_day,
         count(DISTINCT orderId) AS order_num, sum(CAST(realTotalMoney AS DOUBLE)) AS gmv
  FROM fx_orders_time WHERE createTime IS NOT NULL
  GROUP BY userId, province, date_trunc('hour', createTime))""") + """
SELECT userId, province, hour_of_day, max(order_num) AS buy_cnt, round(max(gmv), 2) AS gmv
FROM dws GROUP BY userId, province, hour_of_day""",

    "uv_10min": _with(FX_BEHAVIOR, """dws AS (
  SELECT substring(strftime(ts, '%Y-%m-%d %H:%M:%S'), 1, 15) || '0' AS day_time_str,
         count(DISTINCT user_id) AS uv
  FROM fx_behavior WHERE ts IS NOT NULL GROUP BY 1)""")
    + "SELECT day_time_str, max(uv) AS uv FROM dws GROUP BY day_time_str",

    "category_enriched": _with(FX_BEHAVIOR, FX_CATEGORY) + """
SELECT b.user_id, b.item_id, b.behavior,
       CASE WHEN c.parent_category_id IN (1, 2, 3, 4, 5, 6, 7, 8) THEN c.parent_category_name
            ELSE '其他' END AS category_name
FROM fx_behavior b LEFT JOIN fx_category c ON b.category_id = c.sub_category_id""",

    "category_counts": _with(FX_BEHAVIOR, FX_CATEGORY, """dws AS (
  SELECT CASE WHEN c.parent_category_id IN (1, 2, 3, 4, 5, 6, 7, 8) THEN c.parent_category_name
              ELSE '其他' END AS category_name, count(*) AS order_num
  FROM fx_behavior b LEFT JOIN fx_category c ON b.category_id = c.sub_category_id
  WHERE b.behavior = 'buy' GROUP BY 1)""")
    + "SELECT category_name, max(order_num) AS buy_cnt FROM dws GROUP BY category_name",

    "dwd_orders_cast": _with(FX_ORDERS, FX_TEXT) + """
SELECT TRY_CAST(orderId AS BIGINT) AS orderId, orderNo, TRY_CAST(userId AS BIGINT) AS userId,
       TRY_CAST(goodId AS BIGINT) AS goodId, TRY_CAST(goodsMoney AS DOUBLE) AS goodsMoney,
       TRY_CAST(realTotalMoney AS DOUBLE) AS realTotalMoney, TRY_CAST(payFrom AS BIGINT) AS payFrom,
       province, TRY_CAST(createTime AS TIMESTAMP) AS createTime
FROM fx_text""",

    "dwd_current_hour": _with(FX_ORDERS, FX_TEXT) + f"""
SELECT TRY_CAST(orderId AS BIGINT) AS orderId, orderNo, TRY_CAST(userId AS BIGINT) AS userId,
       TRY_CAST(goodId AS BIGINT) AS goodId, TRY_CAST(goodsMoney AS DOUBLE) AS goodsMoney,
       TRY_CAST(realTotalMoney AS DOUBLE) AS realTotalMoney, TRY_CAST(payFrom AS BIGINT) AS payFrom,
       province, TRY_CAST(createTime AS TIMESTAMP) AS createTime
FROM fx_text
WHERE substring(createTime, 1, 13) = strftime(TIMESTAMP '{CURRENT_HOUR_NOW}' + INTERVAL 8 HOUR, '%Y-%m-%d %H')""",

    "user_orders": _with(FX_ORDERS, FX_TEXT) + """
SELECT userId AS rowkey, userId AS user_id, count(DISTINCT orderId) AS order_num,
       round(sum(TRY_CAST(realTotalMoney AS DOUBLE)), 2) AS gmv
FROM fx_text GROUP BY userId""",

    "user_province_orders": _with(FX_ORDERS, FX_TEXT) + """
SELECT userId, province, count(DISTINCT orderId) AS order_num,
       round(sum(TRY_CAST(realTotalMoney AS DOUBLE)), 2) AS gmv
FROM fx_text GROUP BY userId, province""",

    "user_orders_md5": _with(FX_ORDERS, FX_TEXT) + """
SELECT md5(userId) || '_' || userId AS rowkey, userId AS user_id, count(DISTINCT orderId) AS order_num
FROM fx_text GROUP BY userId""",

    "item_counts_upsert": _with(FX_BEHAVIOR, """c AS (
  SELECT item_id, category_id, behavior, ts, count(*) AS cnt
  FROM fx_behavior GROUP BY item_id, category_id, behavior, ts)""", """r AS (
  SELECT *, row_number() OVER (PARTITION BY item_id
         ORDER BY ts DESC NULLS LAST, category_id DESC NULLS LAST, behavior DESC NULLS LAST) AS rn
  FROM c)""") + """
SELECT CAST(item_id AS VARCHAR) AS rowkey, CAST(item_id AS VARCHAR) AS item_id,
       CAST(category_id AS VARCHAR) AS category_id, behavior, ts, cnt
FROM r WHERE rn = 1""",

    "user_top1": _with(FX_ORDERS_TIME, """dws AS (
  SELECT userId, province, CAST(hour(date_trunc('hour', createTime)) AS BIGINT) AS hour_of_day,
         count(DISTINCT orderId) AS order_num, sum(CAST(realTotalMoney AS DOUBLE)) AS gmv
  FROM fx_orders_time WHERE createTime IS NOT NULL
  GROUP BY userId, province, date_trunc('hour', createTime))""", """r AS (
  SELECT *, row_number() OVER (PARTITION BY userId ORDER BY order_num DESC NULLS LAST,
         gmv DESC NULLS LAST, province DESC NULLS LAST, hour_of_day DESC NULLS LAST) AS rownum
  FROM dws)""") + """
SELECT userId, province, hour_of_day, order_num, round(gmv, 2) AS gmv FROM r WHERE rownum = 1""",

    "salted_row_key": _with(FX_ORDERS) + """
SELECT orderId, orderNo,
       substr(md5(CAST(orderId AS VARCHAR) || '|' || coalesce(orderNo, '')), 1, 8) || '_'
         || CAST(orderId AS VARCHAR) || '|' || coalesce(orderNo, '') AS rowkey
FROM fx_orders""",

    "cdc_routed": CDC_ROUTED,
    "cdc_cells": CDC_CELLS,
    "cdc_state": CDC_STATE,
    "cdc_user_orders": "WITH cells AS (" + CDC_STATE + """), kv AS (
  SELECT rowkey,
         max(CASE WHEN lower(qualifier) = 'userid' THEN value END) AS userId,
         max(CASE WHEN lower(qualifier) = 'orderid' THEN value END) AS orderId,
         max(CASE WHEN lower(qualifier) = 'realtotalmoney' THEN value END) AS realTotalMoney
  FROM cells GROUP BY rowkey)
SELECT userId AS rowkey, userId AS user_id, count(DISTINCT orderId) AS order_num,
       round(sum(TRY_CAST(realTotalMoney AS DOUBLE)), 2) AS gmv
FROM kv GROUP BY userId""",

    # Replays: only windows the 5 s watermark has closed by the end of input.
    "stream_orders_per_hour": _with(FX_ORDERS_TIME, """dws AS (
  SELECT strftime(date_trunc('hour', createTime), '%Y-%m-%d %H') AS day_hour_time,
         count(DISTINCT orderId) AS order_num
  FROM fx_orders_time WHERE createTime IS NOT NULL GROUP BY date_trunc('hour', createTime)
  HAVING date_trunc('hour', createTime) + INTERVAL 1 HOUR
         <= (SELECT max(createTime) FROM fx_orders_time) - INTERVAL 5 SECOND)""")
    + "SELECT day_hour_time, max(order_num) AS buy_cnt FROM dws GROUP BY day_hour_time",

    "stream_uv_10min": _with(FX_BEHAVIOR, """dws AS (
  SELECT substring(strftime(ts, '%Y-%m-%d %H:%M:%S'), 1, 15) || '0' AS day_time_str,
         count(DISTINCT user_id) AS uv
  FROM fx_behavior WHERE ts IS NOT NULL GROUP BY time_bucket(INTERVAL 10 MINUTE, ts), 1
  HAVING time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 10 MINUTE
         <= (SELECT max(ts) FROM fx_behavior) - INTERVAL 5 SECOND)""")
    + "SELECT day_time_str, max(uv) AS uv FROM dws GROUP BY day_time_str",

    "stream_category_counts": _with(FX_BEHAVIOR, FX_CATEGORY, """dws AS (
  SELECT CASE WHEN c.parent_category_id IN (1, 2, 3, 4, 5, 6, 7, 8) THEN c.parent_category_name
              ELSE '其他' END AS category_name, count(*) AS order_num
  FROM fx_behavior b LEFT JOIN fx_category c ON b.category_id = c.sub_category_id
  WHERE b.behavior = 'buy' GROUP BY 1)""")
    + "SELECT category_name, max(order_num) AS buy_cnt FROM dws GROUP BY category_name",

    "stream_cdc_state": CDC_STATE,

    "stream_user_province_hour_app": _with(FX_ORDERS_TIME, CLOSED_USER_HOURS) + """
SELECT userId, province, hour_of_day, max(order_num) AS buy_cnt, round(max(gmv), 2) AS gmv
FROM dws GROUP BY userId, province, hour_of_day""",

    "stream_user_orders": _with(FX_ORDERS_TIME) + """
SELECT userId, count(DISTINCT orderId) AS order_num, round(sum(realTotalMoney), 2) AS gmv
FROM fx_orders_time GROUP BY userId""",


    "stream_user_top1": _with(FX_ORDERS_TIME, CLOSED_USER_HOURS, """r AS (
  SELECT *, row_number() OVER (PARTITION BY userId ORDER BY order_num DESC NULLS LAST,
         gmv DESC NULLS LAST, province DESC NULLS LAST, hour_of_day DESC NULLS LAST) AS rownum
  FROM dws)""") + """
SELECT userId, province, hour_of_day, order_num, round(gmv, 2) AS gmv FROM r WHERE rownum = 1""",

    "adhoc_sql": _with(FX_ORDERS) + """
SELECT CAST(userId AS VARCHAR) AS customer, count(DISTINCT orderId) AS orders_placed,
       CAST(min(CAST(createTime AS DATE)) AS VARCHAR) AS first_day,
       round(sum(CAST(realTotalMoney AS DOUBLE)) FILTER (WHERE payFrom = 1), 2) AS paid_by_card
FROM fx_orders GROUP BY userId""",
}
ORACLE_SQL["stream_orders_per_minute"] = _with(FX_ORDERS_TIME, """dws AS (
  SELECT strftime(date_trunc('minute', createTime), '%Y-%m-%d %H:%M') AS day_time_str,
         count(DISTINCT orderId) AS order_num
  FROM fx_orders_time WHERE createTime IS NOT NULL GROUP BY date_trunc('minute', createTime)
  HAVING date_trunc('minute', createTime) + INTERVAL 1 MINUTE
         <= (SELECT max(createTime) FROM fx_orders_time) - INTERVAL 5 SECOND)""") + """
SELECT substring(day_time_str, 1, 10) AS dt, day_time_str, max(order_num) AS buy_cnt FROM dws GROUP BY day_time_str"""
# Late rows count only where their window ends after the first slice's watermark.
ORACLE_SQL["stream_late_rows"] = """WITH marks AS (
  SELECT max(ts) FILTER (WHERE event_id % 4 <> 3) - INTERVAL 5 SECOND AS first_mark,
         max(ts) - INTERVAL 5 SECOND AS last_mark FROM events),
kept AS (
  SELECT user_id, time_bucket(INTERVAL 10 MINUTE, ts) AS w FROM events, marks
  WHERE event_id % 4 <> 3 OR time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 10 MINUTE > first_mark)
SELECT strftime(w, '%Y-%m-%d %H:%M') AS day_time_str, count(DISTINCT user_id) AS uv
FROM kept, marks WHERE w + INTERVAL 10 MINUTE <= last_mark GROUP BY w"""
ORACLE_SQL["stream_category_refreshed"] = _with(FX_CATEGORY) + """
SELECT CASE WHEN c.parent_category_id IN (1, 2, 3, 4, 5, 6, 7, 8) THEN c.parent_category_name
            ELSE '其他' END AS category_name, count(*) AS buy_cnt
FROM events e LEFT JOIN fx_category c
  ON TRY_CAST(json_extract_string(e.props, '$.k') AS INTEGER) = c.sub_category_id
 AND (e.event_id % 2 = 1 OR c.sub_category_id < 10)
WHERE e.event_type = 'purchase' GROUP BY 1"""
_SYNCED = "WITH cells AS (" + CDC_STATE + "), kv AS (SELECT rowkey, " + ", ".join(
    f"max(CASE WHEN lower(qualifier) = '{f.lower()}' THEN value END) AS {f}" for f in ORDER_FIELDS) + \
    " FROM cells GROUP BY rowkey)\n"
ORACLE_SQL["stream_cdc_user_orders"] = ORACLE_SQL["cdc_user_orders"]
ORACLE_SQL["stream_cdc_dwd_current_hour"] = _SYNCED + f"""
SELECT TRY_CAST(orderId AS BIGINT) AS orderId, orderNo, TRY_CAST(userId AS BIGINT) AS userId,
       TRY_CAST(goodId AS BIGINT) AS goodId, TRY_CAST(goodsMoney AS DOUBLE) AS goodsMoney,
       TRY_CAST(realTotalMoney AS DOUBLE) AS realTotalMoney, TRY_CAST(payFrom AS BIGINT) AS payFrom,
       province, TRY_CAST(createTime AS TIMESTAMP) AS createTime
FROM kv
WHERE substring(createTime, 1, 13) = strftime(TIMESTAMP '{CURRENT_HOUR_NOW}' + INTERVAL 8 HOUR, '%Y-%m-%d %H')"""
ORACLE_SQL["stream_cdc_sql"] = _SYNCED + """
SELECT payFrom AS channel, count(*) AS orders_kept, round(sum(CAST(realTotalMoney AS DOUBLE)), 2) AS money
FROM kv GROUP BY payFrom"""
ORACLE_SQL["stream_item_counts_late"] = ORACLE_SQL["item_counts_upsert"]
ORACLE_SQL["stream_item_counts_upsert"] = ORACLE_SQL["item_counts_upsert"]
ORACLE_SQL["stream_topic_select"] = _with(FX_BEHAVIOR) + """
SELECT user_id, item_id, CAST(category_id AS BIGINT) AS category_id, behavior, ts FROM fx_behavior"""
ORACLE_SQL["stream_dropped_rows"] = """WITH marks AS (
  SELECT max(ts) FILTER (WHERE event_id % 4 <> 3) - INTERVAL 5 SECOND AS mark FROM events)
SELECT 'orders_dws' AS query, CAST(count(*) AS BIGINT) AS dropped_rows FROM events, marks
WHERE event_id % 4 = 3 AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= mark"""
ORACLE_SQL["dwd_rejects"] = """SELECT count(*) AS rows_read, count(*) FILTER (WHERE o_orderkey % 10 NOT IN (3, 7)) AS rows_kept,
  count(*) FILTER (WHERE o_orderkey % 10 IN (3, 7)) AS rows_rejected FROM orders"""
ORACLE_SQL["stream_cdc_config_change"] = """WITH rows AS (
  SELECT 'dwd:customer' AS hbaseTable, CAST(c_custkey AS VARCHAR) AS id,
         unnest([{'q': 'c_custkey', 'v': CAST(c_custkey AS VARCHAR)}, {'q': 'c_name', 'v': c_name}]) AS cell FROM customer
  UNION ALL
  SELECT 'dwd:supplier', CAST(s_suppkey AS VARCHAR),
         unnest([{'q': 'S_SUPPKEY', 'v': CAST(s_suppkey AS VARCHAR)}, {'q': 'S_NAME', 'v': s_name}])
  FROM supplier WHERE s_suppkey % 3 <> 0)
SELECT hbaseTable, substr(md5(id), 1, 8) || '_' || id AS rowkey, 'cf' AS family, cell.q AS qualifier, cell.v AS value
FROM rows WHERE cell.v IS NOT NULL"""
ORACLE_SQL["stream_latest_start"] = """SELECT user_id, event_id % 500 AS item_id,
  TRY_CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS BIGINT) AS category_id,
  CASE WHEN event_type = 'purchase' THEN 'buy' ELSE event_type END AS behavior, ts
FROM events WHERE event_id % 2 = 1"""
ORACLE_SQL["adhoc_ddl"] = _with(FX_ORDERS) + """, totals AS (
  SELECT userId, count(DISTINCT orderId) AS n, sum(CAST(realTotalMoney AS DOUBLE)) AS gmv FROM fx_orders GROUP BY userId)
SELECT c_mktsegment AS segment, count(*) AS customers, CAST(sum(n) AS BIGINT) AS orders_placed, round(sum(gmv), 2) AS gmv
FROM totals JOIN customer ON userId = c_custkey GROUP BY c_mktsegment"""
ORACLE_SQL["insert_into_topic"] = """SELECT user_id, event_type AS kind, count(*) AS n, round(sum(value), 2) AS amount,
  max(ts) AS latest FROM events WHERE event_type = 'purchase' OR value > 50 GROUP BY user_id, event_type"""
