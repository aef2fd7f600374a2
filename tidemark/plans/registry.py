"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each reads the shared test tables through ``plans.fixtures`` and returns a
flat result (structs expanded, sums rounded to 2 decimals) so it can be
compared with the DuckDB oracle in ``plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import aggregates as agg
from tidemark.operators import cdc
from tidemark.operators.compact import top1_desc
from tidemark.operators.keyed import dwd_orders
from tidemark.operators.lookup import enrich_category
from tidemark.functions.keys import row_key
from tidemark.plans import fixtures as fx
from tidemark.plans import jobs

# Fixed clock for the current-hour extract: 16:30 UTC is 00:30 next day at UTC+8.
CURRENT_HOUR_NOW = "1998-08-01 16:30:00"

# A statement of the kind an analyst types: text fields of the keyed order table.
ADHOC_SQL = """
WITH per_customer AS (
  SELECT userId AS customer, count(DISTINCT orderId) AS orders_placed,
         substring(min(createTime), 1, 10) AS first_day,
         sum(CASE WHEN payFrom = '1' THEN CAST(realTotalMoney AS DOUBLE) END) AS by_card
  FROM keyed_orders GROUP BY userId)
SELECT customer, orders_placed, first_day, round(by_card, 2) AS paid_by_card FROM per_customer
"""


def register_warehouse(spark: SparkSession, sf_dir: str) -> None:
    """Temp views for ad-hoc SQL: the keyed order table (as ``keyed_orders`` with
    its family expanded), the behaviour log and the category dimension."""
    fx.orders_text(spark, sf_dir).createOrReplaceTempView("keyed_orders")
    fx.orders_kv(spark, sf_dir).createOrReplaceTempView("dwd_orders_kv")
    fx.behavior(spark, sf_dir).createOrReplaceTempView("user_behavior")
    fx.category(spark, sf_dir).createOrReplaceTempView("dim_category")
    fx.orders_time(spark, sf_dir).createOrReplaceTempView("dwd_kafka_orders")


def adhoc_sql(spark: SparkSession, sf_dir: str, text: str = ADHOC_SQL) -> DataFrame:
    register_warehouse(spark, sf_dir)
    return spark.sql(text)


def _money(df: DataFrame) -> DataFrame:
    """Sums rounded for comparison with the oracle; the jobs keep them as they are."""
    return df.withColumn("gmv", F.round("gmv", 2))


def q_orders_per_hour(spark, d):
    return jobs.orders_per_hour_app(jobs.orders_per_hour(fx.orders_time(spark, d)))


def q_orders_per_minute(spark, d):
    return jobs.orders_per_minute_app(jobs.orders_per_minute(fx.orders_time(spark, d)))


def q_user_province_hour_windows(spark, d):
    return _money(jobs.user_province_hour(fx.orders_time(spark, d)))


def q_user_province_hour_app(spark, d):
    return _money(jobs.user_province_hour_app(jobs.user_province_hour(fx.orders_time(spark, d))))


def q_uv_10min(spark, d):
    return jobs.uv_10min_app(jobs.uv_10min(fx.behavior(spark, d)))


def q_category_enriched(spark, d):
    return enrich_category(fx.behavior(spark, d), fx.category(spark, d))


def q_category_counts(spark, d):
    return jobs.category_counts_app(jobs.category_counts(fx.behavior(spark, d), fx.category(spark, d)))


def q_dwd_orders_cast(spark, d):
    return dwd_orders(jobs.order_text(fx.orders_kv(spark, d)))


def q_dwd_current_hour(spark, d):
    return jobs.dwd_current_hour(fx.orders_kv(spark, d), now=CURRENT_HOUR_NOW)


def q_user_orders(spark, d):
    t = agg.user_totals_keyed(fx.orders_text(spark, d))
    return t.select("rowkey", "cf.user_id", "cf.order_num", F.round("cf.gmv", 2).alias("gmv"))


def q_user_province_orders(spark, d):
    t = agg.order_totals(fx.orders_text(spark, d), ["userId", "province"])
    return t.select("userId", "province", "order_num", F.round("gmv", 2).alias("gmv"))


def q_user_orders_md5(spark, d):
    return agg.user_order_counts_md5(fx.orders_text(spark, d)).select("rowkey", "cf.*")


def q_item_counts_upsert(spark, d):
    return agg.item_counts_upsert(agg.item_counts(fx.behavior(spark, d))).select("rowkey", "CF.*")


def q_user_top1(spark, d):
    dws = jobs.user_province_hour(fx.orders_time(spark, d))
    return _money(top1_desc(dws, ["userId"], ["order_num", "gmv"]))


def q_salted_row_key(spark, d):
    o = fx.orders(spark, d)
    return o.select("orderId", "orderNo", row_key(["orderId", "orderNo"]).alias("rowkey"))


def _routed(spark, d):
    msgs, _ = cdc.parse_changelog(fx.changelog(spark, d))
    return cdc.route(msgs, fx.flow(spark))


def q_cdc_routed(spark, d):
    r = _routed(spark, d)
    return r.select("offset", "database", "table", "type", "hbaseTable", "flowId",
                    F.size("data").cast("bigint").alias("n_rows"))


def q_cdc_cells(spark, d):
    return cdc.to_ops(_routed(spark, d))


def q_cdc_state(spark, d):
    cells = cdc.to_cells(cdc.live_cells(cdc.fold(cdc.to_ops(_routed(spark, d), wide=True))))
    return cells.select("hbaseTable", "rowkey", "family", "qualifier", "value")


def q_cdc_user_orders(spark, d):
    """The whole order path: binlog -> CDC-maintained keyed order table ->
    per-user totals in the keyed DWS table."""
    from tidemark.operators.keyed import ORDER_FIELDS
    cells = cdc.live_cells(cdc.fold(cdc.to_ops(_routed(spark, d), wide=True)))
    kv = cdc.state_to_keyed(cells, "cf", list(ORDER_FIELDS), table="dwd:orders")
    t = agg.user_totals_keyed(jobs.order_text(kv))
    return t.select("rowkey", "cf.user_id", "cf.order_num", F.round("cf.gmv", 2).alias("gmv"))


def q_adhoc_sql(spark, d):
    return adhoc_sql(spark, d)


# Streaming replays: a table replayed through a shipped streaming job, slice by
# slice on one checkpoint (see ``streaming.replay``).


def _slices(spark, d, *tables):
    from tidemark.streaming.replay import slices_for
    return slices_for(spark, [f"{d.rstrip('/')}/{t}.parquet" for t in tables])


def _window_replay(spark, d, job, source):
    from tidemark.streaming.replay import replay_window_job
    return replay_window_job(spark, job, source, _slices(spark, d, "events"))


def q_stream_orders_per_hour(spark, d):
    """Closed hours only: the last window stays open at the end of the input."""
    from tidemark.streaming import jobs as sj
    return _window_replay(spark, d, sj.ORDERS_PER_HOUR, fx.orders_time(spark, d))


def q_stream_orders_per_minute(spark, d):
    """Closed minutes only: the last window stays open at the end of the input."""
    from tidemark.streaming import jobs as sj
    return _window_replay(spark, d, sj.ORDERS_PER_MINUTE, fx.orders_time(spark, d))


def q_stream_uv_10min(spark, d):
    """Closed ten minutes only: the last window stays open at the end of the input."""
    from tidemark.streaming import jobs as sj
    return _window_replay(spark, d, sj.UV_10MIN, fx.behavior(spark, d))


def q_stream_user_province_hour_app(spark, d):
    """Closed hours only: the last windows stay open at the end of the input."""
    from tidemark.streaming import jobs as sj
    return _money(_window_replay(spark, d, sj.USER_PROVINCE_HOUR, fx.orders_time(spark, d)))


def _late(spark, d):
    """Behaviour in two slices: the events whose id leaves 3 modulo 4 come after all others."""
    from tidemark.streaming.replay import Replay
    rows = fx.behavior(spark, d, keep=["event_id"])
    return Replay(rows, (F.col("event_id") % 4 == 3).cast("int"), 2)


def q_stream_late_rows(spark, d):
    """A second slice whose rows are late for every window that the first one closed.

    Unique visitors per 10 minutes: the windows of the first slice but the last
    are closed by its watermark, so the late rows change only windows that end
    after it."""
    from tidemark.sources.tables import keyed_table
    from tidemark.streaming import jobs as sj
    from tidemark.streaming.replay import AVAILABLE_NOW, wait
    replay = _late(spark, d)
    at, job = replay.root, sj.UV_10MIN
    replay.run(lambda stream: sj.start_dws(job, stream, f"{at}/dws", f"{at}/ckpt", AVAILABLE_NOW))
    wait(sj.start_app(spark, f"{at}/dws", job.dws_schema, job.app, job.app_keys, f"{at}/app",
                      f"{at}/ckpt/app", AVAILABLE_NOW))
    return keyed_table(spark, f"{at}/app")


def q_stream_category_counts(spark, d):
    from tidemark.streaming.replay import by_time, replay_category_job
    replay = by_time(fx.behavior(spark, d), "ts", _slices(spark, d, "events"))
    return replay_category_job(spark, replay, lambda: fx.category(spark, d))


def q_stream_category_refreshed(spark, d):
    """The lookup table grows while the job runs: the first slice (even event
    ids) sees categories 0 to 9, the second all of them."""
    from tidemark.streaming.replay import Replay, replay_category_job
    loads = []

    def load():
        loads.append(1)
        dim = fx.category(spark, d)
        return dim.filter("sub_category_id < 10") if len(loads) == 1 else dim

    replay = Replay(fx.behavior(spark, d, keep=["event_id"]), F.col("event_id") % 2, 2)
    return replay_category_job(spark, replay, load, max_age_s=0.0)


def q_stream_user_orders(spark, d):
    """Un-windowed per-user distinct orders and GMV on a stream (orders as events)."""
    from tidemark.streaming import jobs as sj
    from tidemark.streaming.replay import AVAILABLE_NOW, by_time
    replay = by_time(fx.orders_time(spark, d), "createTime", _slices(spark, d, "events"))
    at = replay.root
    replay.run(lambda stream: sj.start_user_totals_stream(spark, stream, f"{at}/t", f"{at}/ckpt", AVAILABLE_NOW))
    return _money(sj.read_user_totals(spark, f"{at}/t").select("userId", "order_num", "gmv"))


def _item_counts(spark, replay):
    from tidemark.sources.tables import keyed_table
    from tidemark.streaming import jobs as sj
    from tidemark.streaming.replay import AVAILABLE_NOW
    at = replay.root
    replay.run(lambda stream: sj.start_item_counts(spark, stream, f"{at}/t", f"{at}/ckpt", AVAILABLE_NOW))
    t = keyed_table(spark, f"{at}/t")
    return t.select(F.col("item_id").cast("string").alias("rowkey"),
                    F.col("item_id").cast("string").alias("item_id"),
                    F.col("category_id").cast("string").alias("category_id"),
                    "behavior", F.col("ts").cast("timestamp_ntz").alias("ts"), "cnt")


def q_stream_item_counts_upsert(spark, d):
    from tidemark.streaming.replay import by_time
    return _item_counts(spark, by_time(fx.behavior(spark, d), "ts", _slices(spark, d, "events")))


def q_stream_item_counts_late(spark, d):
    """A quarter of the rows arrives after all others, late by any watermark: all count."""
    return _item_counts(spark, _late(spark, d))


def q_stream_user_top1(spark, d):
    """Hourly per-user windows on a stream (append; closed hours only), then the
    best window per user on the resulting DWS stream (update), upserted."""
    from tidemark.sources.tables import keyed_table
    from tidemark.sources.topic import json_topic
    from tidemark.streaming import jobs as sj
    from tidemark.streaming.replay import AVAILABLE_NOW, by_time, wait
    replay = by_time(fx.orders_time(spark, d), "createTime", _slices(spark, d, "events"))
    at, job = replay.root, sj.USER_PROVINCE_HOUR
    replay.run(lambda stream: sj.start_dws(job, stream, f"{at}/dws", f"{at}/ckpt", AVAILABLE_NOW))
    dws = json_topic(spark, f"{at}/dws", job.dws_schema)
    wait(sj.start_user_top1(spark, dws, f"{at}/top", f"{at}/ckpt/top", AVAILABLE_NOW))
    return _money(keyed_table(spark, f"{at}/top").select("userId", "province", "hour_of_day", "order_num", "gmv"))


def _cdc_table(spark, d):
    """The changelog replayed through the CDC sync, folding its files every 2 batches; the table's path."""
    from tidemark.streaming.cdc_apply import start_cdc_sync
    from tidemark.streaming.replay import AVAILABLE_NOW, Replay, SLICES
    phase = F.floor(F.col("offset") / fx.PHASE_STRIDE)
    n = max(SLICES, _slices(spark, d, "orders"))
    part = F.when(phase == 0, F.pmod(F.col("offset"), F.lit(n - 2))).when(phase < 4, n - 2).otherwise(n - 1)
    replay = Replay(fx.changelog(spark, d), part, n, dealt=True)
    at = replay.root
    replay.run(lambda stream: start_cdc_sync(spark, stream, lambda: fx.flow(spark), f"{at}/table", f"{at}/ckpt",
                                             AVAILABLE_NOW, fold_every=2))
    return f"{at}/table"


def q_stream_cdc_state(spark, d):
    """Live cells of the keyed state that the streaming CDC sync maintains."""
    from tidemark.sinks.keyed_state import KeyedStateTable
    cells = KeyedStateTable(spark, _cdc_table(spark, d)).cells()
    return cells.select("hbaseTable", "rowkey", "family", "qualifier", "value")


def q_stream_cdc_user_orders(spark, d):
    """The order path as shipped: CDC sync, its table opened by the per-user job, its result read back."""
    from tidemark.session import scratch_path
    from tidemark.sources.tables import keyed_table
    from tidemark.streaming import jobs as sj
    out = scratch_path(spark, "user_totals")
    sj.run_user_totals(keyed_table(spark, _cdc_table(spark, d)), out)
    return _money(keyed_table(spark, out).select("rowkey", "cf.user_id", "cf.order_num", "cf.gmv"))


def q_stream_cdc_dwd_current_hour(spark, d):
    """The hourly extract of the table that the CDC sync maintains."""
    from tidemark.sources.tables import keyed_table
    return jobs.dwd_current_hour(keyed_table(spark, _cdc_table(spark, d)), now=CURRENT_HOUR_NOW)


def q_stream_cdc_sql(spark, d):
    """Ad-hoc SQL over the table that the CDC sync wrote, registered by name and path."""
    from tidemark.sources.tables import register
    register(spark, {"synced_orders": _cdc_table(spark, d)})
    return spark.sql("SELECT payFrom AS channel, count(*) AS orders_kept, "
                     "round(sum(CAST(realTotalMoney AS DOUBLE)), 2) AS money FROM synced_orders GROUP BY payFrom")


def q_stream_topic_select(spark, d):
    """The behaviour log as a topic of JSON text records (ids quoted, as a
    producer may send them), read as a stream: parsed with the declared text
    schema, typed with ``try_cast``, event time with the 5 s watermark,
    ``SELECT *`` appended to a topic; the topic read back."""
    from tidemark import schemas
    from tidemark.sinks.topic import append_topic
    from tidemark.sources.topic import json_topic, parse_json
    from tidemark.streaming.event_time import with_event_time
    from tidemark.streaming.replay import AVAILABLE_NOW, by_time
    b = fx.behavior(spark, d)
    record = F.struct(*[F.col(c).cast("string").alias(c) for c in ("user_id", "item_id", "category_id")],
                      "behavior", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"))
    replay = by_time(b.select("ts", F.to_json(record).alias("value")), "ts", _slices(spark, d, "events"))
    at = replay.root

    def start(raw):
        rows = with_event_time(schemas.typed_behavior(parse_json(raw.select("value"), schemas.USER_BEHAVIOR_TEXT)),
                               "ts")
        return append_topic(rows.select("*"), f"{at}/out", f"{at}/ckpt", AVAILABLE_NOW)

    replay.run(start)
    out = json_topic(spark, f"{at}/out", schemas.USER_BEHAVIOR, streaming=False)
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def q_stream_dropped_rows(spark, d):
    """Rows that the hourly orders job drops as late, as its listener reports them.

    The second slice is late for all windows that the first one closed; every order
    id is one row, so nothing is combined before Spark counts."""
    from tidemark.streaming import jobs as sj
    from tidemark.streaming.progress import ProgressTable, dropped_rows
    from tidemark.streaming.replay import AVAILABLE_NOW, Replay
    rows = fx.orders_time(spark, d)
    replay = Replay(rows, (F.col("orderId") % 4 == 3).cast("int"), 2)
    at = replay.root
    with ProgressTable(spark, f"{at}/progress") as seen:
        for stream in replay:
            seen.wait(sj.start_dws(sj.ORDERS_PER_HOUR, stream, f"{at}/dws", f"{at}/ckpt", AVAILABLE_NOW, "orders"))
    return dropped_rows(spark, f"{at}/progress")


def q_dwd_rejects(spark, d):
    """Rows that the typed extract reads, keeps whole and rejects; one order in ten has a text for its
    money, and one in ten a text for its time."""
    from tidemark.operators.keyed import ORDER_FIELDS, to_keyed
    from tidemark.session import scratch_path
    from tidemark.streaming import jobs as sj
    rows, last = fx.orders_text(spark, d), F.substring("orderId", -1, 1)
    bad = rows.withColumns({"realTotalMoney": F.when(last == "3", "n/a").otherwise(F.col("realTotalMoney")),
                            "createTime": F.when(last == "7", "soon").otherwise(F.col("createTime"))})
    kv = to_keyed(bad, F.col("rowkey"), "cf", list(ORDER_FIELDS))
    counts = sj.run_dwd_extract(kv, scratch_path(spark, "dwd"), all_hours=True)
    return spark.createDataFrame([tuple(counts[c] for c in ("read", "kept", "rejected"))],
                                 "rows_read long, rows_kept long, rows_rejected long")


def _customers_and_suppliers(spark, d, n):
    """Changelog of customer and supplier rows, ``n`` slices in offset order."""
    parts = []
    for table, key, name, add in (("customer", "c_custkey", "c_name", 0), ("supplier", "s_suppkey", "s_name", 1)):
        row = F.create_map(F.lit(key), F.col(key).cast("string"), F.lit(name), F.col(name))
        parts.append(fx.table(spark, d, table).select(
            F.pmod(F.col(key), F.lit(n)).cast("int").alias("part"), (F.col(key) * 2 + add).alias("at"),
            F.to_json(F.struct(F.lit("test").alias("database"), F.lit(table).alias("table"), F.lit("INSERT").alias("type"),
                               F.array(row).alias("data"))).alias("value")))
    both = parts[0].unionByName(parts[1])
    return both.select(F.lit(0).alias("partition"), (F.col("part") * fx.PHASE_STRIDE + F.col("at")).alias("offset"),
                       "value", "part")


def q_stream_cdc_config_change(spark, d):
    """The routing config changes while the CDC sync runs: after the first of three slices the
    customer flow disappears, which leaves it in force, and the supplier flow appears."""
    from tidemark.sinks.keyed_state import KeyedStateTable
    from tidemark.streaming.cdc_apply import start_cdc_sync
    from tidemark.streaming.replay import AVAILABLE_NOW, Replay
    customer = (1, 1, "test", "customer", "dwd:customer", "cf", False, 10, "c_custkey", 2)
    supplier = (2, 1, "test", "supplier", "dwd:supplier", "cf", True, 10, "s_suppkey", 2)
    polls = []

    def poll():
        polls.append(1)
        return spark.createDataFrame([customer if len(polls) == 1 else supplier], fx.FLOW_SCHEMA)

    log = _customers_and_suppliers(spark, d, 3)
    replay = Replay(log.drop("part"), F.floor(F.col("offset") / fx.PHASE_STRIDE), 3)
    at = replay.root
    replay.run(lambda stream: start_cdc_sync(spark, stream, poll, f"{at}/table", f"{at}/ckpt", AVAILABLE_NOW,
                                             poll_seconds=0.0))
    cells = KeyedStateTable(spark, f"{at}/table").cells()
    return cells.select("hbaseTable", "rowkey", "family", "qualifier", "value")


def q_stream_latest_start(spark, d):
    """A job that starts at the end of a file topic: of the behaviour log only the odd events, which come later."""
    from tidemark import schemas
    from tidemark.session import scratch_path
    from tidemark.sinks.topic import append_topic
    from tidemark.sources.topic import json_topic
    from tidemark.streaming.replay import AVAILABLE_NOW, wait
    at = scratch_path(spark, "latest")
    log = fx.behavior(spark, d, keep=["event_id"]).withColumn("ts", F.col("ts").cast("timestamp"))
    for odd in (0, 1):
        append_topic(log.filter(F.col("event_id") % 2 == odd).drop("event_id"), f"{at}/log")
        stream = json_topic(spark, f"{at}/log", schemas.USER_BEHAVIOR, starting="latest", checkpoint=f"{at}/ckpt")
        wait(append_topic(stream, f"{at}/out", f"{at}/ckpt", AVAILABLE_NOW))
    out = json_topic(spark, f"{at}/out", schemas.USER_BEHAVIOR, streaming=False)
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def q_adhoc_ddl(spark, d):
    """Tables opened by DDL alone: a source table, and a keyed table that a job wrote, folded by its key."""
    from tidemark.session import scratch_path
    from tidemark.sql import run_script
    from tidemark.streaming import jobs as sj
    at = scratch_path(spark, "ddl")
    sj.run_user_totals(fx.orders_kv(spark, d), at)
    return run_script(spark, f"""
      CREATE OR REPLACE TEMPORARY VIEW ddl_customer USING parquet OPTIONS (path '{d}/customer.parquet');
      CREATE OR REPLACE TEMPORARY VIEW ddl_user_rows
        (rowkey STRING, cf STRUCT<user_id: STRING, order_num: BIGINT, gmv: DOUBLE>, buckets BIGINT, bucket BIGINT, batch BIGINT)
        USING parquet OPTIONS (path '{at}/rows');
      CREATE OR REPLACE TEMPORARY VIEW ddl_user_orders AS
        SELECT rowkey, max_by(cf, batch) AS cf FROM ddl_user_rows GROUP BY rowkey;
      SELECT c_mktsegment AS segment, count(*) AS customers, sum(cf.order_num) AS orders_placed, round(sum(cf.gmv), 2) AS gmv
      FROM ddl_user_orders JOIN ddl_customer ON CAST(rowkey AS BIGINT) = c_custkey GROUP BY c_mktsegment""")


def q_insert_into_topic(spark, d):
    """A topic declared by DDL, filled by two ``INSERT INTO .. SELECT`` statements and read back, in SQL alone."""
    from tidemark.session import scratch_path
    from tidemark.sinks.files import ensure_dir
    from tidemark.sql import run_script
    at = scratch_path(spark, "inserted")
    ensure_dir(spark, at)
    return run_script(spark, f"""
      CREATE OR REPLACE TEMPORARY VIEW ins_events USING parquet OPTIONS (path '{d}/events.parquet');
      CREATE OR REPLACE TEMPORARY VIEW ins_topic (user_id BIGINT, kind STRING, amount DOUBLE, at TIMESTAMP)
        USING json OPTIONS (path '{at}', timestampFormat "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX");
      INSERT INTO ins_topic SELECT user_id, event_type, value, CAST(ts AS TIMESTAMP) FROM ins_events
        WHERE event_type = 'purchase';
      INSERT INTO ins_topic SELECT user_id, event_type, value, CAST(ts AS TIMESTAMP) FROM ins_events
        WHERE event_type <> 'purchase' AND value > 50;
      SELECT user_id, kind, count(*) AS n, round(sum(amount), 2) AS amount, CAST(max(at) AS TIMESTAMP_NTZ) AS latest
      FROM ins_topic GROUP BY user_id, kind""")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "orders_per_hour": q_orders_per_hour,
    "orders_per_minute": q_orders_per_minute,
    "user_province_hour_windows": q_user_province_hour_windows,
    "user_province_hour_app": q_user_province_hour_app,
    "uv_10min": q_uv_10min,
    "category_enriched": q_category_enriched,
    "category_counts": q_category_counts,
    "dwd_orders_cast": q_dwd_orders_cast,
    "dwd_current_hour": q_dwd_current_hour,
    "user_orders": q_user_orders,
    "user_province_orders": q_user_province_orders,
    "user_orders_md5": q_user_orders_md5,
    "item_counts_upsert": q_item_counts_upsert,
    "user_top1": q_user_top1,
    "salted_row_key": q_salted_row_key,
    "cdc_routed": q_cdc_routed,
    "cdc_cells": q_cdc_cells,
    "cdc_state": q_cdc_state,
    "cdc_user_orders": q_cdc_user_orders,
    "adhoc_sql": q_adhoc_sql,
    "stream_orders_per_hour": q_stream_orders_per_hour,
    "stream_uv_10min": q_stream_uv_10min,
    "stream_category_counts": q_stream_category_counts,
    "stream_cdc_state": q_stream_cdc_state,
    "stream_user_province_hour_app": q_stream_user_province_hour_app,
    "stream_user_orders": q_stream_user_orders,
    "stream_item_counts_upsert": q_stream_item_counts_upsert,
    "stream_user_top1": q_stream_user_top1,
    "stream_topic_select": q_stream_topic_select,
    "stream_orders_per_minute": q_stream_orders_per_minute,
    "stream_late_rows": q_stream_late_rows,
    "stream_category_refreshed": q_stream_category_refreshed,
    "stream_item_counts_late": q_stream_item_counts_late,
    "stream_cdc_user_orders": q_stream_cdc_user_orders,
    "stream_cdc_dwd_current_hour": q_stream_cdc_dwd_current_hour,
    "stream_cdc_sql": q_stream_cdc_sql,
    "stream_dropped_rows": q_stream_dropped_rows,
    "dwd_rejects": q_dwd_rejects,
    "stream_cdc_config_change": q_stream_cdc_config_change,
    "stream_latest_start": q_stream_latest_start,
    "adhoc_ddl": q_adhoc_ddl,
    "insert_into_topic": q_insert_into_topic,
}
