"""Streaming jobs: source stream -> DWS topic -> APP upsert table.

Each job is two ``StreamingQuery`` objects joined by the DWS path, the way
the source jobs wrote a topic and read it back:

* DWS: the windowed plan from ``plans.jobs`` in append mode (each window is
  emitted once, after the watermark passes its end) into a JSON topic; an
  un-windowed plan runs in update mode and appends each batch's changed rows
  through ``foreachBatch``.
* APP: the DWS topic read back as a stream, compacted with ``max`` per key
  in update mode, upserted into a versioned snapshot.

``streaming.progress.supervise`` runs them together: if one fails, all start again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans import jobs
from tidemark.operators.keyed import current_hour, dwd_orders, failed_cast
from tidemark.operators.lookup import purchases_by_key, purchases_by_parent
from tidemark.sinks.bucketed import BATCH
from tidemark.sinks.files import ensure_dir
from tidemark.sinks.topic import append_topic
from tidemark.sinks.upsert import UpsertTable, upsert_table
from tidemark.sources.tables import KeyedLookup
from tidemark.sources.topic import json_topic
from tidemark.streaming.event_time import with_event_time

DEFAULT_TRIGGER = {"processingTime": "5 seconds"}


@dataclass(frozen=True)
class WindowJob:
    """A windowed DWS plan and its APP compaction."""
    time_col: str
    dws: Callable[[DataFrame], DataFrame]
    dws_schema: str
    app: Callable[[DataFrame], DataFrame]
    app_keys: Sequence[str]


ORDERS_PER_HOUR = WindowJob("createTime", jobs.orders_per_hour,
                            "day_hour_time string, order_num bigint",
                            jobs.orders_per_hour_app, ["day_hour_time"])
ORDERS_PER_MINUTE = WindowJob("createTime", jobs.orders_per_minute,
                              "day_time_str string, order_num bigint",
                              jobs.orders_per_minute_app, ["day_time_str"])
USER_PROVINCE_HOUR = WindowJob("createTime", jobs.user_province_hour,
                               "userId bigint, province string, hour_of_day bigint, order_num bigint, gmv double",
                               jobs.user_province_hour_app, ["userId", "province", "hour_of_day"])
UV_10MIN = WindowJob("ts", jobs.uv_10min, "day_time_str string, uv bigint",
                     jobs.uv_10min_app, ["day_time_str"])


def start_dws(job: WindowJob, source: DataFrame, dws_path: str, checkpoint_dir: str,
              trigger: dict | None = None, name: str = "job") -> StreamingQuery:
    """The DWS query of a windowed job: closed windows appended to the DWS topic."""
    dws = job.dws(with_event_time(source, job.time_col))
    return append_topic(dws, dws_path, f"{checkpoint_dir}/dws", trigger or DEFAULT_TRIGGER, f"{name}_dws")


def start_window_job(spark: SparkSession, job: WindowJob, source: DataFrame, dws_path: str,
                     app_path: str, checkpoint_dir: str, trigger: dict | None = None,
                     name: str = "job") -> list[StreamingQuery]:
    return [start_dws(job, source, dws_path, checkpoint_dir, trigger, name),
            start_app(spark, dws_path, job.dws_schema, job.app, job.app_keys, app_path,
                      f"{checkpoint_dir}/app", trigger, name)]


def start_app(spark: SparkSession, dws_path: str, dws_schema: str,
              app: Callable[[DataFrame], DataFrame], keys: Sequence[str], app_path: str,
              checkpoint: str, trigger: dict | None = None, name: str = "job",
              recursive: bool = False) -> StreamingQuery:
    """Read a DWS topic back and upsert its ``max`` compaction."""
    ensure_dir(spark, dws_path)
    dws = json_topic(spark, dws_path, dws_schema, recursive=recursive)
    return upsert_table(app(dws), keys, app_path, checkpoint, "update",
                        trigger or DEFAULT_TRIGGER, f"{name}_app")


def start_window_job_kafka(spark: SparkSession, job: WindowJob, source: DataFrame, servers: str, topic: str,
                           app_path: str, checkpoint_dir: str, trigger: dict | None = None,
                           name: str = "job") -> list[StreamingQuery]:
    """The same job with its DWS topic in Kafka (needs the connector; not run in the tests)."""
    from tidemark.sinks.topic import kafka_append
    from tidemark.sources.topic import kafka_topic
    trigger = trigger or DEFAULT_TRIGGER
    dws = job.dws(with_event_time(source, job.time_col))
    back = kafka_topic(spark, servers, topic, job.dws_schema, starting="earliest").drop("partition", "offset")
    return [kafka_append(dws, servers, topic, f"{checkpoint_dir}/dws", trigger),
            upsert_table(job.app(back), job.app_keys, app_path, f"{checkpoint_dir}/app", "update", trigger,
                         f"{name}_app")]


CATEGORY_DWS = "category_name string, order_num bigint"


def start_category_dws(behavior: DataFrame, dim_loader: Callable[[], DataFrame], dws_path: str,
                       checkpoint_dir: str, max_age_s: float = 600.0, trigger: dict | None = None,
                       name: str = "category") -> StreamingQuery:
    """Purchases per parent category.  Each micro-batch is counted by category id, and the
    ids not known yet are looked up in the dimension; what was found is kept
    for ``max_age_s`` (a lookup cache of 5,000 keys and 10 minutes).

    Each micro-batch's counts are added to those of the batches before, upserted
    into a running table, and appended to the DWS topic.  A replayed batch overwrites
    its own files in both places.
    """
    dim = KeyedLookup(dim_loader, "sub_category_id", max_age_s=max_age_s)

    def write(batch: DataFrame, batch_id: int) -> None:
        counts = purchases_by_key(batch).persist()  # a row for each category id
        totals = purchases_by_parent(counts, dim.rows_for(counts.select("category_id")))
        table = UpsertTable(batch.sparkSession, f"{checkpoint_dir}/counts", ["category_name"])
        if table.schema is not None:
            before = table.current(upto=batch_id - 1).withColumnRenamed("order_num", "before")
            same = F.col("category_name").eqNullSafe(F.col("known"))
            totals = totals.join(before.withColumnRenamed("category_name", "known"), same, "left").select(
                "category_name", (F.col("order_num") + F.coalesce("before", F.lit(0))).alias("order_num"))
        table.apply(totals, batch_id)
        table.stored().filter(F.col(BATCH) == batch_id).select(*table.schema.names) \
            .write.mode("overwrite").json(f"{dws_path}/batch={batch_id:012d}")
        counts.unpersist()

    return (behavior.writeStream.foreachBatch(write).option("checkpointLocation", f"{checkpoint_dir}/dws")
            .queryName(f"{name}_dws").trigger(**(trigger or DEFAULT_TRIGGER)).start())


def start_category_app(spark: SparkSession, dws_path: str, app_path: str, checkpoint_dir: str,
                       trigger: dict | None = None, name: str = "category") -> StreamingQuery:
    return start_app(spark, dws_path, CATEGORY_DWS, jobs.category_counts_app, ["category_name"], app_path,
                     f"{checkpoint_dir}/app", trigger, name, recursive=True)


def start_category_job(spark: SparkSession, behavior: DataFrame, dim_loader: Callable[[], DataFrame],
                       dws_path: str, app_path: str, checkpoint_dir: str, max_age_s: float = 600.0,
                       trigger: dict | None = None, name: str = "category") -> list[StreamingQuery]:
    return [start_category_dws(behavior, dim_loader, dws_path, checkpoint_dir, max_age_s, trigger, name),
            start_category_app(spark, dws_path, app_path, checkpoint_dir, trigger, name)]


def start_item_counts(spark: SparkSession, behavior: DataFrame, table_path: str, checkpoint: str,
                      trigger: dict | None = None, name: str = "item_counts") -> StreamingQuery:
    """Counts per (item, category, behaviour, ts) upserted into a table keyed
    by item: the latest ``ts`` wins, then category, then behaviour, then the
    larger count of the same group.

    Every row counts, however late: there is no watermark, so the state grows
    with the distinct groups, as the source's un-windowed aggregate does."""
    from tidemark.operators.aggregates import item_counts
    from tidemark.sinks.upsert import upsert_batch

    counts = item_counts(behavior)

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_batch(batch.sparkSession, batch, batch_id, ["item_id"], table_path,
                     rule="greatest", order=["ts", "category_id", "behavior", "cnt"])

    return (counts.writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", checkpoint).queryName(name)
            .trigger(**(trigger or DEFAULT_TRIGGER)).start())


def start_user_top1(spark: SparkSession, dws: DataFrame, table_path: str, checkpoint: str,
                    trigger: dict | None = None, name: str = "user_top1") -> StreamingQuery:
    """Best row per user by (order_num, gmv) over a DWS stream: ranking
    windows are rejected on streams, the ``max(struct)`` aggregate is not."""
    from tidemark.operators.compact import top1_desc
    return upsert_table(top1_desc(dws, ["userId"], ["order_num", "gmv"]), ["userId"], table_path,
                        checkpoint, "update", trigger or DEFAULT_TRIGGER, name)


def run_dwd_extract(kv: DataFrame, topic_path: str, now=None, all_hours: bool = False) -> dict[str, int]:
    """Bounded scan of the keyed order table: the current UTC+8 hour's rows (or all),
    typed, appended to the DWD topic (event time as TIMESTAMP for watermarks).

    A row with a text that is not of its field's type is written with a null there
    and counted as a reject.  Returns the rows ``read``, ``kept`` whole and ``rejected``,
    counted in the one pass of the write.
    """
    rows, seen = jobs.order_text(kv), Observation()
    rows = rows if all_hours else current_hour(rows, "createTime", now)
    counted = rows.observe(seen, F.count(F.lit(1)).alias("read"), F.count_if(failed_cast()).alias("rejected"))
    append_topic(dwd_orders(counted, "timestamp"), topic_path)
    found = seen.get
    return {"read": found["read"], "kept": found["read"] - found["rejected"], "rejected": found["rejected"]}


def run_user_totals(kv: DataFrame, table_path: str) -> None:
    """Per-user order count and GMV of the keyed order table, upserted into
    the keyed DWS table (``rowkey = userId``, ``cf = ROW(user_id, order_num, gmv)``)."""
    from tidemark.operators.aggregates import user_totals_keyed
    upsert_table(user_totals_keyed(jobs.order_text(kv)), ["rowkey"], table_path, checkpoint="")


def start_user_totals_stream(spark: SparkSession, orders: DataFrame, table_path: str,
                             checkpoint: str, trigger: dict | None = None,
                             name: str = "user_totals") -> StreamingQuery:
    """Un-windowed per-user ``count(distinct orderId)`` and ``sum(money)`` on a stream.

    One query with one stateful aggregate: the money so far of each (user,
    order).  Its state is one entry per pair, spread over all tasks, so a hot
    user's history never stands in one state row.  The changed pairs are
    upserted into one table; ``read_user_totals`` counts and sums them, so a
    user's count and sum always come from the same batches.
    """
    pairs = orders.groupBy("userId", "orderId").agg(F.sum(F.col("realTotalMoney").try_cast("double")).alias("money"))
    return upsert_table(pairs, ["userId", "orderId"], table_path, checkpoint, "update", trigger or DEFAULT_TRIGGER, name)


def read_user_totals(spark: SparkSession, table_path: str, upto: int | None = None) -> DataFrame:
    """``userId, order_num, gmv`` from the table of ``start_user_totals_stream`` (as of batch ``upto``)."""
    pairs = UpsertTable(spark, table_path).current(upto)
    return pairs.groupBy("userId").agg(F.count("orderId").alias("order_num"), F.sum("money").alias("gmv"))
