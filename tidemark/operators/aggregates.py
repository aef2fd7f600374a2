"""Un-windowed per-key totals over the order and behaviour tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import full_md5_key
from tidemark.operators.compact import latest_by


def order_totals(orders: DataFrame, keys: Sequence[str],
                 id_col: str = "orderId", money_col: str = "realTotalMoney") -> DataFrame:
    """``count(distinct id) AS order_num, sum(CAST(money AS DOUBLE)) AS gmv`` per key.

    Works on the text (keyed-table) and the typed form alike: money goes
    through ``try_cast`` to DOUBLE, ids are compared as they are.
    """
    return orders.groupBy(*keys).agg(
        F.count_distinct(F.col(id_col)).alias("order_num"),
        F.sum(F.col(money_col).try_cast("double")).alias("gmv"),
    )


def user_totals_keyed(orders_text: DataFrame) -> DataFrame:
    """Per-user totals for the keyed serving table: ``rowkey = userId``,
    family ``cf = ROW(user_id, order_num, gmv)``."""
    t = order_totals(orders_text, ["userId"])
    return t.select(F.col("userId").alias("rowkey"),
                    F.struct(F.col("userId").alias("user_id"), "order_num", "gmv").alias("cf"))


def user_order_counts_md5(orders_text: DataFrame) -> DataFrame:
    """Distinct orders of each user, keyed by the user id behind its whole MD5."""
    t = orders_text.groupBy("userId").agg(F.count_distinct("orderId").alias("order_num"))
    return t.select(full_md5_key("userId").alias("rowkey"),
                    F.struct(F.col("userId").alias("user_id"), "order_num").alias("cf"))


def item_counts(behavior: DataFrame) -> DataFrame:
    """``count(*) AS cnt`` per (item, category, behaviour, ts)."""
    return (behavior.groupBy("item_id", "category_id", "behavior", "ts")
            .agg(F.count(F.lit(1)).alias("cnt")))


def item_counts_upsert(counts: DataFrame) -> DataFrame:
    """Upsert the grouped counts into a table keyed by ``item_id`` alone.

    Several groups share an item; the source let them overwrite each other in
    arrival order.  Here the latest ``ts`` wins, ties broken by the greater
    category, then the greater behaviour: a deterministic choice.
    """
    latest = latest_by(counts, ["item_id"], ["ts", "category_id", "behavior"],
                       ["category_id", "behavior", "ts", "cnt"])
    return latest.select(
        F.col("item_id").cast("string").alias("rowkey"),
        F.struct(F.col("item_id").cast("string").alias("item_id"),
                 F.col("category_id").cast("string").alias("category_id"),
                 "behavior", "ts", "cnt").alias("CF"))
