"""One plan per warehouse job.  Each is ``DataFrame -> DataFrame`` and runs
unchanged on a batch table or a streaming source (event time must be a
TIMESTAMP column on a stream; see ``tidemark.streaming``).

Layer names: DWS results are written per window; APP results compact a DWS
topic with ``max`` per key (``compact_max``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.labels import (
    HOUR_LABEL, MINUTE_LABEL, TEN_MINUTE_LABEL, hour_of_day, window_label,
)
from tidemark.operators.compact import compact_max
from tidemark.operators.keyed import current_hour, dwd_orders, expand_family, ORDER_FIELDS
from tidemark.operators.lookup import enrich_category, purchases_by_category
from tidemark.operators.windows import tumbling_distinct


# --- orders per hour / per minute (DWS + APP) -------------------------------

def orders_per_window(orders: DataFrame, duration: str, pattern: str, label: str) -> DataFrame:
    """``label, order_num``: distinct orders per tumbling window of createTime."""
    w = tumbling_distinct(orders, "createTime", duration, "orderId", "order_num")
    return w.select(window_label("window", pattern).alias(label), "order_num")


def orders_per_hour(orders: DataFrame) -> DataFrame:
    return orders_per_window(orders, "1 hour", HOUR_LABEL, "day_hour_time")


def orders_per_hour_app(dws: DataFrame) -> DataFrame:
    return compact_max(dws, ["day_hour_time"], {"buy_cnt": "order_num"})


def orders_per_minute(orders: DataFrame) -> DataFrame:
    return orders_per_window(orders, "1 minute", MINUTE_LABEL, "day_time_str")


def orders_per_minute_app(dws: DataFrame) -> DataFrame:
    app = compact_max(dws, ["day_time_str"], {"buy_cnt": "order_num"})
    return app.select(F.substring("day_time_str", 1, 10).alias("dt"), "day_time_str", "buy_cnt")


# --- orders and GMV per user, province, hour --------------------------------

def user_province_hour(orders: DataFrame) -> DataFrame:
    """``userId, province, hour_of_day, order_num, gmv`` per hourly window."""
    w = tumbling_distinct(orders, "createTime", "1 hour", "orderId", "order_num",
                          keys=["userId", "province"],
                          sums={"gmv": F.col("realTotalMoney").cast("double")})
    return w.select("userId", "province", hour_of_day("window").alias("hour_of_day"),
                    "order_num", "gmv")


def user_province_hour_app(dws: DataFrame) -> DataFrame:
    """Max over days per hour of day: ``max(order_num)`` and ``max(gmv)`` may
    come from different days."""
    return compact_max(dws, ["userId", "province", "hour_of_day"],
                       {"buy_cnt": "order_num", "gmv": "gmv"})


# --- unique visitors per 10 minutes -----------------------------------------

def uv_10min(behavior: DataFrame) -> DataFrame:
    """``day_time_str, uv``: distinct users per 10-minute window, all behaviours."""
    w = tumbling_distinct(behavior, "ts", "10 minutes", "user_id", "uv")
    return w.select(window_label("window", TEN_MINUTE_LABEL).alias("day_time_str"), "uv")


def uv_10min_app(dws: DataFrame) -> DataFrame:
    return compact_max(dws, ["day_time_str"], {"uv": "uv"})


# --- purchases per parent category ------------------------------------------

def category_counts(behavior: DataFrame, dim: DataFrame) -> DataFrame:
    """DWS ``category_name, order_num`` (update stream on a source)."""
    return purchases_by_category(enrich_category(behavior, dim))


def category_counts_app(dws: DataFrame) -> DataFrame:
    return compact_max(dws, ["category_name"], {"buy_cnt": "order_num"})


# --- keyed order table ------------------------------------------------------

def order_text(kv: DataFrame) -> DataFrame:
    """``rowkey`` + the order family's text fields, names canonical."""
    return expand_family(kv, "cf", list(ORDER_FIELDS))


def dwd_current_hour(kv: DataFrame, now=None, time_type: str = "timestamp_ntz") -> DataFrame:
    """DWD extract: rows of the current UTC+8 hour, typed."""
    return dwd_orders(current_hour(order_text(kv), "createTime", now), time_type)
