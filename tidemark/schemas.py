"""Declared schemas of the warehouse sources and results (DDL strings)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ods.user_behavior as JSON text: ids may arrive quoted, so they are read as
# text and typed with try_cast (a bad value becomes NULL, the row is kept).
USER_BEHAVIOR_TEXT = "user_id string, item_id string, category_id string, behavior string, ts string"
USER_BEHAVIOR = "user_id bigint, item_id bigint, category_id bigint, behavior string, ts timestamp"

# dwd.orders topic (typed extract).
DWD_ORDERS = ("orderId bigint, orderNo string, userId bigint, goodId bigint, goodsMoney double, "
              "realTotalMoney double, payFrom bigint, province string, createTime timestamp")
CATEGORY = "sub_category_id int, parent_category_id int, parent_category_name string"

# A changelog topic record as the file double stores it (Kafka supplies
# partition and offset itself).
CHANGELOG_TOPIC = "partition int, offset bigint, value string"


def typed_behavior(text: DataFrame) -> DataFrame:
    """Text behaviour records to ``USER_BEHAVIOR`` types with ``try_cast``."""
    return text.select(
        F.col("user_id").try_cast("bigint").alias("user_id"),
        F.col("item_id").try_cast("bigint").alias("item_id"),
        F.col("category_id").try_cast("bigint").alias("category_id"),
        F.col("behavior"),
        F.col("ts").try_cast("timestamp").alias("ts"),
    )
