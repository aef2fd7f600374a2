"""Dimension lookup: enrich behaviour events with their parent category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the source job: parents 1..8 keep their name, anything else
# (including an unmatched lookup, whose parent is NULL) is labelled "其他".
KNOWN_PARENT_IDS = (1, 2, 3, 4, 5, 6, 7, 8)
OTHER_CATEGORY = "其他"


def category_name(parent_id: str = "parent_category_id",
                  parent_name: str = "parent_category_name"):
    """The parent's name where it is one of the known parents, else the label for all others."""
    return (F.when(F.col(parent_id).isin(*KNOWN_PARENT_IDS), F.col(parent_name))
            .otherwise(F.lit(OTHER_CATEGORY)))


def enrich_category(behavior: DataFrame, dim: DataFrame) -> DataFrame:
    """Left lookup join on ``category_id = sub_category_id``.

    Output: ``user_id, item_id, behavior, category_name``.  Spark broadcasts
    the dimension if its size in bytes is under the session's threshold (the
    file size at planning, or the measured size at run time), and shuffles
    both sides otherwise.
    """
    d = dim.select("sub_category_id", "parent_category_id", "parent_category_name")
    joined = behavior.join(d, behavior["category_id"] == d["sub_category_id"], "left")
    return joined.select("user_id", "item_id", "behavior", category_name().alias("category_name"))


def purchases_by_category(enriched: DataFrame, behavior_value: str = "buy") -> DataFrame:
    """Number of purchases of each parent category, as ``category_name, order_num``."""
    return (enriched.where(F.col("behavior") == behavior_value)
            .groupBy("category_name").agg(F.count(F.lit(1)).alias("order_num")))


def purchases_by_key(behavior: DataFrame, behavior_value: str = "buy") -> DataFrame:
    """Number of purchases of each category id, as ``category_id, n``: what has to be looked up."""
    return (behavior.where(F.col("behavior") == behavior_value)
            .groupBy("category_id").agg(F.count(F.lit(1)).alias("n")))


def purchases_by_parent(by_key: DataFrame, dim: DataFrame) -> DataFrame:
    """``category_name, order_num`` from the counts by category id: the same as counting enriched rows."""
    d = dim.select("sub_category_id", "parent_category_id", "parent_category_name")
    joined = by_key.join(d, by_key["category_id"] == d["sub_category_id"], "left")
    return joined.groupBy(category_name().alias("category_name")).agg(F.sum("n").alias("order_num"))
