"""Connected components by alternating large-star and small-star steps.

Each step is a minimum per node and a join back; edges are replaced by edges to
smaller nodes until every node points at the smallest of its component.  The
number of edges never grows beyond the nodes and edges given, and the number of
rounds grows as the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, join_counted


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b``, long, not null, a != b).

    ``root`` is the smallest node of the component.  An empty input gives an
    empty output; repeated edges and both directions of an edge are fine.
    """
    now = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = _state(now)
    while seen[0]:
        both = cut(now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b"))))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"), F.count(F.lit(1)).alias("n"))
        large = cut(join_counted(both, cut(least), ["a"], "n", 2 * seen[0]).filter("b > a")
                    .select(F.col("b").alias("a"), F.col("least").alias("b")).distinct())
        total = large.count()
        least = cut(large.groupBy("a").agg(F.min("b").alias("least"), F.count(F.lit(1)).alias("n")))
        small = join_counted(large, least, ["a"], "n", total).filter("b != least") \
            .select(F.col("b").alias("a"), F.col("least").alias("b"))
        now = cut(small.unionByName(least.select("a", F.col("least").alias("b"))).distinct())
        after = _state(now)
        if after == seen:
            break
        seen = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
