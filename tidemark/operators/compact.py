"""Compaction of flattened changelog topics into serving tables.

``compact_max`` is the compactor the serving indexes use: ``max(metric)`` per
key.  It equals "latest" only while a metric never falls (counts); for values
that can fall use ``latest_by``.  Both are plain aggregates, so Spark combines
partially on the map side and a hot key never gathers all its rows in a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compact_max(df: DataFrame, keys: Sequence[str | Column],
                metrics: dict[str, str]) -> DataFrame:
    """``SELECT keys, max(in) AS out .. GROUP BY keys`` for ``metrics`` out -> in."""
    return df.groupBy(*keys).agg(*[F.max(src).alias(out) for out, src in metrics.items()])


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str],
              values: Sequence[str]) -> DataFrame:
    """Per key, the ``values`` of the row with the greatest ``order`` tuple."""
    best = F.max_by(F.struct(*values), F.struct(*order)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*")


def top1_desc(df: DataFrame, partition: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``row_number() OVER (PARTITION BY p ORDER BY o1 DESC, o2 DESC ..) = 1``.

    Written as ``max(struct(order.., rest..))``: struct comparison is
    lexicographic with nulls lowest, which is ``DESC NULLS LAST``.  A struct
    buffer makes it a sort aggregate, but unlike a window it combines before
    the shuffle, so a partition key with a third of the rows is not gathered
    in one task.
    The remaining columns break ties, which makes the pick deterministic.
    """
    rest = [c for c in df.columns if c not in partition and c not in order]
    best = F.max(F.struct(*order, *rest)).alias("_best")
    return df.groupBy(*partition).agg(best).select(*partition, "_best.*").select(*df.columns)
