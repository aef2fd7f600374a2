"""Tumbling-window metrics with an exact distinct count.

Batch: ``count_distinct`` inside ``groupBy(window, keys)``.  Catalyst rewrites
it into an aggregate on ``(window, keys, id)`` followed by one on
``(window, keys)``, so a window holding most of the rows is still spread over
all tasks by ``id`` in the first exchange.

Streaming: ``count_distinct`` is rejected on a stream, so the same two levels
are written out: ``groupBy(window, keys, id)`` then ``groupBy(window, keys)``.
Chained aggregations are allowed in append mode, where each window is emitted
once, after the watermark passes its end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tumbling_distinct(df: DataFrame, time_col: str, duration: str,
                      distinct_col: str, count_name: str,
                      keys: Sequence[str] = (),
                      sums: dict[str, str | Column] | None = None) -> DataFrame:
    """Exact ``count(distinct distinct_col)`` and sums per tumbling window.

    Returns ``window`` (struct start/end), ``keys``, ``count_name`` and one
    column per ``sums`` entry (output name -> input column or expression).
    """
    sums = sums or {}
    window = F.window(F.col(time_col), duration).alias("window")
    if not df.isStreaming:
        aggs = [F.count_distinct(F.col(distinct_col)).alias(count_name)]
        aggs += [F.sum(_c(expr)).alias(name) for name, expr in sums.items()]
        return df.groupBy(window, *keys).agg(*aggs)

    inner_aggs = [F.sum(_c(expr)).alias(name) for name, expr in sums.items()]
    if not inner_aggs:
        inner_aggs = [F.count(F.lit(1)).alias("_rows")]
    inner = df.groupBy(window, *keys, F.col(distinct_col)).agg(*inner_aggs)
    outer_aggs = [F.count(F.col(distinct_col)).alias(count_name)]
    outer_aggs += [F.sum(F.col(name)).alias(name) for name in sums]
    return inner.groupBy(F.col("window"), *keys).agg(*outer_aggs)


def _c(expr: str | Column) -> Column:
    return F.col(expr) if isinstance(expr, str) else expr
