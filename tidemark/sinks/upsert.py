"""Upsert sink: one row per key in a bucketed table (see ``sinks.bucketed``).

The combine rules are per-key aggregates that combine on the map side and may
fold a row again without changing the result, so a replayed batch gives the same table:

* ``latest``: the row of the greatest batch id wins (plain upsert);
* ``greatest``: the row with the greatest ``order`` tuple wins, whatever the arrival order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.sinks.bucketed import BATCH, BucketedTable


def combine(df: DataFrame, keys: Sequence[str], rule: str = "latest",
            order: Sequence[str] = ()) -> DataFrame:
    """Fold rows (with a ``batch`` column) to one row per key."""
    rest = [c for c in df.columns if c not in keys and c != BATCH]
    if rule == "greatest":
        best = F.max_by(F.struct(BATCH, *rest), F.struct(*order, BATCH))
    elif rule == "latest":
        best = F.max(F.struct(BATCH, *rest))
    else:
        raise ValueError(f"unknown combine rule {rule!r}")
    return df.groupBy(*keys).agg(best.alias("_r")).select(*keys, "_r.*")


class UpsertTable(BucketedTable):
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] | None = None,
                 rule: str = "latest", order: Sequence[str] = (), fold_every: int = 10):
        super().__init__(spark, path, keys or (), {"combine": rule, "order": list(order)}, fold_every)
        if not self.keys:
            raise ValueError(f"no upsert table at {self.path}")

    def fold(self, rows: DataFrame) -> DataFrame:
        return combine(rows, self.keys, self.rule["combine"], self.rule["order"])

    def current(self, upto: int | None = None) -> DataFrame:
        return self.state(upto)


def upsert_batch(spark: SparkSession, batch: DataFrame, batch_id: int, keys: Sequence[str],
                 path: str, rule: str = "latest", order: Sequence[str] = (),
                 fold_every: int = 10) -> UpsertTable:
    table = UpsertTable(spark, path, keys, rule, order, fold_every)
    table.apply(batch, batch_id)
    return table


def upsert_table(df: DataFrame, keys: Sequence[str], path: str, checkpoint: str,
                 output_mode: str = "update", trigger: dict | None = None,
                 query_name: str | None = None, rule: str = "latest",
                 order: Sequence[str] = (), fold_every: int = 10) -> StreamingQuery | None:
    """Upsert a stream (``foreachBatch``) or a batch DataFrame into ``path``."""
    if not df.isStreaming:
        table = UpsertTable(df.sparkSession, path, keys, rule, order, fold_every)
        table.apply(df, table.next_batch_id())
        return None

    def write(batch: DataFrame, batch_id: int) -> None:
        UpsertTable(batch.sparkSession, path, keys, rule, order, fold_every).apply(batch, batch_id)

    w = (df.writeStream.outputMode(output_mode).foreachBatch(write)
         .option("checkpointLocation", checkpoint))
    if query_name:
        w = w.queryName(query_name)
    return w.trigger(**(trigger or {"processingTime": "5 seconds"})).start()
