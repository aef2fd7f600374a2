"""A CDC-maintained keyed table: ops of micro-batches in a bucketed table.

The fold (``operators.cdc.fold``) orders ops by ``seq`` (offset, row, kind), so
a replayed or re-delivered batch gives the same state.  Tombstones are kept
only as long as an older op may still be beside them: a fold of batches drops
those that came with the oldest batch of their bucket, whose rows nothing older
can meet any more (offsets of one source table only grow).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import cdc
from tidemark.sinks.bucketed import BATCH, BucketedTable

OPS_COLUMNS = ("hbaseTable", "rowkey", "offset", "pos", "kind", "family", "qualifiers", "values")
CELL_COLUMNS = (*OPS_COLUMNS[:-2], "qualifier", "value")
KIND = "keyed-state"


class KeyedStateTable(BucketedTable):
    def __init__(self, spark: SparkSession, path: str, fold_every: int = 10):
        super().__init__(spark, path, ["hbaseTable", "rowkey"], {"kind": KIND}, fold_every)

    def fold(self, rows: DataFrame) -> DataFrame:
        return cdc.state_as_ops(cdc.fold(rows))

    def forget(self, folded: DataFrame, rows: DataFrame) -> DataFrame:
        # A row key's bucket is found again by its hash; one row a bucket and table.
        last = rows.filter(F.col(BATCH) == F.col("oldest")).groupBy("hbaseTable", "buckets", "bucket") \
            .agg(F.max("offset").alias("last")).groupBy(F.col("hbaseTable").alias("of")).agg(F.min("last").alias("last"))
        gone = (F.col("kind") == cdc.KIND_DELETE) & (F.col("offset") <= F.col("last"))
        return (folded.join(last, F.col("hbaseTable") == F.col("of"), "left")
                .filter(~F.coalesce(gone, F.lit(False))).drop("of", "last"))

    def apply_batch(self, ops: DataFrame, batch_id: int) -> None:
        """Append ops, wide or of one cell each; a table that was begun with cells goes on with them."""
        if self.schema is not None and "qualifiers" not in self.schema.names:
            self.apply((cdc.to_cells(ops) if cdc.is_wide(ops) else ops).select(*CELL_COLUMNS), batch_id)
        else:
            self.apply((ops if cdc.is_wide(ops) else cdc.to_wide(ops)).select(*OPS_COLUMNS), batch_id)

    def rows(self) -> DataFrame:
        """Live cells as they are stored, a row's cells of one change together (``qualifiers, values``)."""
        return cdc.live_cells(self.state())

    def cells(self) -> DataFrame:
        """Live cells: ``hbaseTable, rowkey, family, qualifier, value`` and their place in the log."""
        live = self.rows()
        return cdc.to_cells(live) if cdc.is_wide(live) else live
