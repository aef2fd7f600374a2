"""Streaming CDC sync: changelog topic -> routed ops -> keyed state table.

``foreachBatch`` routes the batch with the routing config that belongs to it, turns
rows into ops and appends them to a ``KeyedStateTable``.  It reads the batch twice, first to
count and check it, then to write; nothing of it is kept in memory in between.  All events of one configured source table must come from one
topic partition, because offsets order them; one that arrives on two stops the
job.  Events of tables without a running flow are dropped, wherever they arrive.

What a batch read, kept, dropped and rejected is counted in the first pass and
written under ``progress``; records that are no changes, or have no row key, under ``rejects``.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import cdc
from tidemark.sinks.files import delete_path, list_batches, read_text, write_text
from tidemark.sinks.keyed_state import KeyedStateTable
from tidemark.sources.tables import CachedTable

# Fixed setting of the source job: the routing config is polled every 60 s.
CONFIG_POLL_SECONDS = 60.0
PROGRESS = "batch bigint, read bigint, kept bigint, dropped bigint, rejected bigint"


class RoutingState:
    """The routing config in force for each batch, kept beside the checkpoint.

    A batch that is replayed, also after a restart, is routed by the rows it was
    first routed by.  The state is only ever put to: a polled row replaces that of its
    (database, table), and one that is no longer in the config stays in force.
    """

    def __init__(self, spark: SparkSession, path: str, flow: CachedTable):
        self.spark, self.path, self.flow = spark, path, flow

    def _at(self, batch_id: int) -> str:
        return f"{self.path}/batch={batch_id:012d}"

    def config(self, batch_id: int) -> DataFrame:
        known = list_batches(self.spark, self.path)
        if batch_id not in known:
            before = [b for b in known if b < batch_id]
            now = cdc.latest_flow(self.flow.get())
            if before:
                old = self.spark.read.parquet(self._at(before[-1])).select(*now.columns)
                now = now.unionByName(old.join(now, ["databaseName", "tableName"], "left_anti").select(*now.columns))
            now.coalesce(1).write.mode("overwrite").parquet(self._at(batch_id))
            for b in before[:-1]:  # the batch before has finished, so none earlier is ever asked for
                delete_path(self.spark, self._at(b))
        return self.spark.read.parquet(self._at(batch_id))


def check_partitions(table: KeyedStateTable, routed: DataFrame) -> None:
    """Remember the topic partition of each configured source table; fail on a second one."""
    remember_partitions(table, cdc.table_partitions(routed).collect())  # one row a source table


def remember_partitions(table: KeyedStateTable, tables: list[Row]) -> None:
    path = f"{table.path}/_partitions.json"
    known = json.loads(read_text(table.spark, path) or "{}")
    found = dict(known)
    for r in tables:
        name = f"{r['database']}.{r['table']}"
        if r["low"] != r["high"] or found.setdefault(name, r["low"]) != r["low"]:
            raise ValueError(f"changes of {name} arrive on more than one topic partition; their order is unknown")
    if found != known:
        write_text(table.spark, path, json.dumps(found))


def changelog_batch_writer(table: KeyedStateTable, routing: RoutingState) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        flagged = cdc.route_flagged(cdc.parse_flagged(batch), routing.config(batch_id))
        kept = F.col("_state") == "kept"
        # One row a configured source table, and one for each kind of other records.
        stats = flagged.groupBy("_state", F.when(kept, F.col("database")).alias("database"),
                                F.when(kept, F.col("table")).alias("table")) \
            .agg(F.min("partition").alias("low"), F.max("partition").alias("high"), F.count(F.lit(1)).alias("n")).collect()
        remember_partitions(table, [r for r in stats if r["_state"] == "kept"])
        n = {s: sum(r["n"] for r in stats if r["_state"] == s) for s in ("kept", "dropped", "rejected")}
        rejects = flagged.where(F.col("_state") == "rejected").select("partition", "offset", "value")
        if not n["rejected"]:  # the batch need not be read for them
            rejects = table.spark.createDataFrame([], rejects.schema)
        rejects.write.mode("overwrite").parquet(f"{table.path}/rejects/batch={batch_id:012d}")
        table.apply_batch(cdc.to_ops(flagged.where(kept), wide=True), batch_id)
        write_text(table.spark, f"{table.path}/progress/batch={batch_id:012d}.json",
                   json.dumps({"batch": batch_id, "read": sum(n.values()), **n}))
    return write


def cdc_progress(spark: SparkSession, table_path: str) -> DataFrame:
    """Records that each batch read, kept, dropped (no running flow) and rejected."""
    return spark.read.schema(PROGRESS).json(f"{table_path.rstrip('/')}/progress")


def start_cdc_sync(spark: SparkSession, changelog: DataFrame, flow_loader: Callable[[], DataFrame],
                   table_path: str, checkpoint: str, trigger: dict | None = None,
                   fold_every: int = 10, query_name: str = "cdc_sync",
                   poll_seconds: float = CONFIG_POLL_SECONDS) -> StreamingQuery:
    """``changelog`` is a stream with ``partition, offset, value`` (JSON text)."""
    table = KeyedStateTable(spark, table_path, fold_every)
    routing = RoutingState(spark, f"{checkpoint}/routing", CachedTable(flow_loader, poll_seconds))
    return (changelog.writeStream.foreachBatch(changelog_batch_writer(table, routing))
            .option("checkpointLocation", checkpoint).queryName(query_name)
            .trigger(**(trigger or {"processingTime": "5 seconds"})).start())
