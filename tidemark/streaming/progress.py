"""What running queries read and drop, written to a table; queries that stand or fall together."""

from __future__ import annotations

import json
import queue
import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.sinks.files import ensure_dir, write_text

SCHEMA = "query string, run string, batch bigint, input_rows bigint, dropped_rows bigint"


class _Events(StreamingQueryListener):
    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


class ProgressTable(_Events):
    """A listener that keeps a row for each micro-batch: rows read, and rows dropped as later than the watermark.

    ``with ProgressTable(spark, path) as seen: ..`` listens to all queries of
    the session.  A row is one JSON file, so a driver that is lost loses at most the
    batch that was running.  Spark counts dropped rows as the stateful
    operators see them, behind the partial aggregation of each task.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.over: dict[str, threading.Event] = {}
        ensure_dir(spark, path)

    def __enter__(self) -> ProgressTable:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error) -> None:
        self.spark.streams.removeListener(self)

    def _ended(self, run: str) -> threading.Event:
        return self.over.setdefault(run, threading.Event())

    def onQueryProgress(self, event):
        p = event.progress
        dropped = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        if p.numInputRows or dropped:
            write_text(self.spark, f"{self.path}/{p.runId}-{p.batchId:012d}.json", json.dumps({
                "query": p.name, "run": str(p.runId), "batch": p.batchId, "input_rows": p.numInputRows,
                "dropped_rows": dropped}))

    def onQueryTerminated(self, event):
        self._ended(str(event.runId)).set()

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Wait until the query has ended and all of its progress has been written."""
        query.awaitTermination()
        if not self._ended(str(query.runId)).wait(seconds):
            raise TimeoutError(f"no end of query {query.name} was reported")


def progress(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a :class:`ProgressTable`."""
    return spark.read.schema(SCHEMA).json(path)


def dropped_rows(spark: SparkSession, path: str) -> DataFrame:
    """``query, dropped_rows``: rows that each query has dropped as late so far."""
    return progress(spark, path).groupBy("query").agg(F.sum("dropped_rows").alias("dropped_rows"))


class _Ended(_Events):
    def __init__(self, found: queue.SimpleQueue):
        self.found = found

    def onQueryTerminated(self, event):
        self.found.put((str(event.runId), event.exception))


def supervise(spark: SparkSession, start: Callable[[], list[StreamingQuery]], restarts: int = 3,
              pause_s: float = 1.0) -> int:
    """Run the queries that ``start`` starts until all have ended; returns how often they were started again.

    If one fails the others are stopped, and all are started again from their
    checkpoints, so no insert of a job runs on without its siblings.  After
    ``restarts`` such failures the last one is raised.
    """
    found: queue.SimpleQueue = queue.SimpleQueue()
    listener = _Ended(found)
    spark.streams.addListener(listener)
    try:
        for again in range(restarts + 1):
            others, running, error = {str(q.runId) for q in spark.streams.active}, {}, None
            try:
                running = {str(q.runId): q for q in start()}
                while running and error is None:
                    run, error = found.get()
                    if running.pop(run, None) is None:
                        error = None  # not ours
            except Exception as e:  # a query that does not even start
                error = str(e)
                running = {str(q.runId): q for q in spark.streams.active if str(q.runId) not in others}
            if error is None:
                return again
            for q in running.values():
                q.stop()
            if again < restarts:
                time.sleep(pause_s)
        raise RuntimeError(f"stopped after {restarts} restarts: {error}")
    finally:
        spark.streams.removeListener(listener)
