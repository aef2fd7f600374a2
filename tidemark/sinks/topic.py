"""Append sinks: a topic of JSON records (file double, or Kafka)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


# Timestamps keep their microseconds in the JSON text (Spark's default JSON
# format stops at milliseconds).
TIME_FORMATS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def append_topic(df: DataFrame, path: str, checkpoint: str | None = None,
                 trigger: dict | None = None, query_name: str | None = None) -> StreamingQuery | None:
    """Append every row as a JSON record.

    Streaming: ``writeStream.format("json")`` in append mode (the file sink
    is exactly-once through its own commit log).  Batch: append files.
    """
    if not df.isStreaming:
        df.write.mode("append").options(**TIME_FORMATS).json(path)
        return None
    w = (df.writeStream.format("json").outputMode("append").options(**TIME_FORMATS)
         .option("path", path).option("checkpointLocation", checkpoint))
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"processingTime": "5 seconds"}))
    return w.start()


def kafka_append(df: DataFrame, servers: str, topic: str, checkpoint: str,
                 trigger: dict | None = None) -> StreamingQuery:
    """``to_json(struct(*))`` into a Kafka topic (needs the Kafka connector)."""
    out = df.select(F.to_json(F.struct(*df.columns), TIME_FORMATS).alias("value"))
    return (out.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", topic).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "5 seconds"})).start())


def print_rows(df: DataFrame, trigger: dict | None = None) -> StreamingQuery | None:
    """Print every row: as they are read for a batch, the console sink for a stream."""
    if not df.isStreaming:
        for row in df.toLocalIterator():
            print(row)
        return None
    return (df.writeStream.format("console").option("truncate", "false").option("numRows", str(2**31 - 1))
            .outputMode("append" if not _aggregating(df) else "update")
            .trigger(**(trigger or {"processingTime": "5 seconds"})).start())


def _aggregating(df: DataFrame) -> bool:
    return "Aggregate" in df._jdf.queryExecution().analyzed().toString()
