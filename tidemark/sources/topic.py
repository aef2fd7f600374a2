"""Append streams of JSON records.

``kafka_topic`` is the production adapter (``readStream.format("kafka")``);
the Kafka connector is not part of this image, so tests use ``json_topic``,
its file double: a directory of JSON-lines files read with a declared schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sinks.files import newest_file, read_text, write_text


def parse_json(raw: DataFrame, schema: StructType | str, value_col: str = "value") -> DataFrame:
    """``from_json(value)`` into columns, parsed once per record (through a
    generator, so referenced fields do not each re-parse the text)."""
    keep = [c for c in raw.columns if c != value_col]
    return raw.select(*keep, F.inline_outer(F.array(F.from_json(F.col(value_col).cast("string"), schema))))


def started_at(spark: SparkSession, path: str, checkpoint: str) -> int:
    """The point after which a job reads a file topic: the newest file's time (ms) when the job was first started.

    Kept beside the job's checkpoint, so a restart goes on from the same point.
    """
    kept = read_text(spark, f"{checkpoint}/starting_after")
    if kept is None:
        kept = str(newest_file(spark, path))
        write_text(spark, f"{checkpoint}/starting_after", kept)
    return int(kept)


def json_topic(spark: SparkSession, path: str, schema: StructType | str, streaming: bool = True,
               starting: str = "earliest", max_files_per_trigger: int | None = None,
               recursive: bool = False, checkpoint: str | None = None,
               max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Read a JSON-lines directory as a topic (batch or stream).

    ``starting="latest"`` leaves out the files that are there when the job with this
    ``checkpoint`` first starts, by their time (files of the same millisecond as the
    newest of them count as there); the filter is on file metadata, so
    they are listed but not read.
    """
    if starting not in ("earliest", "latest"):
        raise ValueError(f"unknown start {starting!r}")
    if not streaming:
        r = spark.read.schema(schema)
        return (r.option("recursiveFileLookup", "true") if recursive else r).json(path)
    reader = spark.readStream.schema(schema)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    rows = reader.json(path)
    if starting == "latest":
        if checkpoint is None:
            raise ValueError("a latest start needs the job's checkpoint, where it is kept")
        after = F.timestamp_millis(F.lit(started_at(spark, path, checkpoint)))
        rows = rows.filter(F.col("_metadata.file_modification_time") > after)
    return rows


def kafka_options(servers: str, topic: str, starting: str = "latest", group_id: str | None = None,
                  max_offsets_per_trigger: int | None = None, min_offsets_per_trigger: int | None = None,
                  max_trigger_delay: str | None = None) -> dict[str, str]:
    """Reader options: servers, topic, start without a checkpoint, group and batch bounds.

    A batch waits for ``min_offsets_per_trigger`` records, but no longer than ``max_trigger_delay``."""
    out = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if group_id:
        out["kafka.group.id"] = group_id
    if max_offsets_per_trigger:
        out["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_offsets_per_trigger:
        out["minOffsetsPerTrigger"] = str(min_offsets_per_trigger)
    if max_trigger_delay:
        out["maxTriggerDelay"] = max_trigger_delay
    return out


def kafka_records(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """``partition, offset, value`` of a Kafka topic; new partitions are found on every trigger."""
    raw = spark.readStream.format("kafka").options(**kafka_options(servers, topic, **options)).load()
    return raw.select("partition", "offset", F.col("value").cast("string").alias("value"))


def kafka_topic(spark: SparkSession, servers: str, topic: str, schema: StructType | str, **options) -> DataFrame:
    """Kafka topic of JSON values, parsed with ``schema``.

    Keeps ``partition`` and ``offset`` so changelog consumers can order events.
    """
    return parse_json(kafka_records(spark, servers, topic, **options), schema)
