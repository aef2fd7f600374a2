"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults every job relies on: UTC wall clock (labels are formatted from
# event time), adaptive execution for runtime coalescing and skew splitting.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Settings for a large cluster (about 100 TB of input, ~1000 executors).
# Shuffle partitions start high and AQE coalesces them to the advisory size,
# so small stages do not run thousands of empty tasks and big ones never
# exceed executor memory; skewed partitions over the threshold are split.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    # Broadcasts stay small: Spark decides on them from sizes, at planning and at run time.
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    # Streaming state in RocksDB so a hot key's state spills to disk rather
    # than living on the JVM heap; commits write a changelog, not a snapshot.
    # Local sessions keep Spark's default in-memory provider: their state is
    # small, and on a local disk each RocksDB commit costs one file sync per
    # state partition per micro-batch (about 1 s each here).
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # One memory budget shared by all RocksDB instances of an executor, so
    # many state partitions on one executor cannot exhaust its memory.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 256 * 1024 * 1024,
                           minimum: int = 200, maximum: int = 100_000) -> int:
    """Initial shuffle partition count for an input size (AQE coalesces down)."""
    return max(minimum, min(maximum, -(-input_bytes // target_bytes)))


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the files under ``paths`` (file-system metadata only)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    return total


def get_session(master: str | None = None, app: str = "tidemark",
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None, cluster: bool = False) -> SparkSession:
    """Build (or reuse) a session with the warehouse defaults applied
    (plus ``CLUSTER_CONF`` when ``cluster``)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    base = {**DEFAULT_CONF, **(CLUSTER_CONF if cluster else {})}
    for key, value in {**base, **(conf or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    # Session-level settings also apply when getOrCreate returned a live session.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a path every executor and the driver can
    reach); a machine-local temporary folder would be lost with the node.
    Only a local-mode session (tests) gets a scratch folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return os.path.join(checkpoint_root(spark), *parts, uuid.uuid4().hex)
