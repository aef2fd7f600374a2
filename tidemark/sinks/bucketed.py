"""A keyed table as plain Parquet, partitioned by bucket and batch, folded by key when read.

Every micro-batch writes its rows to ``rows/buckets=<of>/bucket=<b>/batch=<n>``
by dynamic partition overwrite; a replayed batch replaces its own rows and
nothing else.  The table is what a per-key aggregation makes of all rows; the
aggregations of ``upsert`` and ``keyed_state`` give the same result however often rows
that they have folded are folded again.  ``fold_batches`` uses that: it writes the
folded rows of the buckets that got rows to the newest finished batch's partition,
then deletes the partitions it read.  A crash in between costs nothing but space.

Writes are spread by (bucket, hash of the key), so their parallelism follows
the rows, not the number of buckets.  A table starts with one bucket; once a
bucket holds more than ``BUCKET_BYTES`` the next fold deals the whole table out
into more.  ``_table.json`` beside the rows holds schema, keys and the rule of the fold.

A reader lists the files when it plans.  One that is still reading while a fold
deletes what it read has to start again.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.session import input_bytes
from tidemark.sinks.files import delete_path, glob_dirs, read_text, write_text

BATCH = "batch"
PARTS = ("buckets", "bucket", BATCH)
#: Size from which a bucket is split, and into how many ranges of key hashes its rows are dealt for a write: at
#: least SLICES, and PIECES in all buckets, as a first batch may be large. Spark joins small ones to one task.
BUCKET_BYTES, SLICES, PIECES = 1 << 30, 32, 1024


class BucketedTable:
    """Rows of a keyed table; subclasses give the fold."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = (), rule: dict | None = None,
                 fold_every: int = 10):
        self.spark, self.path, self.fold_every = spark, path.rstrip("/"), fold_every
        self.keys, self.rule, self.schema = list(keys), rule or {}, None
        meta = read_text(spark, f"{self.path}/_table.json")
        if meta is not None:
            known = json.loads(meta)
            self.keys, self.rule = known["keys"], known["rule"]
            self.schema: StructType | None = StructType.fromJson(known["schema"])

    @staticmethod
    def exists(spark: SparkSession, path: str) -> bool:
        return read_text(spark, f"{path.rstrip('/')}/_table.json") is not None

    def fold(self, rows: DataFrame) -> DataFrame:
        """One state for each key from rows with their ``batch``; the batch column stays."""
        raise NotImplementedError

    def forget(self, folded: DataFrame, rows: DataFrame) -> DataFrame:
        """``folded`` without what no later row can need; ``rows`` has ``bucket`` and the bucket's ``oldest`` batch."""
        return folded

    # -- partitions ----------------------------------------------------------
    def partitions(self) -> list[tuple[int, int, int]]:
        """``(buckets, bucket, batch)`` of every partition there is."""
        names = glob_dirs(self.spark, f"{self.path}/rows/buckets=*/bucket=*/batch=*")
        return sorted(tuple(int(part.split("=")[1]) for part in name.split("/")[-3:]) for name in names)

    def next_batch_id(self) -> int:
        return max((p[2] for p in self.partitions()), default=-1) + 1

    def stored(self) -> DataFrame:
        """All rows as they were written, with their ``buckets``, ``bucket`` and ``batch``."""
        if self.schema is None:
            raise ValueError(f"no table at {self.path}")
        schema = StructType([*self.schema, *[StructField(p, LongType()) for p in PARTS]])
        if not self.partitions():
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/rows")

    # -- writes --------------------------------------------------------------
    def _spread(self, rows: DataFrame, buckets: int) -> DataFrame:
        """Rows with their partition columns, dealt to tasks by bucket and slice of the key hashes."""
        key = F.xxhash64(*self.keys)
        piece: Column = F.pmod(F.shiftright(key, 32), F.lit(max(SLICES, PIECES // buckets)))
        return rows.withColumns({"buckets": F.lit(buckets).cast("long"), "bucket": F.pmod(key, F.lit(buckets))}) \
            .repartition(F.col("bucket"), piece)

    def _write(self, rows: DataFrame) -> None:
        (rows.select(*self.schema.names, *PARTS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*PARTS).parquet(f"{self.path}/rows"))

    def _drop(self, partitions: list[tuple[int, int, int]]) -> None:
        for p in partitions:
            delete_path(self.spark, f"{self.path}/rows/" + "/".join(f"{n}={v}" for n, v in zip(PARTS, p, strict=True)))

    def append(self, rows: DataFrame, batch_id: int) -> None:
        """Write micro-batch ``batch_id``; writing it again replaces it."""
        if self.schema is None:
            self.schema = StructType.fromJson(json.loads(rows.schema.json()))
            for field in self.schema:
                field.nullable = True
            write_text(self.spark, f"{self.path}/_table.json", json.dumps(
                {"schema": json.loads(self.schema.json()), "keys": self.keys, "rule": self.rule}))
        there = self.partitions()
        self._drop([p for p in there if p[2] == batch_id])  # of a first attempt, whose rows may have been others
        buckets = max((p[0] for p in there), default=1)
        self._write(self._spread(rows.withColumn(BATCH, F.lit(batch_id).cast("long")), buckets))

    def apply(self, rows: DataFrame, batch_id: int) -> None:
        """Append a micro-batch; now and then first fold those before it, which can no longer be replayed."""
        if batch_id and batch_id % self.fold_every == 0:
            self.fold_batches(batch_id - 1)
        self.append(rows, batch_id)

    def fold_batches(self, upto: int) -> None:
        """Fold the buckets with rows of several batches up to ``upto``, all finished, into that batch's partition."""
        found = [p for p in self.partitions() if p[2] <= upto]
        if not found:
            return
        size = input_bytes(self.spark, [f"{self.path}/rows"])
        now, want = max(p[0] for p in found), 1
        while want < now or want * BUCKET_BYTES < size:
            want *= 2
        if {p[0] for p in found} == {want}:  # else all rows are dealt out anew
            many = {p[1] for p in found if p[2] != min(q[2] for q in found if q[1] == p[1])}
            found = [p for p in found if p[1] in many]
        if not found:
            return
        rows = self.stored().filter(F.col(BATCH) <= upto)
        if {p[0] for p in found} == {want}:
            rows = rows.filter(F.col("bucket").isin([p[1] for p in found]))
        oldest = {}
        for p in found:
            oldest[p[:2]] = min(p[2], oldest.get(p[:2], p[2]))
        known = self.spark.createDataFrame([(*k, v) for k, v in oldest.items()], "buckets long, bucket long, oldest long")
        folded = self.forget(self.fold(rows.drop("buckets", "bucket")), rows.join(known, ["buckets", "bucket"]))
        self._write(self._spread(folded.withColumn(BATCH, F.lit(upto).cast("long")), want))
        self._drop([p for p in found if p[2] != upto or p[0] != want])

    # -- reads ---------------------------------------------------------------
    def state(self, upto: int | None = None) -> DataFrame:
        """The fold of all batches up to ``upto``."""
        rows = self.stored().drop("buckets", "bucket")
        return self.fold(rows if upto is None else rows.filter(F.col(BATCH) <= upto)).select(*self.schema.names)
