"""Replay a table as a stream in slices (tests and the replay queries).

The rows are written once as Parquet, split by a slice number: ranges of an
ordering column, or a given expression.  Each slice is one ``availableNow``
run of the job, on the same checkpoint, so a job sees the slices one after the
other as it would see a topic grow, and no file order matters.  The number of
slices follows from the input's size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import input_bytes, scratch_path
from tidemark.sinks.files import delete_path, list_dirs
from tidemark.sources.tables import keyed_table
from tidemark.streaming import jobs as sj

AVAILABLE_NOW = {"availableNow": True}
#: Bytes of input files that one slice holds, and the fewest slices of a replay.
SLICE_BYTES = 8 << 30
SLICES = 3
#: Pieces of a slice that different tasks may write.
PIECES = 64
#: Most slices that tasks write where the rows lie: each task writes a file a slice.
DIRECT = 8


def slices_for(spark: SparkSession, paths: Sequence[str]) -> int:
    return max(SLICES, -(-input_bytes(spark, list(paths)) // SLICE_BYTES))


def by_range(df: DataFrame, col: str, n: int) -> Column:
    """Slice 0 .. n-1 of ``col`` in about equal ranges, lowest values (and nulls) first.

    The place among the n - 1 bounds is found by halving a literal array, in as many steps as n has bits.
    """
    at = [i / n for i in range(1, n)]
    bounds = df.select(F.percentile_approx(F.col(col), at, 1000)).first()[0] or []  # n - 1 values
    if not bounds:
        return F.lit(0)
    value, given = F.col(col), F.lit(list(bounds)).cast(ArrayType(df.schema[col].dataType))
    steps = F.lit([1 << i for i in reversed(range(len(bounds).bit_length()))])

    def closer(low: Column, step: Column) -> Column:
        """The greatest place so far all of whose bounds are below the value."""
        return F.when(F.try_element_at(given, low + step) < value, low + step).otherwise(low)

    return F.when(value.isNull(), 0).otherwise(F.aggregate(steps, F.lit(0), closer))


class Replay:
    """A table written in slices under ``root``; iterating gives a stream over each slice in turn.

    ``dealt``: the rows of every slice already lie over all tasks, by a hash; few slices are then
    written without one more shuffle (ranging them would also make every row twice, once for the bounds)."""

    def __init__(self, df: DataFrame, slice_of: Column, n: int, root: str | None = None, dealt: bool = False):
        self.spark, self.schema, self.n = df.sparkSession, df.schema, n
        self.root = root or scratch_path(self.spark, "replay")
        number = F.lpad(slice_of.cast("int").cast("string"), 9, "0")
        # Ranged by slice, and within a slice by a hash of the row: few files a slice, and no task with a whole one.
        spread = F.pmod(F.xxhash64(*df.columns), F.lit(PIECES))
        rows = df.withColumn("_slice", number)
        (rows if dealt and n <= DIRECT else rows.repartitionByRange("_slice", spread)).write \
            .partitionBy("_slice").parquet(f"{self.root}/src")

    def __iter__(self) -> Iterator[DataFrame]:
        for name in list_dirs(self.spark, f"{self.root}/src", "_slice="):
            # A pattern that matches this one folder: a plain path would have to hold the files
            # of earlier runs too, which a restarted source opens once more.
            yield self.spark.readStream.schema(self.schema).parquet(f"{self.root}/src/{name[:-1]}[{name[-1]}]")

    def run(self, start: Callable[[DataFrame], StreamingQuery | list[StreamingQuery]]) -> "Replay":
        """Start the job on every slice in turn, and wait for each."""
        for stream in self:
            wait(start(stream))
        delete_path(self.spark, f"{self.root}/src")  # the slices have been read
        return self


def wait(queries: StreamingQuery | list[StreamingQuery]) -> None:
    for q in queries if isinstance(queries, list) else [queries]:
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))


def by_time(df: DataFrame, time_col: str, n: int = SLICES, root: str | None = None) -> Replay:
    """A replay in event-time order: no row is late for its window."""
    return Replay(df, by_range(df, time_col, n), n, root)


def replay_window_job(spark: SparkSession, job: sj.WindowJob, source: DataFrame,
                      n: int = SLICES, root: str | None = None) -> DataFrame:
    """Run a windowed job's shipped queries over ``source`` replayed in time order.

    Returns the APP table.  The windows that the watermark has not closed by
    the end of the input (the last ones) are not in it."""
    replay = by_time(source, job.time_col, n, root)
    at = replay.root
    replay.run(lambda stream: sj.start_dws(job, stream, f"{at}/dws", f"{at}/ckpt", AVAILABLE_NOW))
    wait(sj.start_app(spark, f"{at}/dws", job.dws_schema, job.app, job.app_keys, f"{at}/app",
                      f"{at}/ckpt/app", AVAILABLE_NOW))
    return keyed_table(spark, f"{at}/app")


def replay_category_job(spark: SparkSession, replay: Replay, dim_loader: Callable[[], DataFrame],
                        max_age_s: float = 600.0) -> DataFrame:
    """The shipped category job over a replay, then its APP table."""
    at = replay.root
    replay.run(lambda stream: sj.start_category_dws(stream, dim_loader, f"{at}/dws", f"{at}/ckpt", max_age_s,
                                                    AVAILABLE_NOW))
    wait(sj.start_category_app(spark, f"{at}/dws", f"{at}/app", f"{at}/ckpt", AVAILABLE_NOW))
    return keyed_table(spark, f"{at}/app")
