"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import checkpoint_root

#: White space of the contracts: U+0020 and U+0009 to U+000D.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, without its lineage.

    The folder is the session's ``spark.checkpoint.dir``; only a local session
    that names none (a test) gets one of its own.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def fresh(taken: Iterable[str], *names: str) -> list[str]:
    """Column names like ``names`` that clash with none of ``taken``."""
    used = {c.lower() for c in taken}
    out = []
    for name in names:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        out.append(name)
    return out


def word_count(text: Column) -> Column:
    r"""Number of ``[^\x20\x09-\x0D]+`` in the text, 0 for a null.

    One pass turns each word and the space behind it into one character, so
    no array of words is built for a very long text.
    """
    led = F.regexp_replace(text, f"^[{SPACE}]++", "")
    marks = F.regexp_replace(led, f"[^{SPACE}]++[{SPACE}]*+", "x")
    return F.coalesce(F.length(marks), F.lit(0)).cast("long")


#: A key with more than one in this many of all rows is hot; at most this many keys can be.
HOT_SHARE = 1024


def join_counted(rows: DataFrame, per: DataFrame, keys: Sequence[str], count: str, total: int) -> DataFrame:
    """``rows`` inner joined to ``per``, which has one row a key and how many of ``rows`` have it.

    The hot keys' part of ``per`` holds HOT_SHARE rows at most, whatever the
    input, and is broadcast, so rows of a hot key never meet in one task; the
    others are shuffled.
    """
    hot = F.col(count) * HOT_SHARE > F.lit(total)
    few, rest = F.broadcast(per.filter(hot)), per.filter(~hot)
    others = rows.join(F.broadcast(per.filter(hot).select(*keys)), list(keys), "left_anti")
    return rows.join(few, list(keys)).unionByName(others.join(rest, list(keys)))


def numbered(df: DataFrame, *order: str, to: str) -> DataFrame:
    """Row numbers from 0 in the order of ``order``, without one task that sees all rows.

    Rows are sorted in ranges and written; the sizes of the ranges (one row
    for each) give every range its first number.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (mark,) = fresh(df.columns, "mark")
    local = (1 << 33) - 1  # monotonically_increasing_id: partition above 33 bits of position
    ranged = cut(df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                 .withColumn(mark, F.monotonically_increasing_id()))
    part = F.shiftright(F.col(mark), 33)
    sizes = {r[0]: r[1] for r in ranged.groupBy(part.alias("p")).count().collect()}  # at most ``parts`` rows
    first, at = [0] * parts, 0
    for p in range(parts):
        first[p], at = at, at + sizes.get(p, 0)
    start = F.element_at(F.lit(first).cast("array<bigint>"), (part + 1).cast("int"))
    return ranged.withColumn(to, start + F.col(mark).bitwiseAND(F.lit(local))).drop(mark)


def from_texts(df: DataFrame, text: str, keep: Sequence[str], added: Mapping[str, str],
               scorer: Callable[[], Callable[[list[str]], Sequence]], rows: int = 256) -> DataFrame:
    """The columns ``keep`` of ``df`` and columns made from the texts in Arrow batches.

    ``added`` gives the new columns' types; kept columns of the same names are
    replaced.  ``scorer()`` is called once a task and returns the function from
    a list of texts (nulls as empty) to one list or array per new column.  At
    most ``rows`` texts are worked on at a time.
    """
    taken = {c.lower() for c in added}
    keep = [c for c in keep if c.lower() not in taken]
    schema = df.select(*keep, *[F.lit(None).cast(t).alias(c) for c, t in added.items()]).schema
    at_text = keep.index(text) if text in keep else len(keep)
    slim = df.select(*keep) if text in keep else df.select(*keep, F.col(text))
    kept = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        score, made = scorer(), to_arrow_schema(schema)
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                columns = score([t or "" for t in part.column(at_text).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:kept], *[pa.array(c, made.field(kept + i).type) for i, c in enumerate(columns)]],
                    names=made.names)

    return slim.mapInArrow(run, schema)
