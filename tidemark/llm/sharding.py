"""Reproducible global shuffle into shards by a Feistel permutation.

Every row gets a global number in ``[0, n)``.  A Feistel network over the
smallest even number of bits that holds ``n`` permutes the numbers; results of
``n`` or more are put through it again until they fall below ``n`` (cycle
walking), which keeps the map a permutation.  Row ``p`` of the shuffled order
has shard ``p % shards`` and slot ``p // shards``: shard sizes differ by one at
most, slots have no gap, and both can be computed from a row number, and the
row number from them (:func:`unpermute`), without any data.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import fresh

ROUNDS = 6
#: Row numbers are dealt in this many hash buckets; a bucket holds n / BUCKETS rows.
BUCKETS = 4096


def _keys(seed: int) -> list[np.uint64]:
    return [np.uint64(int.from_bytes(hashlib.sha256(f"{seed}:{r}".encode()).digest()[:8], "big"))
            for r in range(ROUNDS)]


def _mixed(half: np.ndarray, key: np.uint64) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on all of ``half``."""
    with np.errstate(over="ignore"):
        z = half * np.uint64(0x9E3779B97F4A7C15) + key
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _walk(numbers: np.ndarray, n: int, seed: int, back: bool) -> np.ndarray:
    out = np.asarray(numbers, dtype=np.uint64).copy()
    bits = max(1, ((max(n - 1, 1)).bit_length() + 1) // 2)
    low, width = np.uint64((1 << bits) - 1), np.uint64(bits)
    keys = _keys(seed)
    todo = np.arange(out.size)
    while todo.size:
        x = out[todo]
        left, right = x >> width, x & low
        if back:
            for key in reversed(keys):
                left, right = right ^ (_mixed(left, key) & low), left
        else:
            for key in keys:
                left, right = right, left ^ (_mixed(right, key) & low)
        out[todo] = (left << width) | right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def permute(numbers: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Place of each row number in the shuffled order of ``n`` rows."""
    return _walk(numbers, n, seed, back=False)


def unpermute(places: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Row number that stands at each place; the inverse of :func:`permute`."""
    return _walk(places, n, seed, back=True)


def shard_rows(rows: DataFrame, key: Sequence[str], shards: int, seed: int,
               buckets: int = BUCKETS) -> DataFrame:
    """``rows`` with ``shard`` (int) and ``slot`` (long), shuffled over ``shards`` shards.

    Global row numbers: rows are dealt into ``buckets`` by a hash of ``key``
    and numbered by ``key`` inside each; the buckets' sizes (a table of
    ``buckets`` rows at most) give the first number of each.  The numbers
    depend on the rows alone, not on files or partitions, so a lost task that
    runs again makes the same ones.

    Nulls in ``key`` are values like any other.  Rows equal in all of ``key``
    get neighbouring numbers in any order.  An empty input gives an empty
    output.  Input columns named ``shard`` or ``slot`` are replaced; other
    columns pass through, so drop what need not be shuffled first.
    """
    bucket, at, first, size = fresh([*rows.columns, "shard", "slot"], "bucket", "at", "first", "size")
    dealt = rows.withColumn(bucket, F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))
    counts = dict(dealt.groupBy(bucket).agg(F.count(F.lit(1)).alias(size)).collect())  # at most ``buckets`` rows
    n = sum(counts.values())
    starts, total = [0] * buckets, 0
    for b in range(buckets):
        starts[b], total = total, total + counts.get(b, 0)
    table = rows.sparkSession.createDataFrame(
        pd.DataFrame({bucket: np.arange(buckets, dtype=np.int32), first: np.array(starts, dtype=np.int64)}))

    @F.pandas_udf("long")
    def place(numbers: pd.Series) -> pd.Series:
        return pd.Series(permute(numbers.to_numpy(dtype=np.int64), n, seed))

    order = Window.partitionBy(bucket).orderBy(*key)
    out = (dealt.withColumn(at, F.row_number().over(order) - 1)
           .join(F.broadcast(table), bucket)  # ``buckets`` rows
           .withColumn(at, place(F.col(first) + F.col(at))))
    return (out.withColumn("shard", F.pmod(at, F.lit(shards)).cast("int"))
            .withColumn("slot", F.expr(f"`{at}` div {int(shards)}"))
            .drop(bucket, at, first))
