"""Exact top-k search by inner product: the threshold algorithm over sorted lists.

Vectors are dealt into blocks by row.  A block keeps one list per dimension, sorted by
the component.  A query reads its lists from their good ends together; every
vector met is scored in full, and reading stops when no unread vector can
beat the k-th best so far: the bound is the query's product with the components next
in its lists.

Each query first meets one block, whose k-th result is a bar that holds for all
blocks.  Then it meets the others: it skips a block whose best conceivable score (its
greatest and least components) is below the bar, reads no list further than the bar, and
returns nothing below it.  A vector is shuffled once in each of the two passes, however
many queries there are: a task reads a block's vectors, then its queries in
batches, so queries are never held together.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut

#: Vectors in a block, on average, and queries that a task answers at a time.
VECTORS, QUERIES = 8192, 1024
#: Components below this leave sums exact in floating point, which is much faster.
EXACT = 2.0 ** 53


class SortedLists:
    """A block of vectors with a list per dimension, smallest component first."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        place = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[place], vectors[place]
        self.order = np.argsort(self.vectors, axis=0, kind="stable").T.astype(np.int32)
        self.sorted = np.take_along_axis(self.vectors.T, self.order, axis=1)

    def most(self, queries: np.ndarray) -> np.ndarray:
        """What no score of the block can exceed, for each query."""
        return np.maximum(queries, 0) @ self.sorted[:, -1] + np.minimum(queries, 0) @ self.sorted[:, 0]

    def best(self, query_id: int, query: np.ndarray, k: int, bar: float | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best vectors, best first, ties to the smaller id, without the query's own.

        With a ``bar`` vectors below it may be left out."""
        n = self.ids.size
        seen = self.ids == query_id
        used = np.flatnonzero(query)
        up = query[used] > 0
        weights = query[used]
        top_at, top_score = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=query.dtype)
        depth, step = 0, max(16, n // 64)
        while depth < n:
            end = min(n, depth + step)
            mask = np.zeros(n, dtype=bool)
            if used.size:
                mask[self.order[used[up], n - end:n - depth]] = True
                mask[self.order[used[~up], depth:end]] = True
            else:
                mask[depth:end] = True  # all scores are 0: the smallest ids
            mask &= ~seen
            seen |= mask
            new = np.flatnonzero(mask)
            at = np.concatenate([top_at, new])
            score = np.concatenate([top_score, self.vectors[new] @ query])
            if score.size > k:
                least = -np.partition(-score, k - 1)[k - 1]
                at, score = at[score >= least], score[score >= least]
            order = np.lexsort((self.ids[at], -score))[:k]
            top_at, top_score = at[order], score[order]
            depth, step = end, step * 2
            least = top_score[-1] if top_at.size == k else bar
            if bar is not None and least is not None:
                least = max(least, bar)
            if depth < n and least is not None:
                ahead = np.where(up, self.sorted[used, n - 1 - depth], self.sorted[used, depth])
                if weights @ ahead < least or (not used.size and top_at.size == k):
                    break  # an equal bound goes on: an unread vector could tie with a smaller id
        if bar is not None:
            top_at, top_score = top_at[top_score >= bar], top_score[top_score >= bar]
        return self.ids[top_at], top_score


def scaled(vector: Column, by: int) -> Column:
    """floor(by * x) of each component; null for a vector that is null or holds a null or non-finite component."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(False)), F.transform(wide, lambda x: F.floor(x * by)))


class Block:
    """The vectors of one block, and their sorted lists once a query asks."""

    def __init__(self, dim: int):
        self.dim, self.ids, self.vectors, self.lists = dim, [], [], {}

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids.append(ids)
        self.vectors.append(vectors)

    def answers(self, ids: np.ndarray, asked: np.ndarray, queries: np.ndarray, bars: list[int | None],
                k: int) -> list[np.ndarray]:
        """``query_id, asked, vec_id, score`` of the best of the block for each query."""
        if not self.ids:
            return [np.zeros(0, dtype=np.int64)] * 4
        if len(self.ids) > 1:
            self.ids, self.vectors = [np.concatenate(self.ids)], [np.concatenate(self.vectors)]
        (own,), (vectors,) = self.ids, self.vectors
        most = float(np.abs(vectors).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, self.dim)
        kind = np.float64 if most < EXACT else np.int64
        if kind not in self.lists:
            self.lists[kind] = SortedLists(own, vectors.astype(kind))
        lists, queries = self.lists[kind], queries.astype(kind)
        found: list[tuple[np.ndarray, ...]] = []
        for query_id, number, query, bar, limit in zip(ids.tolist(), asked.tolist(), queries, bars, lists.most(queries),
                                                       strict=True):
            if bar is None or limit >= bar:
                at, scores = lists.best(query_id, query, k, bar)
                found.append((np.full(at.size, query_id), np.full(at.size, number), at, scores))
        return [np.concatenate(c).astype(np.int64) for c in zip(*found, strict=True)] or [np.zeros(0, dtype=np.int64)] * 4


NAMES = ("query_id", "asked", "vec_id", "score")


def _met(k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``dim, block, kind, id, asked, bar, v`` in the order of the first three: vectors (0), then queries (1)."""
    held, block = None, Block(0)
    for batch in batches:
        if not batch.num_rows:
            continue
        dim, at, kind = (batch.column(i).to_numpy() for i in range(3))
        turns = np.flatnonzero(np.diff(dim) | np.diff(at) | np.diff(kind)) + 1
        for start, stop in zip([0, *turns.tolist()], [*turns.tolist(), batch.num_rows], strict=True):
            key = (int(dim[start]), int(at[start]))
            if key != held:
                held, block = key, Block(key[0])
            for first in range(start, stop, QUERIES if kind[start] else stop - start):
                part = batch.slice(first, min(stop - first, QUERIES) if kind[start] else stop - first)
                ids, rows = part.column(3).to_numpy(), part.column(6).flatten().to_numpy().reshape(part.num_rows, key[0])
                if kind[start]:
                    columns = block.answers(ids, part.column(4).to_numpy(), rows, part.column(5).to_pylist(), k)
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=NAMES)
                else:
                    block.add(ids, rows)


def _pass(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k best of each block for each of its queries, both given as rows of :func:`_met`."""
    both = vectors.unionByName(queries).repartition("dim", "block").sortWithinPartitions("dim", "block", "kind")
    return both.mapInArrow(partial(_met, k), ", ".join(f"{n} long" for n in NAMES))


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the k vectors of the largest integer inner product with each query.

    ``vectors`` is ``vec_id long, v array<long>`` and ``queries`` ``query_id,
    q``, without nulls; other columns, whatever their names, do no harm.  Ties go to the smaller vec_id; a vector with the
    query's own id takes no part; fewer than k others give fewer rows; vectors
    and queries of different lengths do not meet.  A vector given several times (same id and components) is as
    many rows, each with a rank of its own; a query given twice counts
    once; two queries of one id are answered apart.  Scores are exact while they fit in a long.
    Empty tables give an empty result.
    """
    queries = cut(queries.select("query_id", "q").distinct()
                  .withColumn("asked", F.xxhash64("q")))  # tells two vectors of one id apart
    vectors = cut(vectors.select("vec_id", "v").withColumn("row", F.monotonically_increasing_id()))
    blocks = max(1, -(-vectors.count() // VECTORS))
    none = F.lit(None).cast("long")
    there = vectors.select(F.size("v").alias("dim"), F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block"),
                           F.lit(0).alias("kind"), F.col("vec_id").alias("id"), F.lit(0).cast("long").alias("asked"),
                           none.alias("bar"), "v")

    def to(block: Column, bar: Column, rows: DataFrame) -> DataFrame:
        return rows.select(F.size("q").alias("dim"), block.alias("block"), F.lit(1).alias("kind"),
                           F.col("query_id").alias("id"), "asked", bar.alias("bar"), F.col("q").alias("v"))

    home = F.pmod(F.xxhash64("asked", "query_id"), F.lit(blocks))
    first = cut(_pass(there, to(home, none, queries), k))
    found = first
    if blocks > 1:
        bars = first.groupBy("query_id", "asked").agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("bar"))
        others = F.filter(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")), lambda b: b != home)
        sent = queries.join(bars, ["query_id", "asked"], "left").withColumn("block", F.explode(others))
        found = first.unionByName(_pass(there, to(F.col("block"), F.col("bar"), sent), k))
    order = Window.partitionBy("query_id", "asked").orderBy(F.desc("score"), "vec_id")  # k rows a block
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
