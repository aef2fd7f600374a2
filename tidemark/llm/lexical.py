"""Ranked lexical search of query texts over documents, with equal bags scored once.

A document matters to the queries only by how often each of their terms occurs
in it and by its length, so each document is restricted to the queries'
vocabulary: a vector of term numbers and their times, and the length factor
``m``.  Documents of identical vectors and ``m`` are one class, found by the
vectors' hash and verified by the vectors themselves in one grouping that combines in
each task before its shuffle.  Every class is scored once for all queries,
through the queries' posting lists; a task keeps the best classes of each
query.  The best classes are then expanded into their documents by ascending
id: the k best documents lie in the k best classes, if classes of one score
stand in the order of their least ids.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import cut, from_texts

#: Distinct terms of a block of queries, on average at most; the documents are read once for each block.
VOCABULARY = 1 << 18
#: Cells (classes x queries) that a task scores at a time.
CELLS = 1 << 20
#: Fixed values of the ranking: document lengths weigh a quarter; scales of the integer arithmetic.
WEIGHT_SCALE, SCORE_SCALE, TIMES_SCALE, LENGTH_SCALE, FLAT, SLOPE = 1000, 1_000_000_000, 1000, 12, 75, 25

_KEPT = {*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _KEPT else 0x20 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    r"""Matches of ``[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+`` in UTF-8, A-Z in lower case."""
    return text.encode().translate(_BYTES).split()


def _counted(texts: list[str]) -> list[list]:
    counts = [Counter(terms_of(t)) for t in texts]
    return [[list(c) for c in counts], [list(c.values()) for c in counts]]


def _bags(vocabulary: dict[bytes, int], texts: list[str]) -> list[list]:
    """Number of terms, and numbers (ascending) and times of those in the vocabulary."""
    n, terms, times = [], [], []
    for text in texts:
        found = terms_of(text)
        n.append(len(found))
        bag = Counter(map(vocabulary.get, found))
        bag.pop(None, None)
        numbers = sorted(bag)
        terms.append(numbers)
        times.append([bag[t] for t in numbers])
    return [n, terms, times]


class Postings:
    """For each term its weight, and the queries that hold it with their times."""

    def __init__(self, queries: Sequence[tuple[Sequence[int], Sequence[int]]], weights: np.ndarray):
        self.weights, self.queries = weights, len(queries)
        term = np.array([t for terms, _ in queries for t in terms], dtype=np.int64)
        query = np.repeat(np.arange(len(queries)), [len(terms) for terms, _ in queries])
        times = np.array([x for _, often in queries for x in often], dtype=np.int64)
        order = np.argsort(term, kind="stable")
        self.query, self.times = query[order], times[order]
        self.first = np.searchsorted(term[order], np.arange(weights.size + 1))

    def scores(self, size: np.ndarray, terms: np.ndarray, times: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Integer scores, a row for each class and a column for each query."""
        row = np.repeat(np.arange(size.size), size)
        part = self.weights[terms] * ((SCORE_SCALE * times) // (TIMES_SCALE * times + LENGTH_SCALE * m[row]))
        n = self.first[terms + 1] - self.first[terms]
        at = np.repeat(self.first[terms] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        out = np.zeros(size.size * self.queries, dtype=np.int64)
        np.add.at(out, np.repeat(row * self.queries, n) + self.query[at], np.repeat(part, n) * self.times[at])
        return out.reshape(size.size, self.queries)


class Best:
    """The k best classes of each query so far: highest score, then least first id (none before all), then number."""

    def __init__(self, queries: int, k: int):
        self.k, self.bar = k, np.ones(queries, dtype=np.int64)  # scores of 0 do not count
        self.rows = np.zeros((0, 5), dtype=np.int64)  # query, score, whether an id is there, id, class

    def add(self, scores: np.ndarray, known: np.ndarray, first: np.ndarray, number: np.ndarray) -> None:
        at, query = np.nonzero(scores >= self.bar)
        more = np.column_stack([query, scores[at, query], known[at], first[at], number[at]])
        rows = np.concatenate([self.rows, more])
        rows = rows[np.lexsort((rows[:, 4], rows[:, 3], rows[:, 2], -rows[:, 1], rows[:, 0]))]
        starts = np.searchsorted(rows[:, 0], np.arange(self.bar.size + 1))
        place = np.arange(len(rows)) - starts[rows[:, 0]]
        self.rows = rows[place < self.k]
        full = np.flatnonzero(np.diff(starts) >= self.k)
        self.bar[full] = rows[starts[full] + self.k - 1, 1]


def _scored(postings: Postings, k: int, names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best classes of one task for each query."""
    best, rows = Best(postings.queries, k), max(1, CELLS // max(1, postings.queries))
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            number, m, terms, times, first = batch.slice(at, rows).columns
            scores = postings.scores(np.diff(terms.offsets.to_numpy()), terms.flatten().to_numpy().astype(np.int64),
                                     times.flatten().to_numpy().astype(np.int64), m.to_numpy())
            best.add(scores, ~np.asarray(first.is_null()), first.fill_null(0).to_numpy(), number.to_numpy())
    query, score, known, first, number = best.rows.T
    yield pa.RecordBatch.from_arrays([
        pa.array(query), pa.array(score), pa.array(number), pa.array(first, mask=known == 0)], names=names)


def _weights(documents: int, per: np.ndarray) -> np.ndarray:
    return np.array([math.floor(WEIGHT_SCALE * math.log((2 * documents + 2) / (2 * df + 1))) for df in per.tolist()],
                    dtype=np.int64)


def search(docs: DataFrame, items: DataFrame, k: int, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of the highest scores above 0 for each item.

    Terms are those of :func:`terms_of` in the whole text; a null text has none.
    A term weighs ``floor(1000 ln((2 N + 2) / (2 df + 1)))``, where N counts the
    documents with a term and df those with this one; a document's score sums
    ``weight * (10**9 tf div (1000 tf + 12 m))`` over the item's terms, repeats
    included, with ``m = 75 + 25 n N div L`` for its n of all L terms.

    Equal scores go to the smaller integer ``doc_id`` (null before all).  Every row of ``docs`` is a
    document: repeated rows and ids take ranks of their own.  An item given
    twice (id and text) is one item; two texts of one id are ranked apart.
    Items without terms, and tables without documents, have no rows.
    Other columns, whatever their names, do no harm.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    asked = cut(items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).distinct()
                .withColumn("item", F.monotonically_increasing_id()))
    counted = cut(from_texts(asked, "text", ["item_id", "item"], {"terms": "array<binary>", "times": "array<int>"},
                             lambda: _counted).drop("text"))
    blocks = -(-(counted.agg(F.sum(F.size("terms"))).first()[0] or 0) // VOCABULARY)
    found = [_block(docs, counted.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b), k) for b in range(blocks)]
    schema = T.StructType([asked.schema["item_id"], T.StructField("rank", T.IntegerType()),
                           T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    out = docs.sparkSession.createDataFrame([], schema)
    for part in found:
        out = out.unionByName(part)
    return out


def _block(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """The search for one block of items; their terms are bounded, see :data:`VOCABULARY`."""
    spark = docs.sparkSession
    asked = items.filter(F.size("terms") > 0).collect()
    vocabulary = {t: i for i, t in enumerate(sorted({bytes(t) for r in asked for t in r["terms"]}))}
    queries = [([vocabulary[bytes(t)] for t in r["terms"]], r["times"]) for r in asked]

    scorer: Callable = partial(partial, _bags, vocabulary)
    bags = cut(from_texts(docs, "text", ["doc"], {"n": "bigint", "terms": "array<int>", "times": "array<int>"}, scorer))
    held, length = bags.filter("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    m = F.lit(FLAT) + F.expr(f"({SLOPE} * n * {held}) div {length or 1}")
    bags = bags.filter(F.size("terms") > 0).select("doc", m.cast("long").alias("m"), "terms", "times") \
        .withColumn("code", F.xxhash64("m", "terms", "times"))
    same = ["code", "m", "terms", "times"]
    classes = cut(bags.groupBy(*same).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc")).alias("first"))
                  .withColumn("class", F.monotonically_increasing_id()))

    per = np.zeros(len(vocabulary), dtype=np.int64)
    for r in classes.select(F.explode("terms").alias("term"), "n").groupBy("term").agg(F.sum("n")).collect():
        per[r[0]] = r[1]  # a row for each term of the vocabulary at most
    postings = Postings(queries, _weights(held, per))
    names = ["query", "score", "class", "first"]
    scored = classes.select("class", "m", "terms", "times", "first.doc").mapInArrow(
        partial(_scored, postings, k, names), "query long, score long, class long, first long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("first"), "class")
    best = cut(scored.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)
               .select("query", "score", "class"))

    # k classes for each query of the block at most
    chosen = cut(classes.join(F.broadcast(best.select("class").distinct()), "class", "left_semi").select(*same, "class"))
    first = Window.partitionBy(*same).orderBy(F.asc_nulls_first("doc"))
    members = (bags.join(F.broadcast(chosen.select("code").distinct()), "code", "left_semi")
               .withColumn("place", F.row_number().over(first)).filter(F.col("place") <= k)  # limited before the shuffle too
               .join(chosen, same).select("class", "doc"))
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("doc"))
    rows = (best.join(members, "class").withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k))
    named = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(asked)],
                                  T.StructType([T.StructField("query", T.LongType()), items.schema["item_id"]]))
    return rows.join(named, "query").select("item_id", "rank", F.col("doc").alias("doc_id"), "score")
