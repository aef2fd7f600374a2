import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import topk


def brute(vectors, k=5, every=50):
    good = {}
    for i, v in vectors:
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        good[i] = [math.floor(256 * float(np.float32(x))) for x in v]
    out = set()
    for q, a in good.items():
        if q % every:
            continue
        best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good.items() if i != q and len(a) == len(b))[:k]
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(best)}
    return out


def search(spark, vectors, every=50):
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    v = df.select("vec_id", topk.scaled(F.col("embedding"), 256).alias("v")).filter("vec_id is not null and v is not null")
    q = v.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    return topk.top_k(v, q, 5)


@pytest.mark.parametrize("blocks", [(8192, 1024), (40, 3)])
def test_random(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "VECTORS", blocks[0])
    monkeypatch.setattr(topk, "QUERIES", blocks[1])
    pick = np.random.default_rng(1)
    vectors = [(i, [float(x) for x in pick.normal(0, 0.1, 8).astype(np.float32)]) for i in range(500)]
    vectors += [(500 + i, vectors[3][1]) for i in range(60)]  # many ties
    vectors += [(700, None), (750, [1.0, None] * 4), (751, [float("nan")] * 8), (752, [float("inf")] * 8),
                (800, [0.0] * 8), (850, [1.0, 2.0]), (851, [2.0, 1.0]), (900, []), (901, [])]
    rows = search(spark, vectors).collect()
    assert {tuple(r) for r in rows} == brute(vectors) and len(rows) == len(brute(vectors))


def test_stops_early():
    """With a clear winner only part of the lists is read."""
    pick = np.random.default_rng(2)
    x = pick.integers(-20, 20, (5000, 4)).astype(float)
    x[7] = [500, 500, 500, 500]
    lists = topk.SortedLists(np.arange(5000), x)
    read = []
    lists.vectors = type("Seen", (), {"__getitem__": lambda s, at: read.append(len(at)) or x[at]})()
    ids, _ = lists.best(-1, np.array([1.0, 2.0, 3.0, 4.0]), 1)
    assert ids.tolist() == [7] and sum(read) < 2000


def test_large_components(spark):
    vectors = [(0, [3e6, 1.0]), (1, [3e6, -1.0]), (2, [-3e6, 2.0]), (50, [1.0, 1.0])]
    assert {tuple(r) for r in search(spark, vectors).collect()} == brute(vectors)


def test_empty_and_repeated(spark):
    assert search(spark, []).collect() == []
    rows = search(spark, [(0, [1.0]), (0, [1.0]), (1, [2.0])], 1).collect()
    assert [(r["query_id"], r["vec_id"]) for r in rows if r["query_id"] == 0] == [(0, 1)]


def test_table(spark):
    from tidemark.llm.queries import op5_topk_search
    sf = "/root/testdata/sf0.001"
    vectors = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert {tuple(r) for r in op5_topk_search(spark, sf).collect()} == brute(vectors)


def test_repeated_vectors_are_rows(spark, monkeypatch):
    """A vector given several times takes as many ranks; equal rows are dealt over the blocks."""
    monkeypatch.setattr(topk, "VECTORS", 10)
    rows = [(1, [5.0, 1.0])] * 3 + [(2, [4.0, 1.0])] + [(3, [-1.0, 0.0])] * 60
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    v = df.select("vec_id", topk.scaled(F.col("embedding"), 256).alias("v")) \
        .withColumns({"row": F.lit("x"), "block": F.lit(1), "bar": F.lit(2), "kind": F.lit(3)})
    q = v.filter("vec_id = 2").select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), "block", "bar")
    got = [tuple(r) for r in topk.top_k(v, q.unionByName(q), 5).orderBy("rank").collect()]
    best = 1024 * 1280 + 256 * 256
    assert got == [(2, 1, 1, best), (2, 2, 1, best), (2, 3, 1, best), (2, 4, 3, -262144), (2, 5, 3, -262144)]


def test_the_bar_of_one_block_spares_the_others():
    """A block whose greatest components are below the bar is not read; lists are read no further than it."""
    pick = np.random.default_rng(3)
    block = topk.Block(4)
    block.add(np.arange(2000), pick.integers(-20, 20, (2000, 4)))
    query = np.array([[1, 2, 3, 4]])
    limit = int(np.abs(query).sum() * 20) + 1
    assert [c.size for c in block.answers(np.array([-1]), np.array([0]), query, [limit], 3)] == [0] * 4
    ids = np.array([-1])
    _, _, at, scores = block.answers(ids, np.array([0]), query, [None], 3)
    _, _, same, again = block.answers(ids, np.array([0]), query, [int(scores[1])], 3)
    assert same.tolist() == at[scores >= scores[1]].tolist() and again.min() >= scores[1]


def test_vectors_move_the_same_however_many_queries(spark, monkeypatch):
    """Each pass shuffles a vector once: rows that reach the blocks are vectors + queries x blocks."""
    monkeypatch.setattr(topk, "VECTORS", 50)
    pick = np.random.default_rng(4)
    rows = [(i, [int(x) for x in pick.integers(-9, 9, 3)]) for i in range(200)]
    v = spark.createDataFrame(rows, "vec_id long, v array<long>")
    seen = []
    monkeypatch.setattr(topk, "_pass", lambda a, b, k, of=topk._pass: seen.append((a.count(), b.count())) or of(a, b, k))
    for n in (5, 100):
        topk.top_k(v, v.limit(n).select(F.col("vec_id").alias("query_id"), F.col("v").alias("q")), 3).collect()
    assert seen == [(200, 5), (200, 15), (200, 100), (200, 300)]
