import math
import re
import string
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import lexical
from tidemark.llm.common import table
from tidemark.llm.queries import op11_lexical_search

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(docs, items, k=20):
    """Sorted (item_id, rank, doc_id, score) of (doc_id, text) and (item_id, text) rows."""
    bags = [(i, Counter(found), len(found)) for i, found in ((i, terms(t)) for i, t in docs) if found]
    n, length, df = len(bags), sum(b[2] for b in bags), Counter(t for _, bag, _ in bags for t in bag)
    out = []
    for item, text in set(items):
        asked, scored = terms(text), []
        for i, bag, size in bags:
            m = 100 - 25 + 25 * size * n // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                        * (10**9 * bag[t] // (1000 * bag[t] + 12 * m)) for t in asked if t in bag)
            if score > 0:
                scored.append((-score, i is not None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def found(df):
    assert df.dtypes[1:] == [("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    return sorted([tuple(r) for r in df.collect()], key=str)


@pytest.mark.parametrize("text", ["Ab-c éÉ_x 漢字 1a", "", " \t", "\x00a\x7fB", "don't  STOP"])
def test_terms(text):
    assert [t.decode() for t in lexical.terms_of(text)] == terms(text)


def test_query(spark):
    docs = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in table(spark, SF, "benchmark").collect()]
    assert found(op11_lexical_search(spark, SF)) == brute(docs, items)


def test_awkward_rows(spark, docs_of, awkward):
    rows = awkward + [(10, "One TWO three!"), (11, "two"), (None, "one"), (12, "one")]
    docs = docs_of(rows, {"item_id": F.lit("x"), "code": F.lit(1), "m": F.lit(2), "first": F.lit(3)})
    items = [(1, "one two word7"), (1, "one two word7"), (1, "x y z"), (2, None), (3, ""), (None, "two two"), (4, "absent")]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(0))
    assert found(lexical.search(docs, asked, 4)) == brute(rows, items, 4)


def test_ties_and_copies(spark, docs_of, monkeypatch):
    """Many copies, classes of one score, several blocks of items, and few cells at a time."""
    monkeypatch.setattr(lexical, "VOCABULARY", 4)
    monkeypatch.setattr(lexical, "CELLS", 7)
    rows = [(i, "alpha beta") for i in range(0, 90, 3)] + [(i, "alpha gamma") for i in range(1, 90, 3)] \
        + [(i, "alpha filler beta") for i in range(2, 60, 3)] + [(i, f"word{i} alpha") for i in range(100, 140)] \
        + [(200 + i, "delta " * (i + 1)) for i in range(30)]
    items = [(1, "alpha"), (2, "beta gamma"), (3, "delta alpha alpha"), (4, "nothing"), (5, "filler"), (6, "word101 delta")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert found(lexical.search(docs_of(rows), asked, 7)) == brute(rows, items, 7)


def test_equal_hashes_are_told_apart(spark, docs_of, monkeypatch):
    """The vectors themselves decide, whatever the hash."""
    monkeypatch.setattr(lexical.F, "xxhash64", lambda *a: F.lit(7).cast("long"))
    rows = [(i, t) for i, t in enumerate(["a b", "a c", "a b", "b c c", "a", "b"] * 4)]
    asked = spark.createDataFrame([(1, "a"), (2, "b c")], "item_id long, text string")
    assert found(lexical.search(docs_of(rows), asked, 5)) == brute(rows, [(1, "a"), (2, "b c")], 5)


def test_empty(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.search(docs_of([(1, "a")]), none, 3).collect() == []
    assert lexical.search(docs_of([]), some, 3).collect() == []
    assert lexical.search(docs_of([(1, None)]), some, 3).collect() == []


def test_classes_are_scored_once(spark, docs_of):
    scores = lexical.Postings([([0, 2], [1, 2])], np.array([10, 5, 7])).scores(
        np.array([2, 0, 1]), np.array([0, 1, 2]), np.array([3, 1, 1]), np.array([80, 80, 90]))
    assert scores.tolist() == [[10 * (3 * 10**9 // (3000 + 960))], [0], [2 * 7 * (10**9 // (1000 + 1080))]]
