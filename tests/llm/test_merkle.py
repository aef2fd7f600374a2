import hashlib
import string
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle
from tidemark.llm.common import table
from tidemark.llm.queries import op12_merkle_manifest

SF = "/root/testdata/sf0.001"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(level):
    """The root over a list of digests, and each one's steps (left, right)."""
    where, paths = list(range(len(level))), [[] for _ in level]
    while len(level) > 1:
        for i, at in enumerate(where):
            first = at // 8 * 8
            paths[i].append(("".join(level[first:at]), "".join(level[at + 1:first + 8])))
        level = [sha(*level[i:i + 8]) for i in range(0, len(level), 8)]
        where = [at // 8 for at in where]
    return level[0], paths


def lower(text):
    return text and text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))


def brute(rows):
    """Rows of the query for (doc_id, source, lang, n_chars, text) rows, in any order."""
    groups, out = {}, []
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    made = {}
    for g in names:
        ranked = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        made[g] = ranked, *tree([leaf_of(r) for r in ranked])
    root, above = tree([made[g][1] for g in names])
    for g, up in zip(names, above):
        ranked, subroot, paths = made[g]
        for r, path in zip(ranked, paths):
            now = leaf_of(r)
            if r[0] is not None and crc32(str(r[0]).encode()) % 3 == 0:
                now = leaf_of((*r[:4], lower(r[4])))
            for left, right in path + up:
                now = sha(left, now, right)
            out.append((r[0], leaf_of(r), subroot, root, sha(*[a + b for a, b in path + up]), now, now == root))
    return sorted(out, key=str)


def found(df):
    return sorted([(r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"], r["verified"])
                   for r in df.collect()], key=str)


def as_table(spark, folder, rows, more=None):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    df.withColumns(more or {}).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_query(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select(*FIELDS).collect()]
    assert found(op12_merkle_manifest(spark, SF)) == brute(rows)


@pytest.mark.parametrize("n", [1, 8, 9, 65, 513, 4096, 4097, 9000])
def test_sizes(spark, n):
    """Every shape of tree, over the end of one block and of several."""
    rows = [(7 * i % 10007, "s", "en", i, f"Text {i}") for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    got = {r["doc_id"]: r for r in merkle.manifest(df, FIELDS, "lang", ["doc_id"], ["doc_id"]).withColumn(
        "again", merkle.fold(F.col("leaf"), F.col("path"))).collect()}
    ranked = sorted(rows)
    root, paths = tree([leaf_of(r) for r in ranked])
    assert len(got) == n
    for r, path in zip(ranked, paths):
        one = got[r[0]]
        assert [tuple(s) for s in one["path"]] == path
        assert one["root"] == one["again"] == root and one["leaf"] == leaf_of(r)


def test_small_blocks(spark, monkeypatch):
    """Blocks above blocks above blocks."""
    monkeypatch.setattr(merkle, "LEVELS", 1)
    rows = [(i, "s", "en" if i % 3 else None, i, "A b") for i in range(700)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    got = merkle.manifest(df, FIELDS, "lang", ["doc_id"], ["doc_id"]).select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("p")).collect()
    want = {r[:5] for r in brute(rows)}
    assert {tuple(r) for r in got} == want


def test_awkward_rows(spark, tmp_path):
    """Nulls in every column, repeated ids and rows, one language of one row, a clashing column."""
    long = "Word " * 60_000
    rows = [(None, None, None, None, None), (None, None, None, None, None), (1, "a", "en", 3, "ABC"),
            (1, "a", "en", 3, "ABC"), (1, "b", "en", 3, "ABC"), (-5, "é", "é", -1, "É漢A"), (2, "", "", 0, ""),
            (3, "s", "en", None, long), (9, None, "zz", 1, None), (10, "=", "=", 1, "-"), (12, "x", "en", 1, "Q")]
    rows += [(100 + i, "s", "fr", i, "Même TEXTE") for i in range(20)]
    folder = as_table(spark, tmp_path, rows, {"leaf": F.lit("mine"), "grp": F.lit(1), "hash": F.lit("x"), "path": F.lit(2)})
    df = op12_merkle_manifest(spark, folder)
    assert found(df) == brute(rows)
    assert {v for *_, v in found(df)} == {True, False}  # some are tampered with


def test_hot_copies(spark):
    """Many equal rows are spread, and are leaves of their own."""
    rows = [(5, "s", "en", 1, "x")] * 5000 + [(6, "s", "fr", 1, "y")]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    got = merkle.manifest(df, FIELDS, "lang", ["doc_id"], ["doc_id"])
    same = got.groupBy("doc_id").agg(F.count("*").alias("n"), F.count_distinct("subroot").alias("s")).collect()
    assert {tuple(r) for r in same} == {(5, 5000, 1), (6, 1, 1)}
    assert tree([leaf_of(r) for r in rows[:5000]])[0] in {r["subroot"] for r in got.select("subroot").distinct().collect()}


def test_empty(spark, tmp_path):
    assert op12_merkle_manifest(spark, as_table(spark, tmp_path, [])).collect() == []
