import hashlib
import math
import os
import shutil
from collections import Counter

import corpus_pipeline
import pytest
import sentencepiece
from pyspark.sql import functions as F

from test_mixing import targets
from test_simhash import plain_components, plain_fingerprint
from tidemark.llm import simhash, toxicity
from tidemark.llm.ngrams import words_of
from tidemark.llm.queries import MIX_CAP, MIX_SHARE, MIX_WEIGHTS, MODEL_FILE

LIB = sentencepiece.SentencePieceProcessor(model_file=MODEL_FILE)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(tmp_path_factory, spark):
    """The small tables, with nulls, copies and a clashing column among the documents."""
    to = tmp_path_factory.mktemp("sf")
    shutil.copy(f"{SF}/labels.parquet", to)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    more = docs.limit(20).withColumn("doc_id", F.col("doc_id") + 100_000)
    odd = spark.createDataFrame([(200_000, None, None, None, None), (None, "", "en", None, 0)], docs.schema)
    docs.unionByName(more).unionByName(odd).withColumn("rejected", F.lit("mine")).withColumn("size", F.lit(7)) \
        .write.parquet(f"{to}/documents.parquet")
    return str(to)


def test_stages(spark, folder):
    assert len(corpus_pipeline.STAGES) == 5
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder).cache()
        kept[name] = (docs, out)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
            assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
            assert out.filter("rejected <> 'mine' or size <> 7").count() == 0
            docs = out
    before, after = kept["toxicity"]
    marked = spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 1").select("doc_id")
    assert after.count() < before.count() and after.count() > 0.7 * before.count()
    assert after.join(marked, "doc_id").count() <= 0.3 * before.join(marked, "doc_id").count()
    before, after = kept["line_dedup"]
    assert after.count() == before.count()
    assert after.filter(F.length("text") != F.col("n_chars")).count() == 0
    before, after = kept["simhash"]
    groups = simhash.near_duplicates(before, 3).agg(F.count_distinct("group")).first()[0]
    assert after.count() == groups
    before, after = kept["mixing"]
    words = sum(len(words_of(r["text"] or "")) for r in before.collect())
    taken = sum(len(words_of(r["text"] or "")) for r in after.collect())
    assert taken == pytest.approx(1.5 * words, rel=0.03)
    assert after.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2
    before, after = kept["sentencepiece"]
    assert after.count() == before.count()
    assert after.groupBy("doc_id").agg(F.count_distinct("ids_sha256").alias("n")).filter("n > 1").count() == 0


SPACE = " \t\n\x0b\x0c\r"


def plain_toxicity(rows, model):
    score = toxicity._scored(model)
    return [r for r in rows if max(p[0] for p in score([r["text"] or ""])) < toxicity.REJECT]


def plain_line_dedup(rows):
    """Later windows of three worded lines (or of all lines, where there are fewer) go; ids are distinct."""
    seen, out = set(), []
    for r in sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0)):
        text = r["text"]
        if text is not None:
            lines = text.split("\n")
            word, gone = [i for i, x in enumerate(lines) if x.strip(SPACE)], set()
            spans = [word[i:i + 3] for i in range(len(word) - 2)] or ([word] if word else [])
            for span in spans:
                window = tuple(lines[i] for i in span)
                if window in seen:
                    gone.update(range(span[0], span[-1] + 1))
                seen.add(window)
            text = "\n".join(x for i, x in enumerate(lines) if i not in gone)
        out.append({**r, "text": text})
    return out


def plain_simhash(rows):
    least = plain_components([(r["doc_id"], plain_fingerprint(r["text"] or "")) for r in rows])
    return [r for r, first in zip(rows, least) if r["doc_id"] == first]


def plain_mixing(rows, marks):
    """Copies by exponentially tilted rates, solved by halving; rounding and choice as the operator words them."""
    size = {r["doc_id"]: len((r["text"] or "").encode().split()) for r in rows}
    sources = {}
    for r in rows:
        sources.setdefault(r["source"], []).append(r)
    goal = targets({s: sum(size[r["doc_id"]] for r in part) for s, part in sources.items()}, MIX_WEIGHTS, MIX_SHARE, MIX_CAP)
    out = []
    for source, part in sources.items():
        classes = {}
        for r in part:
            classes.setdefault(size[r["doc_id"]], []).append(r)
        total, target = sum(size[r["doc_id"]] for r in part), goal[source]
        scale = total / len(part) or 1.0

        def rate(n, dual):
            return 1.0 if n == 0 else min(MIX_CAP, math.exp(min(dual * n / scale, 50.0)))  # noqa: B023

        low, high = -1e6, 1e6
        for _ in range(300):
            dual = (low + high) / 2
            low, high = (dual, high) if sum(n * len(c) * rate(n, dual) for n, c in classes.items()) < target else (low, dual)
        if target >= total * MIX_CAP * (1 - 1e-12):
            dual = float("inf")
        copies, carried = {}, 0.0
        for n in sorted(classes, reverse=True):
            docs, r = len(classes[n]), float(MIX_CAP) if dual == float("inf") and n else rate(n, dual)
            before, carried = carried, carried + docs * (r - math.floor(r))
            copies[n] = min(MIX_CAP * docs, docs * math.floor(r) + math.floor(carried + 0.5) - math.floor(before + 0.5))
        for _ in range(2):
            gap = target - sum(n * c for n, c in copies.items())
            room = {n: MIX_CAP * len(classes[n]) - c if gap > 0 else c for n, c in copies.items()}
            steps = {n: min(room[n], math.floor(abs(gap) / n + 0.5)) if n else 0 for n in copies}
            left, n = min((abs(abs(gap) - steps[n] * n), n) for n in copies)
            if left < abs(gap):
                copies[n] += (1 if gap > 0 else -1) * steps[n]
        for n, part_of in classes.items():
            base, extra = divmod(copies[n], len(part_of))
            for i, r in enumerate(sorted(part_of, key=lambda r: marks(r["doc_id"], r["text"]) & (1 << 64) - 1)):
                out += [r] * (base + (i < extra))
    return out


def test_run(spark, folder):
    """The rows of run() against a plain-Python version of the five stages."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    rows = [{c: r[c] for c in ("doc_id", "text", "source")} for r in docs.collect()]
    kept = plain_simhash(plain_line_dedup(plain_toxicity(rows, model)))
    hashed = spark.createDataFrame([(r["doc_id"], r["text"]) for r in kept], "doc_id long, text string")
    marks = {(r[0], r[1]): r[2] for r in hashed.select("doc_id", "text", F.xxhash64("doc_id", "text")).collect()}
    want = []
    for r in plain_mixing(kept, lambda *key: marks[key]):
        ids = LIB.encode(r["text"] or "", add_eos=True)
        want.append((r["doc_id"], r["source"], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(LIB.decode(ids).encode()).hexdigest()))
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == ["doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == Counter(want)
    assert len(want) > len(rows) / 2


def test_registered():
    import __spark_entry__ as entry
    names = entry.queries()
    assert "pipeline" in names and sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")
                                          and n[2].isdigit()) == list(range(1, 14))
    assert os.path.exists(os.path.join(os.path.dirname(entry.__file__), "corpus_pipeline.py"))
