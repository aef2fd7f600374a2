from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import tokenfile
from tidemark.llm.common import table
from tidemark.llm.queries import BYTE_MODEL, END_ID, op13_token_files

SF = "/root/testdata/sf0.001"
LIB = Tokenizer.from_file(BYTE_MODEL)
OWN = tokenfile.encoder(BYTE_MODEL)


def ids_of(text):
    return LIB.encode(text or "", add_special_tokens=False).ids


def same(text):
    assert np.frombuffer(OWN.encode(text), "<i4").tolist() == ids_of(text)


def crc(ids):
    return crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=st.sampled_from("abst é'.,!\n\t\r0 \xa0\x1c\x85　漢\U0001F600ß<|>"), max_size=40))
def test_any_text(text):
    same(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=30))
def test_any_characters(text):
    same(text)


def test_special_tokens_and_marks():
    for text in ("a <|endoftext|> b", "x  <|endoftext|>", "don't 't, 'll. I'd", "ÀÿßéÅ. Ünïcode!?", "a​b \x00 \x7f", ""):
        same(text)


def test_white_space_is_never_a_word():
    """A run of white space met once is not taken for the start of a line later."""
    for text in ("0 \xa0\xa0 x", "\xa0", "\t", "\u3000 a", "0\n\xa0", "0\n\t", "a\n\u3000", " \n \n", "a b\n\n c"):
        same(text)


def test_small_memory(monkeypatch):
    monkeypatch.setattr(tokenfile, "KEPT_PARTS", 3)
    own = tokenfile.PartEncoder(BYTE_MODEL)
    text = " ".join(["the", "été,", "thering.", "", "\n", "of"] * 20)
    assert np.frombuffer(own.encode(text), "<i4").tolist() == ids_of(text)


def brute(rows):
    """(doc_id, start, n_tokens, ids_crc32) of (doc_id, text) rows; equal ids in the order given."""
    out, start = [], 0
    for i, text in rows:
        ids = [*ids_of(text), END_ID]
        out.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    return out


def test_query(spark):
    rows = sorted(tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect())
    got = op13_token_files(spark, SF).collect()
    assert sorted(tuple(r) for r in got) == brute(rows)


def test_awkward_rows(spark, docs_of, awkward, scratch):
    docs = docs_of(awkward, {"start": F.lit("mine"), "_text": F.lit(1), "_hash": F.lit(2)})
    tokenfile.write_tokens(docs, BYTE_MODEL, END_ID, scratch, files=3)
    rows = tokenfile.read_tokens(spark, scratch).orderBy("start").collect()
    assert sorted(((r["doc_id"] is not None, r["doc_id"]) for r in rows), key=str) == \
        sorted(((i is not None, i) for i, _ in awkward), key=str)
    seen = [r["doc_id"] for r in rows]
    assert seen == sorted(seen, key=lambda i: (i is not None, i or 0))
    at, texts = 0, sorted([(str(i), tuple(ids_of(t)) + (END_ID,)) for i, t in awkward])
    for r in rows:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        at += r["n_tokens"]
    assert sorted((str(r["doc_id"]), tuple(r["ids"])) for r in rows) == texts
    with pytest.raises(ValueError):
        tokenfile.write_tokens(docs.withColumn("ids", F.lit(1)), BYTE_MODEL, END_ID, f"{scratch}-2", keep=["ids"])


def test_empty(spark, docs_of, scratch):
    tokenfile.write_tokens(docs_of([]), BYTE_MODEL, END_ID, scratch)
    assert tokenfile.read_tokens(spark, scratch).collect() == []
    assert tokenfile.read_span(spark, scratch, 0, 10).collect() == []


def test_hot_rows(spark, docs_of, scratch):
    """Equal rows are spread over the files."""
    docs = docs_of([(5, "the same text")] * 3000 + [(6, "other")])
    tokenfile.write_tokens(docs, BYTE_MODEL, END_ID, scratch, files=4)
    assert spark.read.parquet(f"{scratch}/parts").count() == 4
    rows = tokenfile.read_tokens(spark, scratch, ids=False)
    assert rows.agg(F.count("*"), F.count_distinct("start")).first() == (3001, 3001)


@pytest.fixture(scope="module")
def written(spark):
    from tidemark.session import scratch_path
    path = scratch_path(spark, "tests")
    with pytest.MonkeyPatch.context() as m:
        m.setattr(tokenfile, "PAGE_ROWS", 8)
        docs = table(spark, SF, "documents")
        tokenfile.write_tokens(docs, BYTE_MODEL, END_ID, path, keep=["doc_id", "lang"], files=3)
    whole = [i for r in tokenfile.read_tokens(spark, path).orderBy("start").collect() for i in r["ids"]]
    return path, whole


@pytest.mark.parametrize("first, stop", [(0, 1), (0, 10**9), (500, 501), (1000, 9000), (7, 7), (9, 3), (20_000, 50_000)])
def test_spans(spark, written, first, stop):
    path, whole = written
    rows = tokenfile.read_span(spark, path, first, stop).orderBy("start").collect()
    assert [i for r in rows for i in r["ids"]] == whole[first:stop] if first < stop else rows == []


def test_layout(spark, written):
    """Encodings, page index, and what selective reads read."""
    from pathlib import Path
    path, _ = written
    files = [pq.ParquetFile(f) for f in Path(path.removeprefix("file:"), "tokens").glob("*.parquet")]
    assert len(files) == 3
    for f in files:
        group = f.metadata.row_group(0)
        columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
        ids = next(c for name, c in columns.items() if name.startswith("ids"))
        assert "RLE_DICTIONARY" in ids.encodings and "DELTA_BINARY_PACKED" in columns["before"].encodings
        assert all(c.has_offset_index and c.has_column_index for c in columns.values())
    plan = tokenfile.read_tokens(spark, path, ids=False)._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema")[1].split("\n")[0]
    one = tokenfile.read_tokens(spark, path).filter("doc_id = 17")
    assert "EqualTo(doc_id,17)" in one._jdf.queryExecution().executedPlan().toString() and one.count() == 1


def test_others_are_refused():
    with pytest.raises(ValueError):
        tokenfile.PartEncoder(public_tokenizers.path("word_bpe_49k.json"))
