import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import tokenizing
from tidemark.llm.queries import MODEL_FILE, op3_sentencepiece

SF = "/root/testdata/sf0.001"
LIB = sentencepiece.SentencePieceProcessor(model_file=MODEL_FILE)
OWN = tokenizing.encoder(MODEL_FILE)


def same(text):
    ids = LIB.encode(text, add_eos=True)
    assert OWN.encode(text) == ids
    assert OWN.decode(ids) == LIB.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcdeinorstthé ▁ .,!\n\t0漢\U0001F600\x00"), max_size=60))
def test_any_text(text):
    same(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=40))
def test_any_characters(text):
    same(text)


def test_runs_of_spaces():
    for n in range(120):
        for text in (" " * n, "a" + " " * n + "b", " " * n + "é", " " * n + "\x01"):
            same(text)


def test_small_memory(monkeypatch):
    """Dropping kept words and pairs changes nothing."""
    monkeypatch.setattr(tokenizing, "KEPT_WORDS", 3)
    own = tokenizing.PieceEncoder(MODEL_FILE)
    pick = random.Random(3)
    for _ in range(100):
        text = " ".join(pick.choice(["the", "thering", "ofan", "  x", "eau.", "été"]) for _ in range(30))
        assert own.encode(text) == LIB.encode(text, add_eos=True)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 31999), max_size=12))
def test_decode_any_ids(ids):
    ids = [i for i in ids if i > 2]
    assert OWN.decode(ids) == LIB.decode(ids)


def test_query(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op3_sentencepiece(spark, SF).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    for r in rows:
        ids = LIB.encode(texts[r["doc_id"]], add_eos=True)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(LIB.decode(ids).encode()).hexdigest()


def test_awkward_rows(docs_of, awkward):
    docs = docs_of(awkward, {"ids": F.lit("mine"), "body": F.lit(1)})
    rows = tokenizing.tokenize(docs, MODEL_FILE, docs.columns).collect()
    assert len(rows) == len(awkward)
    for r in rows:
        assert r["ids"] == LIB.encode(r["text"] or "", add_eos=True) and r["body"] == 1
        assert r["decoded"] == LIB.decode(r["ids"])
    assert tokenizing.tokenize(docs_of([]), MODEL_FILE, ["doc_id"]).collect() == []


def test_other_models_are_refused():
    with pytest.raises(Exception):
        tokenizing.PieceEncoder(public_tokenizers.path("byte_bpe_50k.json"))
