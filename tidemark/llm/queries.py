"""Registered queries of the package: ``name -> (spark, sf_dir) -> DataFrame``.

Each applies its operator, with production parameters, to its whole table and
derives the digest columns of its contract.
"""

from __future__ import annotations

import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import (lexical, licenses, line_dedup, merkle, mixing, ngrams, quality, rules, sharding, simhash, tokenfile,
                          tokenizing, topk, toxicity)
from tidemark.llm.common import table, word_count
from tidemark.session import scratch_path

MIX_WEIGHTS, MIX_SHARE, MIX_CAP = (3, 1, 2), 1.5, 2
MODEL_FILE = public_tokenizers.path("piece_bpe_32k.model")
BYTE_MODEL, END_ID = public_tokenizers.path("byte_bpe_50k.json"), 2
SHINGLE_WORDS = 3
SHARDS, SHARD_SEED = 16, 20240229


def op1_source_mixing(spark, d):
    """Words that an entropy-balanced mix takes from every document."""
    docs = table(spark, d, "documents").select(
        "doc_id", "source", word_count(F.col("text")).alias("size"),
        F.xxhash64("doc_id", "text").alias("mark"))
    mixed = mixing.mix(docs, F.col("source"), F.col("size"), F.col("mark"), MIX_WEIGHTS, MIX_SHARE, MIX_CAP)
    return mixed.select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


def op2_line_dedup(spark, d):
    """Every document without the lines of windows that the corpus has before."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs)


def op3_sentencepiece(spark, d):
    """Number and digest of every document's SentencePiece ids, and digest of what they decode to."""
    return tokenizing.tokenize(table(spark, d, "documents"), MODEL_FILE, ["doc_id"],
                               ["n_tokens", "ids_sha256", "decoded_sha256"])


def op4_simhash(spark, d):
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, d, "documents"), SHINGLE_WORDS)
    return found.select("doc_id", simhash.hex16(F.col("bits")).alias("fingerprint"), "component_id")


def op5_topk_search(spark, d):
    """The 5 vectors of the largest integer inner product with every 50th vector."""
    vectors = (table(spark, d, "embeddings").select("vec_id", topk.scaled(F.col("embedding"), 256).alias("v"))
               .filter("vec_id is not null and v is not null"))
    queries = vectors.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    return topk.top_k(vectors, queries, 5)


def op6_quality_classifier(spark, d):
    """Quality score of every document."""
    docs = table(spark, d, "documents")
    model = quality.train(docs, table(spark, d, "labels"))
    return (quality.score(docs, model, ["doc_id"])
            .select("doc_id", ngrams.held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= 0.7).cast("int").alias("predicted")))


def op7_feistel_sharding(spark, d):
    """Shard and slot of every document in a reproducible global shuffle."""
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = table(spark, d, "documents").select(
        "doc_id", (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
    placed = sharding.shard_rows(rows, ["doc_id", "text_crc32", "size"], SHARDS, SHARD_SEED)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op8_quality_rules(spark, d):
    """Rule counts of every document and the calibrated classifier's verdict on it."""
    docs = table(spark, d, "documents")
    model = rules.train(docs, table(spark, d, "labels"))
    return rules.judge(docs, model, ["doc_id"])


def op9_toxicity(spark, d):
    """Probabilities of the toxicity categories of every document, and whether it is rejected."""
    docs = table(spark, d, "documents")
    model = toxicity.train(docs, table(spark, d, "labels"))
    return toxicity.detect(docs, model, ["doc_id"])


def op10_license_scan(spark, d):
    """License notices in every document, with coverage and span."""
    found = licenses.scan_licenses(table(spark, d, "documents"), ["doc_id"])
    return found.select("doc_id", F.size("licenses").alias("n_licenses"), "licenses")


def op11_lexical_search(spark, d):
    """The 20 documents that score highest for each benchmark item."""
    return lexical.search(table(spark, d, "documents"), table(spark, d, "benchmark"), 20)


def op12_merkle_manifest(spark, d):
    """Leaf, roots and proof of every document, checked against a copy in which some texts were tampered with."""
    docs, fields = table(spark, d, "documents"), ("doc_id", "source", "lang", "n_chars", "text")
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0,
                     merkle.leaf([lower if c == "text" else F.col(c) for c in fields]))
    made = merkle.manifest(docs, fields, "lang", ["doc_id"], ["doc_id"], {"changed": changed})
    folded = made.withColumn("folded_root", merkle.fold(F.coalesce("changed", "leaf"), F.col("path")))
    return folded.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_token_files(spark, d):
    """Every document's place, number and checksum of ids, read back from the token files written of the table."""
    path = scratch_path(spark, "tokens")
    tokenfile.write_tokens(table(spark, d, "documents"), BYTE_MODEL, END_ID, path)
    return tokenfile.with_crc32(tokenfile.read_tokens(spark, path), ["doc_id", "start", "n_tokens"])


QUERIES: dict[str, Callable[..., DataFrame]] = {f.__name__: f for f in (
    op1_source_mixing, op2_line_dedup, op3_sentencepiece, op4_simhash, op5_topk_search,
    op6_quality_classifier, op7_feistel_sharding, op8_quality_rules, op9_toxicity, op10_license_scan,
    op11_lexical_search, op12_merkle_manifest, op13_token_files)}
