"""Corpus preparation: five stages over ``documents``, each on all that the one before kept.

Toxic documents go; repeated lines go; one document of each near-duplicate
group stays; documents are copied or left out until sources reach their target
weights; the rest is encoded, and decoded to check.  Every stage but the last
returns the columns of ``documents``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import line_dedup, mixing, simhash, tokenizing, toxicity
from tidemark.llm.common import fresh, table, word_count
from tidemark.llm.queries import MIX_CAP, MIX_SHARE, MIX_WEIGHTS, MODEL_FILE, SHINGLE_WORDS
from tidemark.session import checkpoint_root

#: Columns that stages read or write; all others are carried under names that clash with nothing.
USED = ("doc_id", "text", "source", "n_chars")


#: Rows of an Arrow batch: whole documents are large, and batches in both directions lie beside the heap.
BATCH_ROWS = 512


def carried(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The stage, with the other columns renamed before it and named back after."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        named = {c: f"carried_{i}" for i, c in enumerate(docs.columns) if c not in USED}
        out = stage(spark, docs.withColumnsRenamed(named), sf_dir)
        return out.withColumnsRenamed({v: k for k, v in named.items()}).select(*docs.columns)
    return run_stage


@carried
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity chain does not reject, as they are."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.detect(docs, model, docs.columns).filter(~F.col("rejected")).select(*docs.columns)


@carried
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, short ones too, without the lines that the corpus has before; ``n_chars`` follows the text."""
    return line_dedup.dedup_lines(docs, short=True).withColumn(
        "n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


@carried
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.one_of_each(docs, SHINGLE_WORDS)


@carried
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it."""
    mixed = mixing.mix(docs, F.col("source"), word_count(F.col("text")), F.xxhash64("doc_id", "text"),
                       MIX_WEIGHTS, MIX_SHARE, MIX_CAP)
    (copy,) = fresh(mixed.columns, "copy")
    return mixed.withColumn(copy, F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of the ids of each kept text, and digest of what they decode to."""
    return tokenizing.tokenize(docs, MODEL_FILE, ["doc_id", "source"], ["n_tokens", "ids_sha256", "decoded_sha256"])


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash", drop_near_duplicates),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

#: Learned and hashed stages have no SQL form; the tests hold run()'s rows against a plain-Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet under the shared folder and read again."""
    docs, folder = table(spark, sf_dir, "documents"), f"{checkpoint_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
