"""Hashed n-gram features and logistic regression, shared by the classifiers.

A document becomes an array of feature numbers, one for each occurrence of an
n-gram; its score is the bias plus the mean weight over each family of
occurrences, a sparse dot product with relative frequencies.  Models are fitted
in one task on a bounded sample of labelled rows (the bound is a parameter) and
are as large as the hash space, so they may be sent to every task.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Features are numbered in 2 ** BITS.
BITS = 18
#: Labelled rows that a model is fitted on at most.
TRAIN_ROWS = 4000
#: Words whose hashes a worker keeps.
KEPT_WORDS = 1 << 19

_MASK = np.uint32((1 << BITS) - 1)
_RUNS = re.compile(r"([A-ZÀ-ÞА-Я]+)|([a-zß-ÿа-я]+)|([0-9]+)|(.)\4*", re.DOTALL)
#: Marks that are taken off the ends of a word.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words_of(text: str) -> list[str]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text."""
    return [w for w in _SPACE.split(text) if w]


def shape(word: str) -> str:
    """Kinds of characters in the word, each run once: ``Word***`` is ``Xx*``."""
    return "".join("X" if m[1] else "x" if m[2] else "9" if m[3] else m[4] for m in _RUNS.finditer(word))


class WordHashes:
    """Hashes of words and of their shapes, kept for the words seen last."""

    def __init__(self) -> None:
        self.kept: dict[str, int] = {}

    def _make(self, word: str) -> int:
        core = word.lower().strip(MARKS)
        packed = crc32(core.encode()) << 32 | crc32(shape(word).encode())
        if len(word) <= 64:
            if len(self.kept) >= KEPT_WORDS:
                self.kept.clear()
            self.kept[word] = packed
        return packed

    def of(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """32-bit hashes of the words (lower case, without marks around) and of their shapes."""
        get, make = self.kept.get, self._make
        packed = np.fromiter([get(w) or make(w) for w in words], dtype=np.uint64, count=len(words))
        return (packed >> np.uint64(32)).astype(np.uint32), packed.astype(np.uint32)


def number(word: str, salt: int) -> int:
    """Feature number of one word."""
    return crc32(word.encode(), salt) & int(_MASK)


def grams(hashes: np.ndarray, n: int, salt: int) -> np.ndarray:
    """Feature numbers of the n-grams of a sequence of hashes."""
    size = hashes.size - n + 1
    if size <= 0:
        return np.zeros(0, dtype=np.uint32)
    with np.errstate(over="ignore"):
        h = np.full(size, salt * 0x9E3779B1 & 0xFFFFFFFF, dtype=np.uint32)
        for i in range(n):
            h = (h ^ hashes[i:i + size]) * np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(15)
    return h & _MASK


def sparse(families: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features and their values: relative frequencies within each family."""
    numbers = np.concatenate([f for f in families]) if families else np.zeros(0, dtype=np.uint32)
    parts = np.concatenate([np.full(f.size, 1.0 / max(f.size, 1)) for f in families]) if families else np.zeros(0)
    at, back = np.unique(numbers, return_inverse=True)
    return at.astype(np.int32), np.bincount(back, weights=parts, minlength=at.size).astype(np.float32)


def score(weights: np.ndarray, bias: float, families: Sequence[np.ndarray]) -> float:
    """Log-odds: the sparse dot product of the weights and the document."""
    return bias + sum(float(weights[f].mean()) for f in families if f.size)


def sigmoid(x: np.ndarray | float) -> np.ndarray | float:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


class Ftrl:
    """Logistic regression by follow-the-regularised-leader updates (proximal, per coordinate)."""

    def __init__(self, size: int, alpha: float = 6.0, beta: float = 1.0, l1: float = 1e-3, l2: float = 1e-2):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)  # the last is the bias
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= self.l1, 0.0,
                        -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def update(self, at: np.ndarray, x: np.ndarray, y: float, scale: float = 1.0) -> None:
        w = self.weights(at)
        g = scale * (sigmoid(float(w @ x)) - y) * x
        n = self.n[at]
        more = n + g * g
        self.z[at] += g - (np.sqrt(more) - np.sqrt(n)) / self.alpha * w
        self.n[at] = more

    def fit(self, rows: Sequence[tuple[np.ndarray, np.ndarray]], y: np.ndarray, passes: int, seed: int) -> "Ftrl":
        """``passes`` over the rows in a seeded order."""
        bias = np.array([self.z.size - 1], dtype=np.int32)
        order = np.random.default_rng(seed)
        for _ in range(passes):
            for i in order.permutation(len(rows)):
                at, x = rows[i]
                self.update(np.concatenate([at, bias]), np.append(x, 1.0), float(y[i]))
        return self

    def model(self) -> tuple[np.ndarray, float]:
        w = self.weights(slice(None))
        return w[:-1].astype(np.float32), float(w[-1])


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from: crc32 of the id as text leaves 2 modulo 4 (a null id never does)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, marks: Sequence[str], rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id, text`` and the ``marks`` of at most ``rows`` labelled documents that are not held out.

    The rows with the smallest hashes of their id are taken, so reruns agree.
    Rows without an id or with a null among the marks teach nothing; of
    several rows with one id the smallest marks and text count.
    """
    known = (labels.filter(~held_out(F.col("doc_id"))).dropna(subset=["doc_id", *marks])
             .groupBy("doc_id").agg(*[F.min(m).alias(m) for m in marks])
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return (texts.join(F.broadcast(known), "doc_id")  # ``rows`` rows
            .groupBy("doc_id", *marks).agg(F.min("text").alias("text")))


def fitted(sample: DataFrame, fit: Callable[[pd.DataFrame], bytes]) -> bytes:
    """The model that ``fit`` makes of the bounded sample in one task (empty bytes: no labelled row)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if parts:
            rows = pd.concat(parts, ignore_index=True)
            yield pd.DataFrame({"model": [fit(rows.sort_values("doc_id", ignore_index=True))]})

    got = sample.repartition(1).mapInPandas(run, "model binary").collect()
    return bytes(got[0][0]) if got else b""
