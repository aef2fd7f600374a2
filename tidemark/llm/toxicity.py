"""Toxicity by a classifier chain.

Categories are predicted one after the other.  Each has a linear model (logistic
regression by FTRL) over hashed words and word beginnings of the text, by how
often they occur (on a logarithmic scale), and over the probabilities of the categories
before it.  While training,
those probabilities come from models of other folds, so a later model learns
from predictions as good as it will be given, not from fitted labels.

The labels mark a document as toxic and as of low quality, which gives three
categories: ``toxic``; ``abusive``, toxic text in junk; and ``insulting``, toxic
text in otherwise clean prose.  A document is rejected if the chain gives any
category a probability of at least ``REJECT``.

The bar, the passes and the scale were chosen on out-of-fold predictions of the
training rows alone: ``REJECT`` is the lowest of the bars tried (0.1, 0.15 and so on) at
which at most 0.5% of their clean rows are rejected.
"""

from __future__ import annotations

import io
from collections import Counter
from collections.abc import Callable, Sequence
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import ngrams
from tidemark.llm.common import from_texts

CATEGORIES = ("toxic", "abusive", "insulting")
REJECT = 0.25
FOLDS, PASSES, SEED = 3, 10, 5
#: Lengths of word beginnings that are features, beside whole words.
BEGINNINGS = (4, 6)
#: Labelled rows that the chain is fitted on at most.
TRAIN_ROWS = 5000
#: Occurrences of a word that count: one might be chance, more are no surer than these.
OFTEN = 20
_CHAIN = 1 << ngrams.BITS  # first feature number of the earlier categories


class Features:
    """Feature numbers and values of a text, with the words seen last kept."""

    def __init__(self) -> None:
        self.kept: dict[str, tuple[int, ...]] = {}

    def _make(self, word: str) -> tuple[int, ...]:
        core = word.lower().strip(ngrams.MARKS)
        found = tuple({ngrams.number(core, 0), *(ngrams.number(core[:k], k) for k in BEGINNINGS if len(core) > k)}) \
            if core else ()
        if len(word) <= 64:
            if len(self.kept) >= ngrams.KEPT_WORDS // 4:
                self.kept.clear()
            self.kept[word] = found
        return found

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        get, make, often = self.kept.get, self._make, {}
        for word, n in Counter(ngrams.words_of(text)).items():
            found = get(word)
            for at in make(word) if found is None else found:
                often[at] = often.get(at, 0) + n
        values = np.fromiter(often.values(), dtype=np.float32, count=len(often))
        return np.fromiter(often, dtype=np.int32, count=len(often)), 1 + np.log(np.minimum(values, np.float32(OFTEN)))


Row = tuple[np.ndarray, np.ndarray]


def _learn(x: Sequence[Row], earlier: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    chain = np.arange(_CHAIN, _CHAIN + earlier.shape[1], dtype=np.int32)
    rows = [(np.concatenate([at, chain]), np.concatenate([often, p.astype(np.float32)]))
            for (at, often), p in zip(x, earlier, strict=True)] if chain.size else x
    model = ngrams.Ftrl(_CHAIN + len(CATEGORIES), alpha=1.0, l1=6.0, l2=0.1)
    return model.fit(rows, y, PASSES, SEED).model()


def _probability(model: tuple[np.ndarray, float], x: Sequence[Row], earlier: np.ndarray) -> np.ndarray:
    weights, bias = model
    words = np.array([weights[at] @ often for at, often in x], dtype=float)
    return ngrams.sigmoid(bias + words + earlier @ weights[_CHAIN:_CHAIN + earlier.shape[1]])


def _fit(rows: pd.DataFrame) -> bytes:
    features = Features()
    x = [features.of(t) for t in rows.pop("text")]
    del features
    fold = np.random.default_rng(SEED).integers(0, FOLDS, len(x))
    earlier, models = np.zeros((len(x), 0)), []
    for category in CATEGORIES:
        y = rows[category].to_numpy(dtype=float)
        models.append(_learn(x, earlier, y))
        out_of_fold = np.zeros(len(x))
        for k in range(FOLDS):
            inside, outside = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
            if inside.size and outside.size:
                part = _learn([x[i] for i in inside], earlier[inside], y[inside])
                out_of_fold[outside] = _probability(part, [x[i] for i in outside], earlier[outside])
        earlier = np.column_stack([earlier, out_of_fold])
    out = io.BytesIO()
    np.savez_compressed(out, weights=np.array([w for w, _ in models]), bias=np.array([b for _, b in models]))
    return out.getvalue()


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> bytes:
    """The chain, fitted on at most ``rows`` labelled rows that are not held out.

    Rows with a null label teach nothing.  Without a labelled row the chain is
    empty and rejects nothing.
    """
    marked = labels.select("doc_id", F.col("toxic").alias("toxic"),
                           F.when(F.col("quality") == 0, F.col("toxic")).otherwise(0).alias("abusive"),
                           F.when(F.col("quality") == 1, F.col("toxic")).otherwise(0).alias("insulting"))
    return ngrams.fitted(ngrams.labelled_sample(docs, marked, CATEGORIES, rows), _fit)


def _scored(model: bytes) -> Callable[[list[str]], list[np.ndarray]]:
    features = Features()
    if model:
        with np.load(io.BytesIO(model)) as kept:
            models = [(w, float(b)) for w, b in zip(kept["weights"], kept["bias"], strict=True)]
    else:
        models = [(np.zeros(_CHAIN + len(CATEGORIES), dtype=np.float32), -10.0)] * len(CATEGORIES)

    def run(texts: list[str]) -> list[np.ndarray]:
        x, earlier = [features.of(t) for t in texts], np.zeros((len(texts), 0))
        for one in models:
            earlier = np.column_stack([earlier, _probability(one, x, earlier)])
        return list(earlier.T)

    return run


def detect(docs: DataFrame, model: bytes, keep: Sequence[str], text: str = "text",
           threshold: float = REJECT) -> DataFrame:
    """The columns ``keep``, a probability ``p_<category>`` for each category, and ``rejected``.

    Whole texts are scored; null and empty texts by the biases alone.  Nothing
    but the text is an input.  Rows are independent of each other.
    """
    names = [f"p_{c}" for c in CATEGORIES]
    made = from_texts(docs, text, keep, dict.fromkeys(names, "double"), partial(_scored, model))
    return made.withColumn("rejected", F.greatest(*names) >= threshold)
