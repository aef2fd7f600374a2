"""Quality classifier: hashed word n-gram logistic regression, fitted by FTRL.

Features are n-grams of words (1 and 2, lower case, without marks around them)
and of word shapes (1 to 3, where a word equal to the one before has a shape of
its own), hashed into ``2 ** BITS`` weights.  A score is a sparse dot product.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Sequence
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from tidemark.llm import ngrams
from tidemark.llm.common import from_texts

PASSES, SEED = 4, 7
_AGAIN = np.uint32(0x5BD1E995)  # shape of a word equal to the one before


def families(hashes: ngrams.WordHashes, text: str) -> list[np.ndarray]:
    """Feature numbers of the whole text, one array for each kind of n-gram."""
    words, shapes = hashes.of(ngrams.words_of(text))
    shapes = shapes.copy()
    if words.size > 1:
        shapes[1:][(words[1:] == words[:-1]) & (shapes[1:] == shapes[:-1])] = _AGAIN
    return [ngrams.grams(words, 1, 1), ngrams.grams(words, 2, 2), ngrams.grams(shapes, 1, 3),
            ngrams.grams(shapes, 2, 4), ngrams.grams(shapes, 3, 5)]


def _fit(label: str, rows: pd.DataFrame) -> bytes:
    hashes = ngrams.WordHashes()
    x = [ngrams.sparse(families(hashes, t)) for t in rows.pop("text")]
    weights, bias = ngrams.Ftrl(1 << ngrams.BITS).fit(x, rows[label].to_numpy(dtype=float), PASSES, SEED).model()
    out = io.BytesIO()
    np.savez_compressed(out, weights=weights, bias=bias)
    return out.getvalue()


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = ngrams.TRAIN_ROWS) -> bytes:
    """The model of ``label`` (0 or 1), fitted on at most ``rows`` labelled rows that are not held out.

    Without a labelled row the model is empty and every score is 0.5.
    """
    return ngrams.fitted(ngrams.labelled_sample(docs, labels, [label], rows), partial(_fit, label))


def _scored(model: bytes) -> Callable[[list[str]], list[np.ndarray]]:
    hashes = ngrams.WordHashes()
    if model:
        with np.load(io.BytesIO(model)) as kept:
            weights, bias = kept["weights"], float(kept["bias"])
    else:
        weights, bias = np.zeros(1 << ngrams.BITS, dtype=np.float32), 0.0
    return lambda texts: [ngrams.sigmoid(np.array(
        [ngrams.score(weights, bias, families(hashes, t)) for t in texts], dtype=float))]


def score(docs: DataFrame, model: bytes, keep: Sequence[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` and ``score`` (0 to 1, higher: label 1 likelier) of every whole text.

    Null and empty texts score by the bias alone.  Nothing but the text is an input.
    """
    return from_texts(docs, text, keep, {"score": "double"}, partial(_scored, model))
