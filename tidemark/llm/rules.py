"""Quality rules: counts of the whole text, and a calibrated n-gram classifier.

The base rules count words, symbols, repeated lines and repeated three-word
windows.  The verdict on what they pass comes from a logistic regression over
hashed word n-grams (1, 2) and character n-grams (3 and 5 code points), fitted
on labelled quality rows; its log-odds are calibrated to probabilities on rows
that the weights have not seen (Platt scaling), and a fixed threshold decides.
"""

from __future__ import annotations

import io
import re
from collections.abc import Callable, Sequence
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import ngrams
from tidemark.llm.common import from_texts

MIN_WORDS = 50
#: Share of words in repeated windows, in hundredths, above which a text fails.
MOST_REPEATED = 50
#: Calibrated probability of good quality from which a text is kept.
KEEP = 0.5
#: Share of the sample that calibrates and does not train.
CALIBRATE = 0.25
#: Labelled rows that weights and calibration are fitted on at most.
TRAIN_ROWS = 3000
PASSES, SEED, WINDOW = 2, 11, 3

_SYMBOLS = re.compile(r"[#*$%&|<>]+")
_NOT_SPACE = re.compile(r"[^\x20\x09-\x0D]")


def repeated_words(words: Sequence[str], width: int = WINDOW) -> int:
    """Words in windows of ``width`` words that the text has twice or more, the first one included."""
    size = len(words) - width + 1
    if size < 2:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter([number.setdefault(w, len(number)) for w in words], dtype=np.int64, count=len(words))
    window = ids[:size]
    for i in range(1, width):  # numbers of the pairs, then of the triples: exact, and small enough to go on
        _, window = np.unique(window * np.int64(len(number)) + ids[i:i + size], return_inverse=True)
    again = np.bincount(window)[window] > 1
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(covered, np.flatnonzero(again), 1)
    np.add.at(covered, np.flatnonzero(again) + width, -1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


def base(text: str, words: Sequence[str]) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of the whole text."""
    lines = [x for x in text.split("\n") if _NOT_SPACE.search(x)]
    return (len(words), sum(map(len, words)), sum(map(len, _SYMBOLS.findall(text))),
            len(lines) - len(set(lines)), repeated_words(words))


def families(hashes: ngrams.WordHashes, text: str, words: Sequence[str]) -> list[np.ndarray]:
    """Feature numbers of the whole text, one array for each kind of n-gram."""
    of, _ = hashes.of(words)
    body = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    return [ngrams.grams(of, 1, 1), ngrams.grams(of, 2, 2), ngrams.grams(body, 3, 3), ngrams.grams(body, 5, 4)]


def platt(odds: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Scale and shift that make the log-odds probabilities: maximum likelihood with smoothed targets."""
    good, bad = float(y.sum()), float((1 - y).sum())
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = ngrams.sigmoid(a * odds + b)
        gap, w = p - target, p * (1 - p) + 1e-9
        grad = np.array([gap @ odds, gap.sum()])
        hess = np.array([[w @ (odds * odds), w @ odds], [w @ odds, w.sum()]]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        step /= max(1.0, float(np.abs(step).max()) / 2)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return a, b


def _fit(label: str, rows: pd.DataFrame) -> bytes:
    hashes = ngrams.WordHashes()
    y = rows[label].to_numpy(dtype=float)
    aside = np.random.default_rng(SEED).random(len(y)) < CALIBRATE
    if aside.all() or len(set(y[~aside])) < 2:
        aside[:] = False
    x = [ngrams.sparse(families(hashes, t, ngrams.words_of(t))) for t in rows.pop("text")]
    trained = [row for row, out in zip(x, aside, strict=True) if not out]
    weights, bias = ngrams.Ftrl(1 << ngrams.BITS).fit(trained, y[~aside], PASSES, SEED).model()
    of = aside if aside.any() else ~aside
    odds = np.array([bias + float(weights[at] @ part) for (at, part), used in zip(x, of, strict=True) if used])
    scale, shift = platt(odds, y[of])
    out = io.BytesIO()
    np.savez_compressed(out, weights=weights, bias=bias, scale=scale, shift=shift)
    return out.getvalue()


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS) -> bytes:
    """Weights and calibration, fitted on at most ``rows`` labelled rows that are not held out.

    Without a labelled row the model is empty and the classifier keeps every text.
    """
    return ngrams.fitted(ngrams.labelled_sample(docs, labels, [label], rows), partial(_fit, label))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _scored(model: bytes) -> Callable[[list[str]], list[Sequence]]:
    hashes = ngrams.WordHashes()
    if model:
        with np.load(io.BytesIO(model)) as kept:
            weights = kept["weights"]
            bias, scale, shift = (float(kept[k]) for k in ("bias", "scale", "shift"))
    else:
        weights, bias, scale, shift = np.zeros(1 << ngrams.BITS, dtype=np.float32), 0.0, 1.0, 0.0

    def run(texts: list[str]) -> list[Sequence]:
        counts, odds = [], []
        for text in texts:
            words = ngrams.words_of(text)
            counts.append(base(text, words))
            odds.append(ngrams.score(weights, bias, families(hashes, text, words)))
        columns = [list(c) for c in zip(*counts, strict=True)] or [[] for _ in COUNTS]
        return [*columns, ngrams.sigmoid(scale * np.array(odds, dtype=float) + shift)]

    return run


def judge(docs: DataFrame, model: bytes, keep: Sequence[str], text: str = "text",
          threshold: float = KEEP) -> DataFrame:
    """The columns ``keep``, the base counts (long), ``probability`` (double), ``base_failed`` and ``kept``.

    ``base_failed``: fewer than 50 words, or over half of the words in repeated
    windows.  ``kept`` is false if the base failed, else ``probability >=
    threshold``.  A null text counts as empty, and so fails the base.  Counts
    are of whole texts; nothing but the text is an input.
    """
    made = from_texts(docs, text, keep, {**dict.fromkeys(COUNTS, "bigint"), "probability": "double"},
                      partial(_scored, model))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return made.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("probability") >= threshold))
