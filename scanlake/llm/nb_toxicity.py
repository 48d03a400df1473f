"""Toxicity: linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Training counts in how many texts of either class an n-gram occurs; the log of the ratio of the smoothed shares scales the
feature, and a logistic regression is trained on the scaled features that tell the classes apart. The learned weight and
the ratio are multiplied into one table, so that scoring is a sum over the distinct n-grams of a text.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame

from scanlake.llm import features

#: Labelled rows of each class that training takes at most.
PER_CLASS = 2500
ORDERS = (4, 5, 6)
BITS = 20
THRESHOLD = 0.7
#: Least number of training texts with a feature, and least absolute log ratio, for it to be used.
LEAST_TEXTS = 4
LEAST_RATIO = 2.0
EPOCHS = 300
L2 = 4e-4


def _points(texts: list[str]):
    """Lower-cased code points; whatever is no letter is a space."""
    points, offsets = features.code_points([t.lower() for t in texts])
    return np.where(_letters()[np.minimum(points, 0x24F)], points, np.uint32(32)), offsets


def _letters() -> np.ndarray:
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.array([chr(i).isalpha() for i in range(0x24F)] + [True])
    return _LETTERS


_LETTERS = None


def distinct_features(text: str) -> np.ndarray:
    points, offsets = _points([text])
    return np.unique(np.concatenate(list(features.ngram_features(points, offsets, ORDERS, BITS))))


def fit(pairs: Iterable[tuple[str, int]]) -> bytes:
    """The weight table (float32, 2**BITS entries, then the bias) learned from (text, target) pairs."""
    present, targets = [], []
    counts = np.zeros((2, 1 << BITS), np.int32)
    for text, target in pairs:
        ids = distinct_features(text)
        counts[target, ids] += 1
        present.append(ids)
        targets.append(target)
    y = np.array(targets, np.float64)
    table = np.zeros((1 << BITS) + 1, np.float32)
    n = np.array([(y == 0).sum(), (y == 1).sum()], np.float64)
    if not n.all():
        table[-1] = -20.0 if n[1] == 0 else 20.0  # one class only: its prior
        return table.tobytes()
    share = (counts + 1.0) / (n + 2.0)[:, None]
    ratio = np.log(share[1] / share[0])
    used = (counts.sum(0) >= LEAST_TEXTS) & (np.abs(ratio) >= LEAST_RATIO)
    number = np.cumsum(used) - 1
    rows = [number[ids[used[ids]]] for ids in present]
    sizes = np.array([len(r) for r in rows])
    columns = np.concatenate(rows) if len(rows) else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), sizes)
    weight = _logistic(columns, owner, ratio[used], y)
    table[:-1][used] = weight[:-1] * ratio[used]
    table[-1] = weight[-1]
    return table.tobytes()


def _logistic(columns, owner, scale, y) -> np.ndarray:
    """Weights of the scaled features and a bias, by gradient descent with momentum; classes count alike."""
    w = np.full(len(scale) + 1, 0.02)
    w[-1] = -1.0
    speed = np.zeros_like(w)
    cost = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    for _ in range(EPOCHS):
        z = np.bincount(owner, w[columns] * scale[columns], len(y)) + w[-1]
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * cost
        gradient = np.append(np.bincount(columns, error[owner], len(scale)) * scale, error.sum())
        gradient[:-1] += L2 * w[:-1]
        speed = 0.9 * speed - 0.5 * gradient
        w = w + speed
    return w


def scores(table: np.ndarray, texts: list[str]) -> np.ndarray:
    """Score of each text: the logistic of the summed weights of its distinct n-grams."""
    weights, bias = table[:-1], table[-1]
    points, offsets = _points(texts)
    totals = np.full(len(texts), float(bias))
    owners, found = [], []
    for n, ids in zip(ORDERS, features.ngram_features(points, offsets, ORDERS, BITS), strict=True):
        at = np.flatnonzero(weights[ids])
        owner = np.searchsorted(offsets, at, side="right") - 1
        whole = (owner < len(texts)) & (at + n <= offsets[np.minimum(owner + 1, len(texts))] + 1)
        owners.append(owner[whole])
        found.append(ids[at[whole]])
    keys = np.unique(np.concatenate(owners).astype(np.int64) << BITS | np.concatenate(found))
    totals += np.bincount(keys >> BITS, weights[keys & ((1 << BITS) - 1)], len(texts))
    return 1 / (1 + np.exp(-np.clip(totals, -500, 500)))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS) -> np.ndarray:
    """The table learned from a bounded sample of labelled rows; the text alone is an input."""
    return np.frombuffer(features.fitted(features.training_rows(docs, labels, label, per_class), fit), np.float32)


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, per_class: int = PER_CLASS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``, repeated rows too.

    Empty and null texts get the bias's score. Without labels of both classes the score is near 0 (no toxic example) or near 1.
    Whole texts are scored; other columns are ignored. The table has a fixed size and is broadcast.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, per_class=per_class))
    return features.scored(docs, lambda texts: scores(model.value, texts), threshold)
