"""Quality classifier: supervised subword embeddings averaged per document, softmax output, trained by numpy SGD.

Words and character n-grams are hashed to rows of one embedding matrix. A text is the mean of its features' vectors; a softmax over
two classes reads it. Both layers are learned by stochastic gradient descent. For scoring, embeddings and output layer are
multiplied out to one number per feature, which gives the same result as the two layers do.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from scanlake.llm import features
from scanlake.llm.arrow import map_batches, slices
from scanlake.llm.hashing import BASE, mix

#: Labelled rows of each class that training takes at most.
PER_CLASS = 2000
ORDERS = (2, 3, 4)
BITS = 18
DIM = 8
#: Steps of gradient descent, each over BATCH texts; small samples are gone through more often.
STEPS = 5000
RATE = 6.0
BATCH = 8
THRESHOLD = 0.5
#: The feature of a repeated word.
REPEATED = 0


def _word_ids(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature of each word (a run of characters above the space), or of its repetition, and its first position."""
    inside = points > 32
    starts = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
    ends = np.flatnonzero(inside & ~np.concatenate((inside[1:], [False]))) + 1
    if not len(starts):
        return starts.astype(np.int32), starts
    values = mix(points.astype(np.uint64) + np.uint64(BASE))
    place = (np.arange(len(points)) - np.repeat(np.append(0, starts), np.diff(np.append(np.append(0, starts), len(points))))).astype(np.uint64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * (place * np.uint64(2) + np.uint64(1)))))
    hashes = mix(sums[ends] - sums[starts])
    ids = (hashes >> np.uint64(64 - BITS)).astype(np.int32)
    # A word that repeats the one before it, in the same line, is the same feature whatever the word is.
    again = np.flatnonzero(hashes[1:] == hashes[:-1]) + 1
    again = again[points[starts[again] - 1] == 32]
    ids[again] = REPEATED
    return ids, starts


def text_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of a text and how often each occurs."""
    points, offsets = features.code_points([text])
    words, _ = _word_ids(points)
    parts = [*features.ngram_features(points, offsets, ORDERS, BITS), words]
    return np.unique(np.concatenate(parts), return_counts=True)


def fit(pairs: Iterable[tuple[str, int]]) -> bytes:
    """One float32 per feature (the difference of the two classes' outputs), then the difference of the biases."""
    rows, targets = [], []
    for text, target in pairs:
        ids, counts = text_features(text)
        rows.append((ids, (counts / counts.sum()).astype(np.float32)))
        targets.append(target)
    table = np.zeros((1 << BITS) + 1, np.float32)
    y = np.array(targets, np.int64)
    if not (len(y) and 0 < y.sum() < len(y)):
        table[-1] = 20.0 if len(y) and y.all() else -20.0 if len(y) else 0.0
        return table.tobytes()
    random = np.random.default_rng(7)
    vectors = ((random.random((1 << BITS, DIM)) - 0.5) / DIM).astype(np.float32)
    out = np.zeros((DIM, 2), np.float32)
    bias = np.zeros(2, np.float32)
    # Both classes count alike, so that 0.5 is the border whatever their shares in the sample are.
    cost = np.array([0.5 * len(y) / (y == 0).sum(), 0.5 * len(y) / (y == 1).sum()], np.float32)
    step = 0
    while step < STEPS:
        order = random.permutation(len(rows))
        for first in range(0, len(order), BATCH):
            rate = RATE * max(0.0, 1 - step / STEPS)
            step += 1
            batch = order[first : first + BATCH]
            hidden = np.stack([w @ vectors[ids] for ids, w in (rows[i] for i in batch)])
            z = hidden @ out + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(batch)), y[batch]] -= 1
            p *= cost[y[batch]][:, None] / len(batch)
            back = p @ out.T
            out -= np.float32(rate * 0.1) * (hidden.T @ p)
            bias -= np.float32(rate * 0.1) * p.sum(0)
            for i, g in zip(batch, back, strict=True):
                ids, w = rows[i]
                vectors[ids] -= np.float32(rate) * w[:, None] * g
    table[:-1] = vectors @ (out[:, 1] - out[:, 0])
    table[-1] = bias[1] - bias[0]
    return table.tobytes()


def scores(table: np.ndarray, texts: list[str]) -> np.ndarray:
    """Probability of label 1 for each text; a text without features has the bias's."""
    points, offsets = features.code_points(texts)
    weights = table[:-1]
    sums, number = features.ngram_sums(points, offsets, ORDERS, BITS, weights)
    words, starts = _word_ids(points)
    running = np.concatenate(([0.0], np.cumsum(weights[words], dtype=np.float64)))
    cuts = np.searchsorted(starts, offsets)
    sums += np.diff(running[cuts])
    number += np.diff(cuts)
    z = sums / np.maximum(1, number) + table[-1]
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> np.ndarray:
    """The table learned from a bounded sample of labelled rows; the text alone is an input."""
    return np.frombuffer(features.fitted(features.training_rows(docs, labels, label, per_class), fit), np.float32)


def score_quality(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",), per_class: int = PER_CLASS) -> DataFrame:
    """``keep``, ``held_out, score, predicted`` of every row of ``docs``, repeated rows too.

    Empty and null texts get the bias's score. Without labels of both classes all texts get one score: near 1 or near 0 by the
    class there is, 0.5 without labels. Whole texts are scored; other columns are ignored. The table has a fixed size and is broadcast.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, per_class=per_class))
    return features.scored(docs, lambda texts: scores(model.value, texts), THRESHOLD, keep)


def accepted(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """The rows of ``docs`` whose text is predicted to be of label 1, with all their columns; one stage, no shuffle of texts."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, per_class=per_class))
    place = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            texts = [t or "" for t in part.column(place).to_pylist()]
            yield part.filter(pa.array(scores(model.value, texts) >= THRESHOLD))

    return map_batches(docs, work, docs.schema)
