"""Runs of repeated words inside a document: seeds on diagonals, extended to whole runs.

A run is a stretch of words with smallest period q, at least ``max(MIN_WORDS, MIN_TIMES * q)`` long, that no neighbouring word extends.
Shifted by q it overlaps itself in ``max(MIN_WORDS, MIN_TIMES * q) - q`` words at least. So, for the periods from q to 2 q - 1:

1. Every gram of that guaranteed overlap is indexed. Inside a run a gram holds a whole period, so the nearest earlier place of
   the same gram is one period away: occurrences are paired with the next one only, and pairs of other lags are left out.
2. A pair is a seed on the diagonal of its lag. It is extended to both sides as long as the words at that lag agree. A table of the
   furthest word covered on each lag keeps a stretch from being extended twice.
3. A stretch found at several lags has the smallest of them as its period.

Grams are named exactly by doubling: a gram's name is the rank of the pair of names of its halves. Work is n log n for a text of n words,
however often they repeat.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanlake.llm.arrow import slices

MIN_WORDS = 6
MIN_TIMES = 4


def same_from(x: np.ndarray, y: np.ndarray) -> int:
    """How many leading elements agree, in steps that double."""
    done, step, n = 0, 32, min(len(x), len(y))
    x, y = x[:n], y[:n]
    while done < n:
        differ = x[done : done + step] != y[done : done + step]
        first = int(differ.argmax())
        if differ[first]:
            return done + first
        done, step = done + len(differ), step * 2
    return n


class Grams:
    """Exact names of the grams of one text, by doubling."""

    def __init__(self, words: np.ndarray):
        self.names = {1: words}

    def get(self, length: int) -> np.ndarray:
        """The name of each gram of ``length`` words, no more than the text has: the rank of the names of the grams of a power of two of words
        that it begins and ends with."""
        if length not in self.names:
            half = 1 << ((length - 1).bit_length() - 1)
            names = self.get(half)
            first, last = names[: len(names) - length + half], names[length - half :]
            self.names[length] = np.unique(first * np.int64(last.max() + 1) + last, return_inverse=True)[1]
        return self.names[length]


def neighbours(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each place of a gram and the distance to its next place, by place; places without a next one are left out."""
    order = np.argsort(names, kind="stable")
    same = np.flatnonzero(names[order[1:]] == names[order[:-1]])
    at, lag = order[same], order[same + 1] - order[same]
    by = np.argsort(at)
    return at[by], lag[by]


def find_runs(words: np.ndarray, min_words: int = MIN_WORDS, min_times: int = MIN_TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period; ``words`` are numbers from 0."""
    n = len(words)
    grams = Grams(words.astype(np.int64))
    found: dict[tuple[int, int], int] = {}
    unique_from = n  # no gram of so many words repeats
    low = 1
    while max(min_words, min_times * low) <= n:
        size = min(max(min_words, min_times * q) - q for q in range(low, 2 * low))
        if size >= unique_from:
            low *= 2
            continue
        at, lag = neighbours(grams.get(size))
        if not len(at):
            unique_from = size
        fits = (lag >= low) & (lag < 2 * low)
        at, lag = at[fits], lag[fits]
        if len(at):
            by = np.lexsort((at, lag))
            at, lag = at[by], lag[by]
            new = np.concatenate(([True], (lag[1:] != lag[:-1]) | (at[1:] != at[:-1] + 1)))
            covered: dict[int, int] = {}
            for i, q in zip(at[new].tolist(), lag[new].tolist(), strict=True):
                if i < covered.get(q, 0):
                    continue
                left = same_from(words[:i][::-1], words[q : i + q][::-1])
                right = same_from(words[i + size :], words[i + size + q :])
                start, end = i - left, i + size + right
                covered[q] = end
                length = end - start + q
                if length >= max(min_words, min_times * q):
                    key = (start, length)
                    found[key] = min(q, found.get(key, q))
        low *= 2
    return sorted((s, length, q) for (s, length), q in found.items())


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay: those that no run has behind its first period."""
    edges = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:n]) == 0


def plant_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a tenth of the documents, chosen and cut by the id's crc32, with a period from some word on.

    A document without an id is left as it is.
    """
    n = len(words)
    if doc_id is None or not n:
        return words
    g, last = divmod(crc32(str(doc_id).encode()), 10)
    if last:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a : a + p]
    return words[:a] + (period * ((n - a) // p + 1))[: n - a]


_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
        ("collapsed", pa.string()),
    ]
)


def _collapse(min_words: int, min_times: int, rewrite: Callable | None):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 22):
            runs_of, texts = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                words = (text or b"").split()
                if rewrite:
                    words = rewrite(doc_id, words)
                codes: dict[bytes, int] = {}
                numbers = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, len(words))
                # A run repeats words; a text of different words has none.
                runs = find_runs(numbers, min_words, min_times) if len(codes) < len(words) else []
                if runs:
                    stay = kept_words(len(words), runs)
                    words = [w for w, s in zip(words, stay.tolist(), strict=True) if s]
                runs_of.append([{"start": s, "length": length, "period": q} for s, length, q in runs])
                texts.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(runs_of, _OUT.field(1).type), pa.array(texts, pa.string())], schema=_OUT)

    return work


def collapse_runs(
    docs: DataFrame, min_words: int = MIN_WORDS, min_times: int = MIN_TIMES, rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None
) -> DataFrame:
    """Per row of ``docs`` (``doc_id, text``): ``doc_id, runs array<struct<start, length, period>>, collapsed``.

    ``collapsed`` has the words that stay, one blank apart. Words are what ASCII white space leaves. A null or empty text has no
    runs and collapses to nothing; rows are worked on one by one, so repeated rows and null ids are rows like others; other columns are ignored.
    ``rewrite`` gets the id and the words of each document and returns the words to work on. No shuffle.
    """
    if min_times < 3:
        raise ValueError("min_times must be 3 at least")
    if min_words < 2:
        raise ValueError("min_words must be 2 at least")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kind = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return rows.mapInArrow(_collapse(min_words, min_times, rewrite), kind)


def run_digest(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one (ties: smallest start, then period), and digests of the runs and of the collapsed text."""
    runs = F.col("runs")
    longest = F.array_max(F.transform(runs, lambda r: F.struct(r.length.alias("length"), (-r.start).alias("s"), (-r.period).alias("p"))))
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))

    def digest(text: Column) -> Column:
        return F.sha2(text.cast("binary"), 256)

    rows = found.select("doc_id", "collapsed", F.size("runs").cast("long").alias("n_runs"), longest.alias("top"), F.array_join(lines, "").alias("lines"))
    return rows.select(
        "doc_id", "n_runs", (-F.col("top.s")).alias("start"), F.col("top.length").alias("length"), (-F.col("top.p")).alias("period"),
        F.expr("1000 * top.length div -top.p").alias("exponent_milli"),
        digest(F.col("lines")).alias("runs_sha256"), digest(F.col("collapsed")).alias("collapsed_sha256"),
    )
