"""Hashed features of texts: character n-grams and words, for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanlake.llm.arrow import map_batches
from scanlake.llm.hashing import BASE, mix

#: Characters of texts that are turned into features at once; a longer text is alone.
CHUNK_CHARS = 1 << 20


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each text between two line feeds, and the position of each text's first line feed."""
    joined = "\n".join(["", *texts, ""])
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    return points, np.concatenate(([0], np.cumsum(sizes + 1)))


def ngram_features(points: np.ndarray, offsets: np.ndarray, orders: tuple[int, ...], bits: int) -> Iterator[np.ndarray]:
    """For each order n, the feature of the n characters that start at each position but the last n - 1.

    The line feed before the first text belongs to no n-gram of another text: an n-gram over two texts counts to neither, see
    ``owners``.
    """
    values = points.astype(np.uint64) * np.uint64(BASE)
    total = np.zeros(len(points), np.uint64)
    done = 0
    for n in orders:
        while done < n:
            size = len(points) - done
            total = total[:size] * np.uint64(0xD6E8FEB86659FD93) + values[done:]
            done += 1
        x = total ^ (total >> np.uint64(32))
        yield ((x * np.uint64(BASE) + np.uint64(n)) >> np.uint64(64 - bits)).astype(np.int32)


def ngram_sums(points, offsets, orders, bits, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of ``table`` over the n-grams of each text, and their number. N-grams reach at most into the text's own borders."""
    sums = np.zeros(len(offsets) - 1)
    number = np.zeros(len(offsets) - 1, np.int64)
    for n, ids in zip(orders, ngram_features(points, offsets, orders, bits), strict=True):
        running = np.zeros(len(ids) + 1)
        np.cumsum(table[ids], out=running[1:])
        a = offsets[:-1]
        b = np.maximum(a, offsets[1:] + 2 - n)  # starts after the last whole n-gram
        sums += running[b] - running[a]
        number += b - a
    return sums, number


def text_ngrams(text: str, orders, bits) -> np.ndarray:
    """Features of one text, one for each occurrence."""
    points, offsets = code_points([text])
    return np.concatenate(list(ngram_features(points, offsets, orders, bits)))


def chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Row ranges of about CHUNK_CHARS characters."""
    first = total = 0
    for i, text in enumerate(texts):
        if i > first and total + len(text) > CHUNK_CHARS:
            yield first, i
            first, total = i, 0
        total += len(text)
    if first < len(texts):
        yield first, len(texts)


def held_out(doc_id: Column, fold: int = 1, folds: int = 3) -> Column:
    """True where crc32 of the id as text has the remainder ``fold``. A null id counts as the text of its absence."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == fold


def training_rows(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """``text, target`` of at most ``per_class`` labelled rows of each class, chosen by a hash of the id, outside the held-out fold.

    The bound is on rows; texts stay whole. Rows without label or text are left out. Ids that are labelled twice with different
    values are left out.
    """
    marked = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("_id"))
        .agg(F.min(label).cast("int").alias("target"), F.max(label).cast("int").alias("_other"))
        .where(F.col("target") == F.col("_other"))
        .select("_id", "target")
    )
    kinds = [
        marked.where(F.col("target") == t).orderBy(F.xxhash64("_id"), "_id").limit(per_class) for t in (0, 1)
    ]
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), "text").where(F.col("text").isNotNull())
    # At most 2 * per_class ids: a bounded side.
    chosen = F.broadcast(kinds[0].unionByName(kinds[1]))
    # An id with several texts gives its least one: 2 * per_class rows at most, however often an id is repeated.
    return rows.join(chosen, "_id").groupBy("_id", "target").agg(F.min("text").alias("text")).select("_id", "target", "text")


def fitted(rows: DataFrame, fit, schema: str = "model binary") -> bytes:
    """``fit`` gets (text, target) pairs of the bounded sample, by id, in one task, and returns the model's bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs():
            for batch in batches:
                yield from zip(batch.column(2).to_pylist(), batch.column(1).to_pylist(), strict=True)

        yield pa.RecordBatch.from_arrays([pa.array([fit(pairs())], pa.binary())], ["model"])

    ordered = rows.repartition(1).sortWithinPartitions("_id", F.crc32(F.col("text").cast("binary")))
    row = map_batches(ordered, work, schema).first()
    return bytes(row["model"]) if row else fit(iter(()))  # no rows, no task


def scored(docs: DataFrame, scores, threshold: float, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, ``held_out, score, predicted`` for every row; ``scores`` maps a list of texts to an array of scores."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(len(keep) + 1).to_pylist()]
            values = np.concatenate([scores(texts[a:b]) for a, b in chunks(texts)]) if texts else np.zeros(0)
            values = np.clip(values, 0.0, 1.0)
            arrays = [batch.column(i) for i in range(len(keep) + 1)]
            arrays += [pa.array(values, pa.float64()), pa.array((values >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, [*keep, "held_out", "score", "predicted"])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    ddl = ", ".join(f"`{c}` {kinds[c]}" for c in keep)
    rows = docs.select(*keep, held_out(F.col("doc_id")).alias("held_out"), "text")
    return map_batches(rows, work, f"{ddl}, held_out boolean, score double, predicted int")


__all__ = ["chunks", "code_points", "fitted", "held_out", "mix", "ngram_features", "ngram_sums", "scored", "text_ngrams", "training_rows"]
