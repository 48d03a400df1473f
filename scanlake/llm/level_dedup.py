"""Removal of passages that an earlier document has, by windows that double level by level.

A window is a number of consecutive words of one document. A repeated window is made of repeated shorter ones, so lengths go up by levels, each
about twice the one before (7 and 13 words; 7, 13, 25 and 50), and only windows repeated at one level are extended to the next:

1. At the first level a text offers anchors: the window of the least hash among those that a window of the next length holds. Equal longer
   windows hold equal anchors, so nothing is lost, and a quarter of the words are shuffled. Later levels offer the windows whose
   two halves (or anchor) were found repeated.
2. The hashes offered are dealt out with the document's id and sorted by both. A hash that documents of different ids share goes back to each
   of them; at the last level it goes back to all but the one of the smallest id, whose words stay. A group is read in order with two
   numbers kept of it, so the number of documents that share a window does not matter to a task's memory.

What goes back to a document is the hash, not the place: the text finds its places again, also where an id has several texts. Copies of
a whole text with a smaller id are told by a hash of the text and take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanlake.llm.arrow import slices, text_bytes
from scanlake.llm.hashing import byte_values, sequence_hashes, span_hashes, spans_of

WINDOW = 13
#: No level is shorter: shorter runs of words are common to all texts of a language.
SHORTEST = 7
_TEXT = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.ones(256, bool)
_SPACE[[32, *range(9, 14)]] = False


def level_lengths(window: int, shortest: int) -> list[int]:
    """The lengths of the levels: the window, half of it rounded up, and so on while that is not below ``shortest``."""
    lengths = [window]
    while lengths[0] > 1 and -(-lengths[0] // 2) >= shortest:
        lengths.insert(0, -(-lengths[0] // 2))
    return lengths


class Words:
    """The words of some texts: hashes, the text each word belongs to, and where each text's words begin."""

    def __init__(self, column: pa.Array):
        data, offsets = text_bytes(column)
        starts, ends = spans_of(_SPACE[data], offsets)
        self.hashes = span_hashes(data, starts, ends, byte_values())
        self.first = np.searchsorted(starts, offsets)  # texts without words begin where the next one does
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the windows inside texts."""
        hashes = sequence_hashes(self.hashes, length)
        inside = self.text[: len(hashes)] == self.text[length - 1 :]
        at = np.flatnonzero(inside)
        return at, hashes[at]


def anchors(words: Words, length: int, longer: int) -> np.ndarray:
    """For each window of ``longer`` words (by its start; -1 if it leaves its text) the start of its anchor: the leftmost of its windows of
    ``length`` words with the least hash."""
    n = len(words.hashes)
    places = np.full(max(0, n - longer + 1), -1, np.int64)
    if not len(places):
        return places
    hashes = sequence_hashes(words.hashes, length)
    width = longer - length + 1
    seen = np.lib.stride_tricks.sliding_window_view(hashes, width)
    places = np.arange(len(places)) + seen.argmin(axis=1)
    places[words.text[: len(places)] != words.text[longer - 1 :]] = -1
    return places


def _keyed(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    return hashes + text.astype(np.uint64) * _TEXT


def lists_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all rows and the row of each; a null list is empty."""
    sizes = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False), nan=0).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), np.repeat(np.arange(len(sizes)), sizes)


class Survivors:
    """Which windows of which text came back from a level."""

    def __init__(self, column: pa.Array):
        hashes, rows = lists_of(column)
        self.keys = _keyed(hashes, rows)

    def holds(self, words: Words, length: int) -> np.ndarray:
        """For each start, whether the window there is among them."""
        flags = np.zeros(len(words.hashes), bool)
        at, hashes = words.windows(length)
        flags[at] = np.isin(_keyed(hashes, words.text[at]), self.keys)
        return flags


def candidates(words: Words, before: np.ndarray, sampled: bool, shorter: int, length: int) -> np.ndarray:
    """Starts of the windows of ``length`` words whose parts survived the level of ``shorter`` words."""
    if sampled:
        places = anchors(words, shorter, length)
        fits = places >= 0
        fits[fits] = before[places[fits]]
        return np.flatnonzero(fits)
    n = max(0, len(words.hashes) - length + 1)
    both = before[:n] & before[length - shorter : length - shorter + n]
    return np.flatnonzero(both & (words.text[:n] == words.text[length - 1 : length - 1 + n]))


_OFFERED = "hash long, doc_id long"


def _offers(lengths: list[int], level: int):
    """The distinct hashes that each text offers at a level, copies aside; ``found`` holds what came back from the one before."""
    length = lengths[level]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            batch = batch.filter(pc.invert(batch.column(2)))
            words = Words(batch.column(1))
            if level == 0 and len(lengths) > 1:
                at = anchors(words, length, lengths[1])
                at = np.unique(at[at >= 0])
            elif level == 0:
                at = words.windows(length)[0]
            else:
                shorter = lengths[level - 1]
                at = candidates(words, Survivors(batch.column(3)).holds(words, shorter), level == 1, shorter, length)
            hashes = sequence_hashes(words.hashes, length)[at]
            text = words.text[at]
            _, once = np.unique(_keyed(hashes, text), return_index=True)
            ids = batch.column(0).take(pa.array(text[once]))
            yield pa.RecordBatch.from_arrays([pa.array(hashes[once].view(np.int64)), ids], ["hash", "doc_id"])

    return work


def _shared(last: bool):
    """Rows sorted by hash and id: those whose hash has different ids; at the last level without those of its smallest id.

    Of the group that a batch ends in, its hash, its first id and whether others came are carried to the next one.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, least, more = None, 0, False
        for batch in batches:
            if not batch.num_rows:
                continue
            hashes, ids = (batch.column(i).to_numpy() for i in (0, 1))
            heads = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
            sizes = np.diff(np.concatenate((heads, [len(hashes)])))
            firsts = ids[heads].copy()
            goes_on = group is not None and hashes[0] == group
            if goes_on:
                firsts[0] = least
            differs = ids != np.repeat(firsts, sizes)
            many = np.maximum.reduceat(differs, heads)
            give = differs if last else np.repeat(many, sizes)
            out_h, out_i = hashes[give], ids[give]
            if goes_on and not last and not more and many[0]:
                out_h, out_i = np.append(out_h, group), np.append(out_i, least)  # it was held back
            more = bool(many[-1]) or (more and goes_on and len(heads) == 1)
            group, least = hashes[-1], firsts[-1]
            yield pa.RecordBatch.from_arrays([pa.array(out_h), pa.array(out_i)], ["hash", "doc_id"])

    return work


_RESULT = "doc_id long, n_words long, n_removed long, kept string"


def _removed(window: int):
    """What stays of each text; ``copy`` says that a smaller id has the whole text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 21):
            words = Words(batch.column(1))
            hit = np.flatnonzero(Survivors(batch.column(3)).holds(words, window))
            edges = np.zeros(len(words.hashes) + 1, np.int64)
            np.add.at(edges, hit, 1)
            np.add.at(edges, hit + window, -1)
            stays = np.cumsum(edges[:-1]) == 0
            counts, removed, kept = [], [], []
            raw = batch.column(1).cast(pa.binary()).to_pylist()
            for number, (text, copy) in enumerate(zip(raw, batch.column(2).to_pylist(), strict=True)):
                parts = (text or b"").split()
                mask = stays[words.first[number] : words.first[number + 1]]
                n = len(parts)
                if copy and n >= window:
                    parts = []
                elif not mask.all():
                    parts = [p for p, s in zip(parts, mask.tolist(), strict=True) if s]
                counts.append(n)
                removed.append(n - len(parts))
                kept.append(b" ".join(parts).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    return work


def without_repeats(docs: DataFrame, window: int = WINDOW, shortest: int = SHORTEST) -> DataFrame:
    """Per row of ``docs`` (``doc_id, text``): ``doc_id, n_words, n_removed, kept``.

    A word goes if a window of ``window`` words covers it whose words also stand, in this order, in a document with a smaller id. Words are what ASCII
    white space leaves; ``kept`` joins the others by one blank. Rows of one id are texts of one document: they remove nothing from each other. A
    null id is neither smaller nor larger than any: such rows keep all and take nothing from others. A null or empty
    text has no words. Other columns are ignored; an empty table gives no rows. Windows are told apart by 64 bits of hash, whole texts by 128.
    """
    if window < 1 or shortest < 1:
        raise ValueError("window and shortest must be 1 at least")
    lengths = level_lengths(window, shortest)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    prints = rows.where("doc_id IS NOT NULL").select("doc_id", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"))
    least = prints.groupBy("k1", "k2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    copies = prints.join(least, ["k1", "k2"]).where("doc_id > least").groupBy("doc_id").agg(F.collect_set("k1").alias("copied"))
    # Every level and the result join texts by id: they are shuffled once and read again.
    texts = rows.where("doc_id IS NOT NULL").join(copies, "doc_id", "left")
    texts = texts.select("doc_id", "text", F.coalesce(F.array_contains("copied", F.xxhash64("text")), F.lit(False)).alias("copy"))

    offered = texts.mapInArrow(_offers(lengths, 0), _OFFERED)
    for level in range(len(lengths)):
        last = level == len(lengths) - 1
        shared = offered.repartition("hash").sortWithinPartitions("hash", "doc_id").mapInArrow(_shared(last), _OFFERED)
        found = shared.groupBy("doc_id").agg(F.collect_list("hash").alias("found"))
        if not last:
            offered = texts.join(found, "doc_id").mapInArrow(_offers(lengths, level + 1), _OFFERED)
    result = texts.join(found, "doc_id", "left").mapInArrow(_removed(window), _RESULT)
    loose = rows.where("doc_id IS NULL").select("*", F.lit(False).alias("copy"), F.lit(None).cast("array<long>").alias("found"))
    return result.unionByName(loose.mapInArrow(_removed(window), _RESULT))
