"""Removal of repeated byte strings by suffix sorting with difference covers.

A byte goes if a string of ``length`` bytes that covers it starts anywhere else in the corpus. Sorting every suffix of the corpus would
shuffle many times its size, so suffixes are first dealt out by content, without loss:

1. Texts are taken once each, with their number; a text with copies is removed whole.
2. Every window of ``length`` bytes has an anchor: the leftmost of its strings of ANCHOR bytes with the least hash. Equal
   windows have equal anchors at equal places. A window whose anchor occurs once in the corpus is unique. For the other anchors, the
   stretch of text that their windows cover goes to the anchor's shard.
3. In a shard, the stretches' suffixes are sorted by the difference-cover algorithm: triples at positions 1 and 2 modulo 3 are sorted and
   named, the names' suffixes are sorted recursively until they tell ``length`` bytes apart, the remaining suffixes are sorted by a byte and a
   rank and merged in. Windows that are next to each other in this order and agree on ``length`` bytes are repeated.
4. An anchor in more than HOT texts would be too much for a task. Its windows are counted one by one instead, by hash.

Occurrences of an anchor, a stretch or a window in one text are one row, so a text that repeats itself weighs no more than others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanlake.llm.arrow import slices, text_bytes
from scanlake.llm.hashing import _INVERSE, BASE, byte_values, mix, powers

LENGTH = 200
ANCHOR = 64
#: Texts with an anchor whose stretches one task sorts at once: at most about 2 MB.
HOT = 6000
#: Bytes of stretches that are sorted at once.
SORT_BYTES = 1 << 19
_PLACE = 10  # bits of a distance between a window's start and its anchor


def suffix_order(text: np.ndarray, need: int) -> np.ndarray:
    """The suffixes' starts in ascending order, by their first ``need`` numbers at least; ``text`` holds numbers from 1 on."""
    n = len(text)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: text[i:].tolist()), np.int64)
    if need <= 1:
        return np.argsort(text, kind="stable")
    t = np.zeros(n + 3, np.uint64)
    t[:n] = text
    base = np.uint64(int(text.max()) + 1)
    # Position n, an empty suffix, ends the first half of the names where n is 1 modulo 3.
    one, two = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate((one, two))
    triples = (t[sample] * base + t[sample + 1]) * base + t[sample + 2]
    kinds, names = np.unique(triples, return_inverse=True)
    if len(kinds) < len(names) and need > 3:
        order = suffix_order(names + 1, -(-need // 3))
    else:
        order = np.argsort(names, kind="stable")
    rank = np.zeros(n + 3, np.uint64)
    rank[sample[order]] = np.arange(1, len(order) + 1, dtype=np.uint64)
    if len(kinds) < len(names) and need <= 3:
        rank[sample] = names + 1  # equal triples are equal here
    most = np.uint64(len(sample) + 2)
    zero = np.arange(0, n, 3)
    zero = zero[np.argsort(t[zero] * most + rank[zero + 1], kind="stable")]
    # How many sampled suffixes of either kind are less than each of the others.
    sorted_one = one[np.argsort(rank[one], kind="stable")]
    sorted_two = two[np.argsort(rank[two], kind="stable")]
    by_one = lambda at: t[at] * most + rank[at + 1]
    by_two = lambda at: (t[at] * base + t[at + 1]) * most + rank[at + 2]
    less = np.searchsorted(by_one(sorted_one), by_one(zero)) + np.searchsorted(by_two(sorted_two), by_two(zero))
    places = np.concatenate((2 * less, 2 * np.arange(len(order)) + 1))
    merged = np.concatenate((zero, sample[order]))[np.argsort(places, kind="stable")]
    return merged[merged < n]


def equal_at(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` bytes from a and from b on are the same, for each pair."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    words = np.ndarray((len(data),), "<u8", padded, strides=(1,))
    alive = np.arange(len(a))
    offsets = [*range(0, length - 7, 8), *([length - 8] if length % 8 and length > 8 else [])] if length >= 8 else []
    for k in offsets:
        alive = alive[words[a[alive] + k] == words[b[alive] + k]]
    if length < 8:
        for k in range(length):
            alive = alive[data[a[alive] + k] == data[b[alive] + k]]
    same = np.zeros(len(a), bool)
    same[alive] = True
    return same


def repeated_windows(stretches: list[bytes], places: np.ndarray, length: int) -> list[np.ndarray]:
    """For each stretch, which of its windows (by their starts) occur in another stretch; ``places`` tells apart what cannot match.

    Windows match only if they are at the same distance from the ends of ``places``: equal place plus start.
    """
    sizes = np.array([len(s) for s in stretches])
    data = np.frombuffer(b"\0".join(stretches) + b"\0", np.uint8)
    begins = np.concatenate(([0], np.cumsum(sizes + 1)))
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)
    text = data.astype(np.int64) + 1
    text[begins[1:] - 1] = 257
    starts = np.arange(len(data)) - begins[owner]
    usable = starts + length <= sizes[owner]
    order = suffix_order(text, length)
    order = order[usable[order]]
    flag = np.zeros(len(data), bool)
    a, b = order[:-1], order[1:]
    pairs = np.flatnonzero(places[owner[a]] - starts[a] == places[owner[b]] - starts[b])
    a, b = a[pairs], b[pairs]
    same = equal_at(data, a, b, length)
    flag[a[same]] = True
    flag[b[same]] = True
    return [flag[s : s + max(0, n - length + 1)] for s, n in zip(begins[:-1], sizes, strict=True)]


def window_anchors(data: np.ndarray, offsets: np.ndarray, length: int, anchor: int):
    """Runs of windows with one anchor: (text number, first window, last window, anchor) positions in the text, and the anchor's hash."""
    n = len(data)
    empty = np.zeros(0, np.int64)
    if n < length:
        return (empty,) * 4, empty.view(np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(byte_values(5)[data] * powers(n, BASE), out=sums[1:])
    count = n - anchor + 1
    hashes = mix((sums[anchor:] - sums[:count]) * powers(n + 1, _INVERSE)[:count])
    least = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(count, dtype=np.uint64)
    width, step = length - anchor + 1, 1
    while step * 2 <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < width:
        least = np.minimum(least[: len(least) - (width - step)], least[width - step :])
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.arange(len(at))
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(at)]
    usable = np.flatnonzero(starts + length <= offsets[owner + 1])
    at, starts, owner = at[usable], starts[usable], owner[usable]
    if not len(at):
        return (empty,) * 4, empty.view(np.uint64)
    first = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (owner[1:] != owner[:-1]))))
    last = np.concatenate((first[1:] - 1, [len(at) - 1]))
    begin = offsets[owner[first]]
    return (owner[first], starts[first] - begin, starts[last] - begin, at[first] - begin), hashes[at[first]]


def _lists(values: np.ndarray, borders: np.ndarray) -> pa.Array:
    """values[borders[i]:borders[i + 1]] as the i-th list."""
    return pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array(values, pa.int64()))


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal keys together, the first key first, and the borders of the groups in it."""
    order = np.lexsort(keys[::-1])
    change = np.zeros(max(0, len(order) - 1), bool)
    for key in keys:
        change |= key[order[1:]] != key[order[:-1]]
    return order, np.concatenate(([0], np.flatnonzero(change) + 1, [len(order)])) if len(order) else np.zeros(1, np.int64)


_ANCHORS = "hash long, k1 long, k2 long, locs array<long>"


def _anchors(length: int, anchor: int):
    """The anchors of each text. A loc: anchor position, distance to its first window's start, to its last one's."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            names = part.schema.names
            data, offsets = text_bytes(part.column(names.index("text")))
            (owner, first, last, at), hashes = window_anchors(data, offsets, length, anchor)
            loc = (at << _PLACE | (at - first)) << _PLACE | (at - last)
            order, borders = _groups(owner, hashes)
            heads = order[borders[:-1]]
            k1, k2 = (part.column(names.index(k)).to_numpy()[owner[heads]] for k in ("k1", "k2"))
            arrays = [pa.array(x) for x in (hashes[heads].view(np.int64), k1, k2)]
            yield pa.RecordBatch.from_arrays([*arrays, _lists(loc[order], borders)], ["hash", "k1", "k2", "locs"])

    return work


def _spread(loc: np.ndarray):
    """Anchor position, and the starts of its first and last windows."""
    mask = (1 << _PLACE) - 1
    at = loc >> (2 * _PLACE)
    return at, at - (loc >> _PLACE & mask), at - (loc & mask)


_STRETCHES = "hash long, k1 long, k2 long, ahead long, stretch binary, firsts array<long>"


def _by_text(batches: Iterator[pa.RecordBatch]):
    """For each row: text, its keys, and hash and loc of every occurrence of its anchors."""
    for batch in batches:
        names = batch.schema.names
        for row in range(batch.num_rows):
            col = {n: batch.column(i).slice(row, 1) for i, n in enumerate(names)}
            lists = col["locs"].flatten()
            hashes = np.repeat(col["hashes"].flatten().to_numpy(), lists.value_lengths().to_numpy())
            yield col["text"][0].as_py(), col["k1"][0].as_py(), col["k2"][0].as_py(), hashes, lists.flatten().to_numpy()


def _stretches(length: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for text, k1, k2, hashes, locs in _by_text(batches):
            at, first, last = _spread(locs)
            rows: dict[tuple, list[int]] = {}
            for h, a, b, ahead in zip(hashes.tolist(), first.tolist(), (last + length).tolist(), (at - first).tolist(), strict=True):
                rows.setdefault((h, ahead, text[a:b]), []).append(a)
            h, ahead, parts = zip(*rows, strict=True)
            keys = (pa.array(np.full(len(rows), k, np.int64)) for k in (k1, k2))
            yield pa.RecordBatch.from_arrays(
                [pa.array(h, pa.int64()), *keys, pa.array(ahead, pa.int64()), pa.array(parts, pa.binary()), pa.array(list(rows.values()), pa.list_(pa.int64()))],
                ["hash", "k1", "k2", "ahead", "stretch", "firsts"],
            )

    return work


_SPANS = "k1 long, k2 long, start long, end long"


def _sorted_shards(length: int):
    """Rows come by hash; whole shards are collected until they hold SORT_BYTES, then sorted together."""

    def spans(rows: dict, members: list):
        if not rows:
            return None
        keys = list(rows)
        distinct = [k[2] for k in keys]
        places = np.array([k[1] for k in keys], np.int64)
        single = np.array([rows[k][1] == 1 for k in keys])
        flags = repeated_windows(distinct, places, length) if single.any() else [None] * len(keys)
        runs = []
        for many, flag, text in zip(~single, flags, distinct, strict=True):
            if many:
                runs.append(((0, len(text)),))
                continue
            edges = np.flatnonzero(np.diff(np.concatenate(([False], flag, [False])).astype(np.int8)))
            runs.append([(a, b + length - 1) for a, b in edges.reshape(-1, 2).tolist()])
        out = [(k1, k2, first + a, first + b) for number, k1, k2, firsts in members for a, b in runs[number] for first in firsts]
        if not out:
            return None
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["k1", "k2", "start", "end"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, members, held, last = {}, [], 0, None
        for batch in batches:
            for h, k1, k2, ahead, stretch, firsts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if h != last and held >= SORT_BYTES:
                    found = spans(rows, members)
                    if found:
                        yield found
                    rows, members, held = {}, [], 0
                last = h
                entry = rows.get((h, ahead, stretch))
                if entry is None:
                    entry = rows[h, ahead, stretch] = [len(rows), 0]
                    held += len(stretch)
                entry[1] += len(firsts)
                members.append((entry[0], k1, k2, firsts))
        found = spans(rows, members)
        if found:
            yield found

    return work


_WINDOWS = "hash long, window long, k1 long, k2 long, starts array<long>"


def _hot_windows(length: int):
    """Each window of hot anchors by its own: hashes of the anchor and the window, and where it starts in the text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = byte_values(9)
        for text, k1, k2, hashes, locs in _by_text(batches):
            data = np.frombuffer(text, np.uint8)
            _, first, last = _spread(locs)
            sizes = last - first + 1
            starts = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(table[data] * powers(len(data), BASE))))
            window = mix((sums[starts + length] - sums[starts]) * powers(len(data) + 1, _INVERSE)[starts])
            hashes = np.repeat(hashes, sizes)
            order, borders = _groups(hashes, window)
            heads = order[borders[:-1]]
            keys = (pa.array(np.full(len(heads), k, np.int64)) for k in (k1, k2))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[heads]), pa.array(window[heads].view(np.int64)), *keys, _lists(starts[order], borders)],
                ["hash", "window", "k1", "k2", "starts"],
            )

    return work


_RESULT = "k1 long, k2 long, n_removed long, spans array<struct<start: long, end: long>>, kept_sha256 string"


def _removed(length: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            rows = []
            for text, n, spans in zip(col["text"].to_pylist(), col["n"].to_pylist(), col["spans"].to_pylist(), strict=True):
                if n > 1 and len(text) >= length:
                    merged = [(0, len(text))]
                else:
                    merged = []
                    for s in sorted((s["start"], s["end"]) for s in spans or ()):
                        if merged and s[0] <= merged[-1][1]:
                            merged[-1] = (merged[-1][0], max(s[1], merged[-1][1]))
                        else:
                            merged.append(s)
                kept, done = hashlib.sha256(), 0
                for a, b in merged:
                    kept.update(text[done:a])
                    done = b
                kept.update(text[done:])
                rows.append((sum(b - a for a, b in merged), [{"start": a, "end": b} for a, b in merged], kept.hexdigest()))
            removed, spans, kept = zip(*rows, strict=True) if rows else ((), (), ())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [col["k1"], col["k2"], pa.array(removed, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.string())],
                ["k1", "k2", "n_removed", "spans", "kept_sha256"],
            )

    return work


def repeated_spans(docs: DataFrame, length: int = LENGTH, anchor: int | None = None, hot: int = HOT) -> DataFrame:
    """Per row of ``docs`` (``doc_id, text``): ``doc_id, n_bytes, n_removed, spans, kept_sha256``.

    ``spans`` are the maximal runs of removed bytes. Texts are UTF-8 bytes, a null one is empty; texts shorter than ``length`` keep all.
    Repeated rows are copies of each other. Other columns are ignored; a null id stays null; an empty table gives no rows. Texts
    are told apart by 128 bits of hash, hot windows by 128 bits.
    """
    anchor = anchor or max(1, min(ANCHOR, length // 2))
    if length - anchor >= 1 << _PLACE:
        raise ValueError(f"length must be below {(1 << _PLACE) + anchor}")
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    ).select(
        "doc_id", "text", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"),
    )
    texts = keyed.groupBy("k1", "k2").agg(F.first("text").alias("text"), F.count("*").alias("n"))
    places = texts.mapInArrow(_anchors(length, anchor), _ANCHORS)
    often = places.groupBy("hash").agg(F.sum(F.size("locs")).alias("times"), F.count("*").alias("texts")).where("times > 1").drop("times")
    found = places.join(often, "hash")

    def with_text(rows):
        lists = rows.groupBy("k1", "k2").agg(F.collect_list(F.struct("hash", "locs")).alias("places"))
        lists = lists.select("k1", "k2", F.col("places.hash").alias("hashes"), F.col("places.locs").alias("locs"))
        return texts.join(lists, ["k1", "k2"])

    shards = with_text(found.where(F.col("texts") <= hot)).mapInArrow(_stretches(length), _STRETCHES)
    shards = shards.repartition("hash").sortWithinPartitions("hash")
    spans = shards.mapInArrow(_sorted_shards(length), _SPANS)
    windows = with_text(found.where(F.col("texts") > hot)).mapInArrow(_hot_windows(length), _WINDOWS)
    again = windows.groupBy("hash", "window").agg(F.sum(F.size("starts")).alias("times")).where("times > 1").drop("times")
    hot_spans = windows.join(again, ["hash", "window"]).select("k1", "k2", F.explode("starts").alias("start"))
    hot_spans = hot_spans.withColumn("end", F.col("start") + length)
    every = spans.unionByName(hot_spans).groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    result = texts.join(every, ["k1", "k2"], "left").mapInArrow(_removed(length), _RESULT)
    return (
        keyed.select("doc_id", "k1", "k2", F.octet_length("text").cast("long").alias("n_bytes"))
        .join(result, ["k1", "k2"])
        .select("doc_id", "n_bytes", "n_removed", "spans", "kept_sha256")
    )
