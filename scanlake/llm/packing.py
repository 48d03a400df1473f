"""Packing into windows by minimum bin slack.

Documents are cut into whole windows and a remainder. The remainders' lengths are counted (at most window - 1 numbers, whatever the
corpus). Repeatedly the longest length left is combined with the multiset of other lengths that fills the window closest to
capacity, found by a subset-sum dynamic program on a bitset with bounded counts and read off by backtracking; the
pattern is used as often as its counts allow. Lengths that no multiset completes exactly are cut: they run on over window borders, and
the very last tokens make windows whose lengths are powers of two. So nothing is padded.

The plan is a list of patterns per length. Each remainder finds its place from its rank among the remainders of
its length, which is its rank in its partition plus the counts of the partitions before: no row meets another.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scanlake.llm.arrow import map_batches, slices
from scanlake.llm.shared import written
from scanlake.llm.tokens import ENCODE_BYTES, default_path, tokenizer, with_end

WINDOW = 2048
END_ID = 1


def best_fill(counts: np.ndarray, capacity: int) -> tuple[int, dict[int, int]]:
    """The largest sum up to ``capacity`` of a multiset with at most counts[n] pieces of length n, and the pieces."""
    full = (1 << (capacity + 1)) - 1
    reach, steps = 1, []
    for length in np.flatnonzero(counts[: capacity + 1])[::-1].tolist():
        left, size = min(int(counts[length]), capacity // length), 1
        while left > 0:
            take = min(size, left)
            grown = reach | (reach << (take * length)) & full
            if grown != reach:
                steps.append((length, take, reach))
                reach = grown
            left -= take
            size *= 2
        if reach >> capacity & 1:
            break
    total = reach.bit_length() - 1
    pieces: dict[int, int] = {}
    rest = total
    for length, take, before in reversed(steps):
        if not before >> rest & 1:
            pieces[length] = pieces.get(length, 0) + take
            rest -= take * length
    return total, pieces


@dataclass
class Plan:
    """Where the pieces of a length go, by rank: entries sorted by (length, first rank)."""

    keys: np.ndarray  # length << 44 | first rank
    each: np.ndarray  # pieces of this length in one window of the entry
    sequence: np.ndarray  # first window of the entry, -1 for pieces that run on over borders
    offset: np.ndarray  # offset in the window, or position of the first piece in the run
    borders: np.ndarray  # of the windows at the run's end, as positions
    full_run: int  # windows of full length in the run
    run_start: int  # first window of the run
    window: int

    def place(self, lengths: np.ndarray, ranks: np.ndarray):
        """(piece, start in piece, length, sequence, offset) of each part; pieces that are not cut have one part."""
        at = np.searchsorted(self.keys, lengths << 44 | ranks, side="right") - 1
        rank = ranks - (self.keys[at] & ((1 << 44) - 1))
        runs = self.sequence[at] < 0
        whole = np.flatnonzero(~runs)
        k = at[whole]
        parts = [
            (
                whole,
                np.zeros(len(whole), np.int64),
                lengths[whole],
                self.sequence[k] + rank[whole] // self.each[k],
                self.offset[k] + rank[whole] % self.each[k] * lengths[whole],
            )
        ]
        piece = np.flatnonzero(runs)
        first = self.offset[at[piece]] + rank[piece] * lengths[piece]
        last = first + lengths[piece]
        done = first.copy()
        while len(piece):
            window, start, end = self._window(done)
            stop = np.minimum(last, end)
            parts.append((piece, done - first, stop - done, window, done - start))
            more = stop < last
            piece, first, last, done = piece[more], first[more], last[more], stop[more]
        return tuple(np.concatenate(x).astype(np.int64) for x in zip(*parts, strict=True))

    def _window(self, position: np.ndarray):
        number = position // self.window
        tail = np.searchsorted(self.borders, position, side="right") - 1
        in_run = position < self.full_run * self.window
        tail = np.clip(tail, 0, max(0, len(self.borders) - 2))
        start = np.where(in_run, number * self.window, self.borders[tail])
        end = np.where(in_run, (number + 1) * self.window, self.borders[np.minimum(tail + 1, len(self.borders) - 1)])
        return self.run_start + np.where(in_run, number, self.full_run + tail), start, end


def make_plan(counts: dict[int, int], window: int = WINDOW) -> Plan:
    """The plan for so many pieces of each length below ``window``; whole windows come before all else."""
    left = np.zeros(window + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    sequence = int(left[window])
    used = np.zeros(window + 1, np.int64)
    entries = [(window, 0, 1, 0, 0)]
    left[window] = 0
    rest = {}
    while left.any():
        longest = int(np.flatnonzero(left)[-1])
        left[longest] -= 1
        total, pieces = best_fill(left, window - longest)
        left[longest] += 1
        if total + longest < window:
            rest[longest] = int(left[longest])  # what does not fit now will not with fewer pieces
            left[longest] = 0
            continue
        pieces[longest] = pieces.get(longest, 0) + 1
        times = min(int(left[n]) // c for n, c in pieces.items())
        offset = 0
        for length, c in sorted(pieces.items(), reverse=True):
            entries.append((length, int(used[length]), c, sequence, offset))
            used[length] += c * times
            left[length] -= c * times
            offset += c * length
        sequence += times
    position = 0
    for length in sorted(rest):
        entries.append((length, int(used[length]), 1, -1, position))
        position += rest[length] * length
    full_run, tail = divmod(position, window)
    borders = [full_run * window]
    for bit in range(tail.bit_length() - 1, -1, -1):
        if tail >> bit & 1:
            borders.append(borders[-1] + (1 << bit))
    entries.sort()
    length, first, each, start, offset = (np.array(x, np.int64) for x in zip(*entries, strict=True))
    return Plan(length << 44 | first, each, start, offset, np.array(borders, np.int64), full_run, sequence, window)


_STAGED = (
    "doc_id long, pid int, doc_tokens long, full_rank long, full_crcs array<long>, rem_len long, rem_rank long, rem_crc long, rem_ids binary"
)
_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "pid int, rem_len long, rem_rank long, rem_from long"
)
_RESULT = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def _cut(path: str, window: int, end_id: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()
        ranks = np.zeros(window + 1, np.int64)
        library = tokenizer(path)
        for part in slices(batches, "text", ENCODE_BYTES):
            ids, borders = with_end(*library.encode(part.column(1)), end_id)
            raw = memoryview(ids).cast("B")
            rows = []
            for a, b in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):
                full, rest = divmod(b - a, window)
                crcs = [zlib.crc32(raw[4 * i : 4 * (i + window)]) for i in range(a, b - rest, window)]
                tail = ids[b - rest : b]
                rows.append(
                    (pid, b - a, int(ranks[window]), crcs, rest, int(ranks[rest]), zlib.crc32(raw[4 * (b - rest) : 4 * b]), _packed(tail))
                )
                ranks[window] += full
                if rest:
                    ranks[rest] += 1
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            names = ["doc_id", "pid", "doc_tokens", "full_rank", "full_crcs", "rem_len", "rem_rank", "rem_crc", "rem_ids"]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], names)

    return work


def _packed(ids: np.ndarray) -> bytes:
    """Two bytes an id if they suffice; the first byte says so."""
    wide = len(ids) and ids.max() > 0xFFFF
    return bytes([4 if wide else 2]) + ids.astype("<u4" if wide else "<u2").tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u4" if raw[0] == 4 else "<u2", offset=1).astype("<u4")


def _placed(plan, window: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            num = {n: col[n].to_numpy() for n in ("doc_tokens", "full_rank", "full_base", "rem_len", "rem_rank", "rem_base")}
            full = num["doc_tokens"] // window
            doc = np.repeat(np.arange(batch.num_rows), full)
            nth = np.arange(len(doc)) - np.repeat(np.cumsum(full) - full, full)
            crc = col["full_crcs"].flatten().to_numpy()
            sequence = (num["full_base"] + num["full_rank"])[doc] + nth
            with_rest = np.flatnonzero(num["rem_len"])
            lengths = num["rem_len"][with_rest]
            piece, start, size, number, offset = plan.value.place(lengths, (num["rem_base"] + num["rem_rank"])[with_rest])
            owner = with_rest[piece]
            whole = size == lengths[piece]
            crcs = pa.array(col["rem_crc"].to_numpy()[owner], mask=~whole)
            both = np.concatenate((doc, owner))
            rest_start = num["doc_tokens"] - num["rem_len"]
            zeros = np.zeros(len(doc), np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    col["doc_id"].take(pa.array(both)),
                    pa.array(np.concatenate((nth * window, rest_start[owner] + start))),
                    pa.array(np.concatenate((zeros + window, size))),
                    pa.concat_arrays([pa.array(crc, pa.int64()), crcs.cast(pa.int64())]),
                    pa.array(num["doc_tokens"][both]),
                    pa.array(np.concatenate((sequence, number))),
                    pa.array(np.concatenate((zeros, offset))),
                    col["pid"].take(pa.array(both)),
                    pa.array(num["rem_len"][both]),
                    pa.array(num["rem_rank"][both]),
                    pa.array(np.concatenate((zeros, start))),
                ],
                [c.split()[0] for c in _PIECES.split(", ")],
            )

    return work


def _crc_of_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.schema.names
        crcs = [
            zlib.crc32(_unpacked(raw)[a : a + n].tobytes())
            for raw, a, n in zip(
                batch.column(names.index("rem_ids")).to_pylist(),
                batch.column(names.index("rem_from")).to_pylist(),
                batch.column(names.index("length")).to_pylist(),
                strict=True,
            )
        ]
        arrays = [pa.array(crcs, pa.int64()) if c == "ids_crc32" else batch.column(names.index(c)) for c in _RESULT]
        yield pa.RecordBatch.from_arrays(arrays, list(_RESULT))


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """The pieces of all documents: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Each row of ``docs`` (``doc_id, text``) is a document, repeated ids too; null and empty texts are the end id alone, a null id stays
    null. Every id of a document is in one piece. Offsets in a sequence are gapless from 0, and a sequence is ``window`` ids
    long or a power of two. An empty table gives no rows. Other columns are ignored.
    """
    path = path or default_path()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    staged = written(map_batches(rows, _cut(path, window, end_id), _STAGED), "pack")
    counts = staged.where("rem_len > 0").groupBy("pid", "rem_len").agg(F.count("*").alias("n"))
    whole = staged.groupBy("pid").agg(F.sum(F.size("full_crcs").cast("long")).alias("n"))
    before = lambda *keys: Window.partitionBy(*keys).orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    rem_bases = counts.withColumn("rem_base", F.coalesce(F.sum("n").over(before("rem_len")), F.lit(0))).drop("n")
    # One row per partition of the input.
    full_bases = whole.withColumn("full_base", F.coalesce(F.sum("n").over(before()), F.lit(0))).drop("n")
    totals = {r["rem_len"]: r["n"] for r in counts.groupBy("rem_len").agg(F.sum("n").alias("n")).collect()}
    totals[window] = whole.agg(F.sum("n")).first()[0] or 0
    plan = docs.sparkSession.sparkContext.broadcast(make_plan(totals, window))
    based = (
        staged.drop("rem_ids")
        .join(rem_bases, ["pid", "rem_len"], "left")
        .join(full_bases, "pid", "left")
        .fillna(0, ["rem_base", "full_base"])
    )
    pieces = map_batches(based, _placed(plan, window), _PIECES)
    kept = pieces.where(F.col("ids_crc32").isNotNull()).select(*_RESULT)
    parts = pieces.where(F.col("ids_crc32").isNull()).join(
        staged.select("pid", "rem_len", "rem_rank", "rem_ids"), ["pid", "rem_len", "rem_rank"]
    )
    return kept.unionByName(map_batches(parts, _crc_of_parts, ", ".join(f"{c} long" for c in _RESULT)))
