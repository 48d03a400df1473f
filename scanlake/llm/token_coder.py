"""Files of token ids, compressed by an adaptive context-mixing range coder.

A block holds whole documents. Its ids are numbered in ascending order without gaps and split into lanes of equal length, which are
coded side by side: in step t, every lane codes its t-th id with the block's model as it stands, then the model learns from all lanes.
The model has three orders. Order 2 (the two ids before) and order 1 (the id before) each predict one id with a confidence; counts of
what happened under the pair of confidences mix the two predictions and the escape into three probabilities. An escaped id is coded
with adaptive frequencies of order 0. All arithmetic is on whole numbers, so a block decodes alike everywhere. Every lane has its own
range coder (64 bits, with carry, words of 32 bits, one at most a step); every block starts with a new model and has a checksum.

Block: magic, version, lanes, ids, documents, alphabet, bytes of the map, words, checksum; then document ids, sizes, the map of the ids
that occur (a bit each, compressed), words per lane, words.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scanlake.llm.arrow import slices
from scanlake.llm.shared import fresh_table
from scanlake.llm.tokens import ENCODE_BYTES, default_path, tokenizer, with_end

MAGIC = b"TIDC"
VERSION = 2
_HEADER = struct.Struct("<4sHHQQIIQI")

#: Ids of a block (a longer document has a block of its own), most lanes, and ids of a lane at least.
BLOCK_IDS = 1 << 20
LANES = 4096
LANE_IDS = 256
#: The largest id that can be coded, plus one.
MOST_IDS = 1 << 18
#: Bytes of text for each file.
FILE_BYTES = 48 << 20
#: Stands for a null document id.
NO_ID = -(1 << 63)

_MIX_BITS = 12
_MIX = 1 << _MIX_BITS
#: Order 0 has so many bits more than its ids need, and so many at most: a step takes 32 bits of the range at most.
_ORDER0_SPARE = 5
_ORDER0_BITS = 20
#: Steps between two readings of the frequencies of order 0.
_ORDER0_STEPS = 16
_SURE_BITS = 4
_SURE = (1 << _SURE_BITS) - 1
_STATES = 2 << 2 * _SURE_BITS
_SLOT_BITS = 18
_WORD_BITS = np.uint64(32)
_WORD = np.uint64(1 << 32)
_MIX_SHIFT = np.uint64(_MIX_BITS)


class _Model:
    """Predictions and frequencies that all lanes of a block share. Ids are below ``alphabet``."""

    def __init__(self, lanes: int, alphabet: int, decodes: bool):
        self.alphabet = alphabet
        self.decodes = decodes
        #: For order 1 and 2: the guess, and in the lowest bits how sure it is.
        self.guesses = [np.zeros(alphabet, np.int32), np.zeros(1 << _SLOT_BITS, np.int32)]
        self.happened = np.ones((3, _STATES), np.int64)
        self.bits = np.uint64(min(_ORDER0_BITS, max(_MIX_BITS, (alphabet - 1).bit_length() + _ORDER0_SPARE)))
        self.counts = np.zeros(alphabet, np.int64)
        self.pending: list[np.ndarray] = []
        self.step = 0
        self.last = np.zeros(lanes, np.int32)
        self.before = np.zeros(lanes, np.int32)
        self._frequencies()

    def _frequencies(self):
        counts = self.counts if self.step else self.counts + 1
        space = 1 << int(self.bits)
        freq = 1 + counts * (space - self.alphabet) // int(counts.sum() or 1)
        self.sizes = freq.astype(np.uint64)
        self.starts = (np.cumsum(freq) - freq).astype(np.uint64)
        if self.decodes:
            freq[-1] += space - int(freq.sum())
            self.id_at = np.repeat(np.arange(self.alphabet, dtype=np.int32), freq)

    def predict(self):
        """Guesses of order 2 and 1; ``state`` of each lane, and per outcome and state where its part of _MIX starts, and its size."""
        one, two = self.last, self.before
        slot = (two.astype(np.uint32) * np.uint32(0x9E3779B1)) ^ (one.astype(np.uint32) * np.uint32(0x85EBCA6B))
        self.at = one.astype(np.intp), (slot >> np.uint32(32 - _SLOT_BITS)).astype(np.intp)
        self.held = [guesses.take(at) for guesses, at in zip(self.guesses, self.at, strict=True)]
        self.sure = [held & _SURE for held in self.held]
        one, two = (held >> _SURE_BITS for held in self.held)
        self.state = (((self.sure[1] << _SURE_BITS) | self.sure[0]) << 1 | (one == two)).astype(np.intp)
        table = self.happened
        total = table[0] + table[1] + table[2]
        first = table[0] * (_MIX - 3) // total + 1
        second = table[1] * (_MIX - 3) // total + 1
        both = first + second
        starts = np.concatenate((np.zeros(_STATES, np.int64), first, both)).astype(np.uint64)
        sizes = np.concatenate((first, second, _MIX - both)).astype(np.uint64)
        return two, one, starts, sizes

    def learn(self, ids: np.ndarray, two: np.ndarray, one: np.ndarray, part: np.ndarray, missed: np.ndarray):
        """``part`` is outcome * _STATES + state; ``missed`` are the lanes whose id no guess was."""
        self.happened += 24 * np.bincount(part, minlength=3 * _STATES).reshape(3, _STATES)
        anew = ids << _SURE_BITS | 1
        for guesses, at, held, sure, guess in zip(self.guesses, self.at, self.held, self.sure, (one, two), strict=True):
            wrong = np.where(sure <= 1, anew, held - sure + (sure >> 1))
            guesses[at] = np.where(guess == ids, held + (sure < _SURE), wrong)
        self.pending.append(ids[missed])
        self.before, self.last = self.last, ids
        self.step += 1
        if self.step < _ORDER0_STEPS or self.step % _ORDER0_STEPS == 0:
            self.counts += np.bincount(np.concatenate(self.pending), minlength=self.alphabet)
            self.pending.clear()
            self._frequencies()


class _Writer:
    def __init__(self, lanes: int, steps: int):
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, (1 << 64) - 1, np.uint64)
        self.words = np.zeros((steps + 1, lanes), np.uint32)
        self.used = np.zeros(lanes, np.intp)

    def put(self, start, size, missed, begin, extent, bits):
        """Every lane codes its part of _MIX, then those ``missed`` their part of the frequencies of order 0."""
        unit = self.range >> _MIX_SHIFT
        low, width = self.low + unit * start, unit * size
        if len(missed):
            unit = width[missed] >> bits
            low[missed] += unit * begin
            width[missed] = unit * extent
        self._carry(np.flatnonzero(low < self.low))
        short = np.flatnonzero(width < _WORD)
        self._emit(low, short)
        low[short] <<= _WORD_BITS
        width[short] <<= _WORD_BITS
        self.low, self.range = low, width

    def _carry(self, lanes):
        at = self.used[lanes]
        while len(lanes):
            at = at - 1
            self.words[at, lanes] += np.uint32(1)
            over = self.words[at, lanes] == 0
            lanes, at = lanes[over], at[over]

    def _emit(self, low, lanes):
        at = self.used[lanes]
        self.words[at, lanes] = low[lanes] >> _WORD_BITS
        self.used[lanes] = at + 1

    def finish(self) -> tuple[np.ndarray, np.ndarray]:
        """Words per lane, and the words of all lanes. A lane ends with the word of a number in its range, whose other word is 0."""
        low = (self.low + (_WORD - np.uint64(1))) & ~(_WORD - np.uint64(1))
        self._carry(np.flatnonzero(low < self.low))
        self._emit(low, np.arange(len(low)))
        return self.used, self.words.T[np.arange(len(self.words)) < self.used[:, None]]


class _Reader:
    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        lanes = len(sizes)
        # One word of 0 follows those of each lane.
        ends = np.cumsum(sizes + 1)
        self.words = np.zeros(len(words) + lanes, np.uint64)
        held = np.ones(len(self.words), bool)
        held[ends - 1] = False
        self.words[held] = words
        self.next = ends - sizes - 1
        self.range = np.full(lanes, (1 << 64) - 1, np.uint64)
        #: What was read, less the low end of the range.
        self.ahead = self.words[self.next] << _WORD_BITS | self.words[self.next + 1]
        self.next += 2

    def refill(self):
        short = np.flatnonzero(self.range < _WORD)
        at = self.next[short]
        self.ahead[short] = self.ahead[short] << _WORD_BITS | self.words[at]
        self.range[short] <<= _WORD_BITS
        self.next[short] = at + 1


def encode_ids(ids: np.ndarray, alphabet: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Lanes, words per lane and words of the ids."""
    lanes = int(min(LANES, max(1, len(ids) // LANE_IDS)))
    steps = -(-len(ids) // lanes)
    grid = np.zeros(lanes * steps, np.int32)
    grid[: len(ids)] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    model, out = _Model(lanes, alphabet, False), _Writer(lanes, steps)
    for row in grid:
        two, one, starts, sizes = model.predict()
        outcome = np.where(row == two, 0, np.where(row == one, 1, 2))
        part = outcome * _STATES + model.state
        missed = np.flatnonzero(outcome == 2)
        found = row[missed]
        out.put(starts.take(part), sizes.take(part), missed, model.starts.take(found), model.sizes.take(found), model.bits)
        model.learn(row, two, one, part, missed)
    return lanes, *out.finish()


def decode_ids(count: int, lanes: int, alphabet: int, sizes: np.ndarray, words: np.ndarray) -> np.ndarray:
    steps = -(-count // lanes)
    grid = np.empty((steps, lanes), np.int32)
    model, coded = _Model(lanes, alphabet, True), _Reader(sizes, words)
    for t in range(steps):
        two, one, starts, sizes = model.predict()
        unit = coded.range >> _MIX_SHIFT
        below = model.state + _STATES
        outcome = (coded.ahead >= unit * starts.take(below)).astype(np.intp)
        outcome += coded.ahead >= unit * starts.take(below + _STATES)
        part = outcome * _STATES + model.state
        coded.ahead -= unit * starts.take(part)
        coded.range = unit * sizes.take(part)
        row = np.where(outcome == 0, two, one)
        missed = np.flatnonzero(outcome == 2)
        if len(missed):
            ahead, unit = coded.ahead[missed], coded.range[missed] >> model.bits
            found = model.id_at.take((ahead // unit).astype(np.intp), mode="clip")
            coded.ahead[missed] = ahead - unit * model.starts.take(found)
            coded.range[missed] = unit * model.sizes.take(found)
            row[missed] = found
        coded.refill()
        grid[t] = row
        model.learn(row, two, one, part, missed)
    return grid.T.reshape(-1)[:count]


def write_block(doc_ids: np.ndarray, doc_sizes: np.ndarray, ids: np.ndarray) -> bytes:
    """The block of some documents; ``ids`` are theirs one after another."""
    if len(ids) and int(ids.max()) >= MOST_IDS:
        raise ValueError(f"ids must be below {MOST_IDS}")
    occurs = np.bincount(ids.astype(np.int64), minlength=1) > 0
    number = np.cumsum(occurs, dtype=np.int32) - np.int32(1)
    occurring = zlib.compress(np.packbits(occurs).tobytes())
    lanes, sizes, words = encode_ids(number[ids], int(number[-1]) + 1) if len(ids) else (1, np.zeros(1), np.zeros(0))
    body = b"".join(
        (doc_ids.astype("<i8").tobytes(), doc_sizes.astype("<u4").tobytes(), occurring, sizes.astype("<u4").tobytes(), words.astype("<u4").tobytes())
    )
    fields = (MAGIC, VERSION, lanes, len(ids), len(doc_ids), len(occurs), len(occurring), len(words))
    check = zlib.crc32(body, zlib.crc32(_HEADER.pack(*fields, 0)))
    return _HEADER.pack(*fields, check) + body


def read_block(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, their sizes, and their ids one after another. ValueError if the block is damaged."""
    if len(block) < _HEADER.size:
        raise ValueError("a block is cut off")
    *fields, check = _HEADER.unpack_from(block)
    magic, version, lanes, count, docs, alphabet, n_map, n_words = fields
    body = memoryview(block)[_HEADER.size :]
    if magic != MAGIC or version != VERSION or len(body) != 12 * docs + n_map + 4 * lanes + 4 * n_words:
        raise ValueError("not a block of token ids")
    if zlib.crc32(body, zlib.crc32(_HEADER.pack(*fields, 0))) != check:
        raise ValueError("a block does not match its checksum")
    doc_ids = np.frombuffer(body, "<i8", docs)
    doc_sizes = np.frombuffer(body, "<u4", docs, 8 * docs).astype(np.int64)
    at = 12 * docs + n_map
    occurs = np.unpackbits(np.frombuffer(zlib.decompress(body[12 * docs : at]), np.uint8), count=alphabet)
    sizes = np.frombuffer(body, "<u4", lanes, at).astype(np.int64)
    words = np.frombuffer(body, "<u4", n_words, at + 4 * lanes)
    if not count:
        return doc_ids, doc_sizes, np.zeros(0, np.int32)
    names = np.flatnonzero(occurs).astype(np.int32)
    return doc_ids, doc_sizes, names[decode_ids(count, lanes, len(names), sizes, words)]


_BLOCKS = "part int, block int, before long, n_ids long, payload binary"
_DOCS = "doc_id long, part int, before long, n_tokens long, ids_crc32 long, block int, block_bytes long, block_ids long"


def _encode(path: str, end_id: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, library = TaskContext.get().partitionId(), tokenizer(path)
        names, lists, held, block, before = [], [], 0, 0, 0

        def full():
            nonlocal names, lists, held, block, before
            sizes = np.array([len(x) for x in lists], np.int64)
            payload = write_block(np.array(names, np.int64), sizes, np.concatenate(lists))
            row = [[part], [block], [before], [held], [payload]]
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            block, before = block + 1, before + held
            names, lists, held = [], [], 0
            arrays = [pa.array(x, k) for x, k in zip(row, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in _BLOCKS.split(", ")])

        for piece in slices(batches, "text", ENCODE_BYTES):
            ids, borders = with_end(*library.encode(piece.column(1)), end_id)
            doc_ids = piece.column(0).fill_null(NO_ID).to_numpy()
            for doc, a, b in zip(doc_ids.tolist(), borders[:-1].tolist(), borders[1:].tolist(), strict=True):
                if held and held + b - a > BLOCK_IDS:
                    yield full()
                names.append(doc)
                lists.append(ids[a:b])
                held += b - a
        if held:
            yield full()

    return work


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            doc_ids, sizes, ids = read_block(row["payload"])
            borders = np.concatenate(([0], np.cumsum(sizes)))
            raw = memoryview(ids.astype("<u4")).cast("B")
            crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True)]
            n = len(doc_ids)
            same = lambda value, kind, n=n: pa.array(np.full(n, value, kind))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc_ids.astype(np.int64), mask=doc_ids == NO_ID),
                    same(row["part"], np.int32),
                    pa.array(borders[:-1] + row["before"]),
                    pa.array(sizes),
                    pa.array(crcs, pa.int64()),
                    same(row["block"], np.int32),
                    same(len(row["payload"]), np.int64),
                    same(row["n_ids"], np.int64),
                ],
                [c.split()[0] for c in _DOCS.split(", ")],
            )


def write_token_files(docs: DataFrame, folder: str, path: str | None = None, end_id: int = 1) -> None:
    """Encodes the texts of ``doc_id, text`` and writes blocks in ascending order of doc_id (null first; ties by a hash of the text).

    Null and empty texts are the end id alone. Each task writes one file of blocks, as rows of a Parquet table whose
    ``payload`` is the block; ``before`` counts the ids of earlier blocks of the file.
    """
    path = path or default_path()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // FILE_BYTES), min(2 * rows.sparkSession.sparkContext.defaultParallelism, size >> 20))
    # Rows of one id are told apart by their texts, equal rows only by where they were read, so that a hot id fills many files.
    rows = rows.withColumn("_text", F.xxhash64("text")).withColumn("_from", F.spark_partition_id())
    ordered = rows.repartitionByRange(int(parts), "doc_id", "_text", "_from").sortWithinPartitions("doc_id", "_text", "text")
    ordered = ordered.select("doc_id", "text")
    writer = ordered.mapInArrow(_encode(path, end_id), _BLOCKS).write.mode("errorifexists")
    writer.option("compression", "none").parquet(folder)


def read_token_files(spark, folder: str) -> DataFrame:
    """Per document, from the decoded blocks: ``doc_id, start, n_tokens, ids_crc32`` and its ``block_bytes, block_ids``."""
    blocks = spark.read.schema(_BLOCKS).parquet(folder)
    found = blocks.mapInArrow(_decode, _DOCS)
    # One row per file: the ids of the files before it.
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
        .select("part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    )
    return found.join(base, "part").select(
        "doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", "block_bytes", "block_ids"
    )


def token_round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Writes the token files in the shared folder and returns what is read back from them; an empty table gives no rows."""
    spark = docs.sparkSession
    folder = fresh_table(spark, "tokens")
    write_token_files(docs, folder, path)
    return read_token_files(spark, folder)
