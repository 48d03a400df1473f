"""Arrow batches inside tasks: bounded slices of rows, texts as byte arrays, result batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Texts that are worked on at once hold about so many bytes; a longer text is alone in its slice.
SLICE_BYTES = 1 << 19


def map_batches(df: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``work`` gets the iterator of a partition's Arrow batches and yields batches of ``schema``. A task that ends gives free memory back."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            release()

    return df.mapInArrow(task, schema)


@cache
def _trim() -> Callable | None:
    """glibc's ``malloc_trim``, where there is one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Gives what Arrow and the allocator hold free back to the system: Python workers outlive their tasks and wait idle for the next stage's."""
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], text: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut into runs of rows whose texts hold about ``size`` bytes; empty ones are left out."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(byte_lengths(batch.column(batch.schema.get_field_index(text))))
        first = 0
        while first < batch.num_rows:
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + size, side="right")))
            yield batch.slice(first, last - first)
            first = last


def byte_lengths(column: pa.Array) -> np.ndarray:
    """UTF-8 bytes of each text; 0 for a null one."""
    offsets = text_offsets(column)
    lengths = np.diff(offsets)
    if column.null_count:
        lengths = np.where(column.is_null().to_numpy(zero_copy_only=False), 0, lengths)
    return lengths


def text_offsets(column: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1]
    return offsets.astype(np.int64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts one after another, and where each text starts and the last one ends."""
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    offsets = text_offsets(column)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def binary_array(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def batch_of(**columns) -> pa.RecordBatch:
    """A batch from arrays; numpy arrays keep their type."""
    arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, list(columns))
