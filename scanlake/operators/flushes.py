"""Bulk flushes by size or time, over one buffer for all indices.

A buffer is flushed when it holds ``size`` documents, and when its time is up. So each flush begins where the one before ended: a chain over all
documents of a buffer. The chain is cut into slices of the order. From a document that begins a flush, the next beginning depends on the
times behind it alone, and the first beginning inside a slice is one of its first ``size`` documents. A slice is therefore
summed up by a map with at most ``size`` entries: first beginning -> last beginning and number of flushes. Maps are put together slice by
slice, from the state (documents held, deadline, flushes so far) at one slice's entry to the next one's; then every slice
finds its own flushes from its entry state. Documents are shuffled by (buffer, slice); only their times go through Python.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanlake.operators.documents import BULK_SIZE
from scanlake.operators.ordered import SLICE, group_names, restored, slice_names, sliced, within_slice

# Fixed value: seconds between flushes of a buffer.
FLUSH_SECONDS = 10

#: When a buffer's time is up: at the next tick of a clock that runs all the time, or when its first document is so old.
CLOCKS = ("tick", "age")

_EARLY = -(1 << 61)  # the time of documents without one
_BUFFER = "_buffer"


def deadlines(clock: str, micros: int, origin: int) -> Callable[[np.ndarray], np.ndarray]:
    """From the time of a buffer's first document to the time it is flushed at."""
    if clock == "age":
        return lambda t: t + micros
    return lambda t: (t - origin) // micros * micros + (micros + origin)


def next_begins(times: np.ndarray, size: int, due: Callable) -> np.ndarray:
    """For each document, if it begins a flush, the place of the document that begins the next one; the number of documents if none does."""
    places = np.minimum(np.arange(len(times)) + size, np.searchsorted(times, due(times)))
    return np.minimum(places, len(times))


def slice_map(times: np.ndarray, size: int, due: Callable) -> tuple[list[int], list[int], list[int]]:
    """For each of the first ``size`` documents as first beginning: the last beginning, its deadline, and how many begin."""
    n, head = len(times), min(size, len(times))
    following = next_begins(times, size, due).tolist()
    last, count = [0] * n, [0] * n
    for i in range(n - 1, -1, -1):
        j = following[i]
        last[i], count[i] = (i, 1) if j == n else (last[j], count[j] + 1)
    return last[:head], due(times[last[:head]]).tolist(), count[:head]


def first_begin(heads: np.ndarray, held: int, deadline: int, size: int) -> int:
    """Where a slice's first flush begins, given the documents held before it; a place behind the slice if none does."""
    return min(size - held, int(np.searchsorted(heads, deadline))) if held else 0


def _maps(names: list[str], size: int, due: Callable):
    def work(key: tuple, table: pa.Table) -> pa.Table:
        times = np.sort(table.column("_at").to_numpy())
        last, deadline, count = slice_map(times, size, due)
        row = {n: k.as_py() for n, k in zip(names, key, strict=True)}
        row |= {"n": len(times), "heads": times[:size].tolist(), "last": last, "deadline": deadline, "count": count}
        columns = {n: pa.array([v], table.schema.field(n).type if n in names else None) for n, v in row.items()}
        lists = pa.list_(pa.int64())
        return pa.table({n: c.cast(lists) if pa.types.is_list(c.type) else c for n, c in columns.items()})

    return work


def _entries(names: list[str], groups: int, size: int):
    """Rows by buffer and slice: the state at each slice's entry. Only the state is kept from row to row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buffer, held, deadline, flushes = None, 0, 0, 0
        for batch in batches:
            col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            keys = list(zip(*[col[n].to_pylist() for n in names[:groups]], strict=True))
            out = []
            for key, n, heads, last, due, count in zip(keys, *[col[c].to_pylist() for c in ("n", "heads", "last", "deadline", "count")], strict=True):
                if key != buffer:
                    buffer, held, deadline, flushes = key, 0, 0, 0
                out.append((held, deadline, flushes))
                first = first_begin(np.array(heads, np.int64), held, deadline, size)
                if first >= n:
                    held += n
                else:
                    held, deadline, flushes = n - last[first], due[first], flushes + count[first]
            states = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([*[col[n] for n in names], *states], [*names, "held", "due", "flushes"])

    return work


def _begins(names: list[str], size: int, due: Callable):
    """The documents of a slice that begin a flush, by their place in it."""

    def work(key: tuple, table: pa.Table) -> pa.Table:
        times = np.sort(table.column("_at").to_numpy())
        held, deadline, flushes = (table.column(c)[0].as_py() for c in ("held", "due", "flushes"))
        following, at, i = next_begins(times, size, due).tolist(), [], first_begin(times[:size], held, deadline, size)
        while i < len(times):
            at.append(i)
            i = following[i]
        same = {n: pa.array([k.as_py()] * len(at), table.schema.field(n).type) for n, k in zip(names, key, strict=True)}
        return pa.table(same | {"_place": pa.array(at, pa.int64()), "_flush": pa.array(np.arange(len(at)) + flushes, pa.int64())})

    return work


def bulk_flushes(
    docs: DataFrame,
    order: Sequence[str],
    slice_by: Column | str,
    keys: Sequence[str] = (),
    size: int = BULK_SIZE,
    seconds: float = FLUSH_SECONDS,
    clock: str = "tick",
    origin: str = "1970-01-01",
) -> DataFrame:
    """Add flush (from 0, per buffer) and position (from 1): what one buffer would send together.

    ``order`` begins with the time of arrival and is unique per buffer. Without ``keys`` all documents, of whatever index, share one buffer, as
    those of one process do; keys name the process otherwise. A flush ends at ``size`` documents or when its time is up: with ``tick`` at each
    multiple of ``seconds`` since ``origin``, with ``age`` when its first document is ``seconds`` old. A document that comes at that very time
    belongs to the next flush. Documents without a time come first and at once. Null keys are a buffer like others; an empty table
    gives no rows.

    ``slice_by`` cuts the order into slices that each fit a task, see ``ordered``; a buffer's slices are put together row by
    row with constant memory.
    """
    if size <= 0:
        raise ValueError("size must be greater than 0")
    if seconds <= 0:
        raise ValueError("seconds must be greater than 0")
    if clock not in CLOCKS:
        raise ValueError(f"clock must be one of {CLOCKS}")
    start = int(np.datetime64(origin, "us").astype(np.int64))
    due = deadlines(clock, int(seconds * 1_000_000), start)
    buffers = list(keys)
    if not buffers:
        docs, buffers = docs.withColumn(_BUFFER, F.lit(0)), [_BUFFER]
    names = slice_names(buffers)
    at = F.coalesce(F.unix_micros(F.col(order[0]).cast("timestamp")), F.lit(_EARLY))
    rows = sliced(docs, buffers, order, slice_by).withColumn("_at", at)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    by = ", ".join(f"{n} {kinds[n]}" for n in names)

    times = rows.select(*names, "_at")
    lists = ", ".join(f"{n} array<long>" for n in ("heads", "last", "deadline", "count"))
    maps = times.groupBy(*names).applyInArrow(_maps(names, size, due), f"{by}, n long, {lists}")
    groups = group_names(buffers)
    entries = (
        maps.repartition(*groups)
        .sortWithinPartitions(*groups, SLICE)
        .mapInArrow(_entries(names, len(groups), size), f"{by}, held long, due long, flushes long")
    )
    begins = times.join(entries, names).groupBy(*names).applyInArrow(_begins(names, size, due), f"{by}, _place long, _flush long")

    local = within_slice(buffers, ["_at", *order])
    upto = local.rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("_place", F.row_number().over(local).cast("long") - 1)
    marked = placed.join(begins, [*names, "_place"], "left")
    marked = marked.withColumn("_begin", F.last(F.when(F.col("_flush").isNotNull(), F.struct("_flush", "_place")), True).over(upto))
    rest = [c for c in docs.columns if c not in buffers]
    found = marked.join(entries.select(*names, "held", "flushes"), names).select(
        *restored(buffers), *rest,
        F.coalesce(F.col("_begin._flush"), F.col("flushes") - 1).alias("flush"),
        (F.col("_place") + 1 + F.coalesce(-F.col("_begin._place"), F.col("held"))).cast("int").alias("position"),
    )
    return found.select(*[c for c in docs.columns if c != _BUFFER], "flush", "position")
