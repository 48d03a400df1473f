"""Memory of Python workers: what a task gives back, and how much of a batch it takes at once."""

import os
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from scanlake.llm import arrow, entropy_secrets


def run(df, batches):
    """A frame whose mapInArrow gives the batches of one task in this process."""
    return SimpleNamespace(mapInArrow=lambda work, schema: list(work(iter(batches))), **df)


def resident():
    return int(Path("/proc/self/statm").read_text().split()[1]) * os.sysconf("SC_PAGE_SIZE") / 1e6


@pytest.mark.skipif(arrow._trim() is None, reason="not glibc")
def test_a_task_that_ends_gives_free_memory_back():
    most, kept = [], []

    def work(batches):
        for batch in batches:
            # Below the size that is mapped alone; the last one keeps the heap's end in use.
            parts = [np.ones(8192) for _ in range(3000)]
            kept.append(parts.pop())
            most.append(resident())
            yield batch

    before = resident()
    batch = pa.RecordBatch.from_arrays([pa.array([1])], ["x"])
    assert arrow.map_batches(run({}, [batch]), work, "x long") == [batch]
    assert most[0] - before > 150
    assert resident() - before < 50


def test_masking_takes_slices_of_large_batches():
    texts = [f"{i} password=abcdefghijklmnop " + "word " * 20_000 for i in range(30)] + [None, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(32)), pa.array(texts)], ["doc_id", "text"])
    parts = entropy_secrets.without_secrets(run({"schema": batch.schema, "columns": ["doc_id", "text"]}, [batch, batch.slice(0, 0)]))
    assert max(p.num_rows for p in parts) < 10
    got = pa.Table.from_batches(parts)
    assert got.column(0).to_pylist() == list(range(32))
    assert got.column(1).to_pylist() == [entropy_secrets.masked(t) if t else t for t in texts]
