"""Listing of folder trees, level by level."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from scanlake.session import shared_dir

_ENTRIES = "ts timestamp, path string, is_dir boolean, size long, waits boolean"
_KIND = pa.schema(
    [("ts", pa.timestamp("us", "UTC")), ("path", pa.string()), ("is_dir", pa.bool_()), ("size", pa.int64()), ("waits", pa.bool_())]
)
_ROWS = 10_000


def folder_inventory(spark: SparkSession, root: str, share: int = 1000) -> DataFrame:
    """Files and folders below a folder as (ts, path, is_dir, size); contents are never read.

    The walk goes in rounds. A task lists at most ``share`` folders in a round, those it was dealt first and then what it finds
    below them; folders that it does not get to wait and are dealt out anew, so that one large or deep folder is spread
    over all tasks. Each round is written to the shared folder: a lost executor costs the tasks it was running, and the driver
    sees only the number of waiting folders. The entries of one folder are held in one task while it is listed.

    Empty folders are listed; folders that cannot be read, and links to folders, are listed but not entered; a missing root has
    no rows. ``root`` is a path, or a URI that pyarrow can open on the executors; a plain path must be mounted there.
    """
    target = f"{shared_dir(spark)}/inventory-{uuid.uuid4().hex}"
    waiting, number, rounds = spark.createDataFrame([(base_path(root),)], "path string"), 1, []
    while number:
        parts = -(-number // share)
        # Few folders are dealt to as many tasks as there are cores; they are what the tree is spread from.
        parts = max(parts, min(number, spark.sparkContext.defaultParallelism))
        # The first round lists the root alone, so that its folders go to many tasks at once.
        limit = share if rounds else 1
        rounds.append(f"{target}/round={len(rounds)}")
        waiting.repartition(parts).mapInArrow(_lister(root, limit), _ENTRIES).write.parquet(rounds[-1])
        waiting = spark.read.schema(_ENTRIES).parquet(rounds[-1]).filter("waits").select("path")
        number = waiting.count()
    return spark.read.schema(_ENTRIES).parquet(*rounds).drop("waits")


def base_path(root: str) -> str:
    """The path of a folder without the scheme of its URI: listed paths begin with it."""
    return fs.FileSystem.from_uri(root)[1] if _is_uri(root) else root


def _is_uri(root: str) -> bool:
    return ":/" in root


def open_system(root: str) -> fs.FileSystem:
    """The file system of a path or URI."""
    return fs.FileSystem.from_uri(root)[0] if _is_uri(root) else fs.LocalFileSystem()


def _entries(system: fs.FileSystem, folder: str) -> list[fs.FileInfo]:
    try:
        return system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    except OSError:
        return []


def _lister(root: str, share: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system = open_system(root)
        todo = [path for batch in batches for path in batch.column(0).to_pylist()]
        rows: list[tuple] = []
        # Waiting folders are rows already listed by this task, so their rows are held back until their turn or its end.
        ahead: list[tuple] = []
        listed = 0
        while todo or ahead:
            if todo:
                folder = todo.pop()
            elif listed < share:
                entry = ahead.pop()
                rows.append((*entry, False))
                folder = entry[1]
            else:
                break
            listed += 1
            for entry in _entries(system, folder):
                is_dir = entry.type == fs.FileType.Directory
                row = (entry.mtime, entry.path, is_dir, entry.size or 0)
                if is_dir and not _is_link(system, entry.path):
                    ahead.append(row)
                else:
                    rows.append((*row, False))
            while len(rows) >= _ROWS:
                yield _batch(rows[:_ROWS])
                del rows[:_ROWS]
        rows += [(*entry, True) for entry in ahead]
        for at in range(0, len(rows), _ROWS):
            yield _batch(rows[at : at + _ROWS])

    return work


def _is_link(system: fs.FileSystem, path: str) -> bool:
    """Local links are not followed: they may lead back up."""
    return isinstance(system, fs.LocalFileSystem) and os.path.islink(path)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _KIND, strict=True)], schema=_KIND)
