"""Bulk payload files as a data source that is written to: both lines of a document in one file, files cut at the bulk size, committed as a job.

A task writes its files under names of its own attempt into a folder beside the payload; the job's commit lists the files of the attempts that
succeeded in a manifest, which is written last and renamed into place. Readers take only files that a manifest lists, so neither a repeated
task nor an aborted job leaves a document twice or in part.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from scanlake.operators.documents import BULK_SIZE

MANIFESTS, PARTS = "manifests", "parts"


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class BulkWriter(DataSourceWriter):
    def __init__(self, path: str, size: int):
        self.path, self.size, self.job = path.rstrip("/"), size, uuid.uuid4().hex

    def _folder(self):
        return fs.FileSystem.from_uri(self.path)

    def write(self, iterator: Iterator[Row]) -> Written:
        files, base = self._folder()
        files.create_dir(f"{base}/{PARTS}", recursive=True)
        task = f"{self.job}-{TaskContext.get().partitionId()}-{uuid.uuid4().hex}"
        names, lines = [], []

        def flush() -> None:
            name = f"{PARTS}/{task}-{len(names)}.ndjson"
            with files.open_output_stream(f"{base}/{name}") as out:
                out.write("".join(lines).encode())
            names.append(name)
            lines.clear()

        for row in iterator:
            lines.append(f"{row['action']}\n{row['body']}\n")
            if len(lines) == self.size:
                flush()
        if lines:
            flush()
        return Written(names)

    def commit(self, messages) -> None:
        files, base = self._folder()
        files.create_dir(f"{base}/{MANIFESTS}", recursive=True)
        names = [name for m in messages if m for name in m.files]
        pending = f"{base}/{MANIFESTS}/_{self.job}"
        with files.open_output_stream(pending) as out:
            out.write("".join(json.dumps({"file": name}) + "\n" for name in names).encode())
        files.move(pending, f"{base}/{MANIFESTS}/{self.job}.json")

    def abort(self, messages) -> None:
        files, base = self._folder()
        for m in messages:
            for name in m.files if m else ():
                files.delete_file(f"{base}/{name}")


class BulkSource(DataSource):
    """``df.write.format("bulk").option("path", ...).option("size", 50)`` for rows of ``bulk_pairs``."""

    @classmethod
    def name(cls) -> str:
        return "bulk"

    def schema(self) -> str:
        return "index string, id string, action string, body string"

    def writer(self, schema: StructType, overwrite: bool) -> BulkWriter:
        size = int(self.options.get("size", BULK_SIZE))
        if size <= 0:
            raise ValueError("size must be greater than 0")
        if overwrite:
            raise ValueError("bulk files are only appended")
        return BulkWriter(self.options["path"], size)


def write_bulk_files(pairs: DataFrame, path: str, size: int = BULK_SIZE) -> None:
    """Write the rows of ``bulk_pairs`` (index, id, action, body) as payload files of at most ``size`` documents below a folder all executors share.

    An empty frame commits a job without files. A null body or action is written as ``null``.
    """
    pairs.sparkSession.dataSource.register(BulkSource)
    rows = pairs.select("index", "id", F.coalesce("action", F.lit("null")).alias("action"), F.coalesce("body", F.lit("null")).alias("body"))
    rows.write.format("bulk").mode("append").option("path", path).option("size", str(size)).save()


def read_bulk_files(spark: SparkSession, path: str) -> DataFrame:
    """``file, pos, line`` of all committed payload files; ``pos`` counts a file's lines from 0."""
    listed = spark.read.schema("file string").json(f"{path}/{MANIFESTS}/*.json")
    whole = spark.read.text(f"{path}/{PARTS}", wholetext=True)
    texts = whole.select(F.concat(F.lit(f"{PARTS}/"), F.element_at(F.split(F.input_file_name(), "/"), -1)).alias("file"), "value")
    lines = texts.join(listed.distinct(), "file", "left_semi").select("file", F.posexplode(F.split(F.rtrim(F.col("value"), F.lit("\n")), "\n")).alias("pos", "line"))
    return lines
