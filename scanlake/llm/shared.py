"""Written intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from scanlake.session import shared_dir


def fresh_table(spark: SparkSession, name: str) -> str:
    """A path that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: its lineage is cut there.

    Files outlive the executors that wrote them, so a lost executor costs only the tasks it was running.
    """
    spark = df.sparkSession
    path = fresh_table(spark, name)
    writer = df.write.mode("errorifexists")
    if by:
        writer = writer.partitionBy(*by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """While it lasts, Arrow batches have at most so many rows: for rows of many kilobytes. The setting is put back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
