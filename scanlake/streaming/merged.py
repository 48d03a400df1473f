"""A keyed document table whose reads cost its live documents, however many flushes made it.

Keys are dealt to buckets by their hash. A flush reads the buckets it has documents for, merges them with the batch and writes them whole under
its own epoch; other buckets are not touched. The current document of a key is in the last epoch of its bucket, so a reader opens
one version of each bucket. A flush reads only epochs before its own and replaces its own when it is tried again: delivery is
effectively once. ``stale_versions`` lists what no reader opens any more.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.readwriter import DataStreamWriter

from scanlake.operators.documents import latest_documents
from scanlake.streaming.records import EPOCH, FLUSH_SECONDS

BUCKET = "bucket"
BUCKETS = 64


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _versions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    kept = [f for f in schema if f.name not in (EPOCH, BUCKET)]
    return spark.read.schema(T.StructType([*kept, T.StructField(EPOCH, T.LongType()), T.StructField(BUCKET, T.IntegerType())])).parquet(path)


def _live(table: DataFrame, before: int | None = None, touched: Sequence[int] | None = None) -> DataFrame:
    """The last version of each bucket; one row for each bucket comes to the driver, from file footers."""
    known = table if before is None else table.where(F.col(EPOCH) < before)
    known = known if touched is None else known.where(F.col(BUCKET).isin(list(touched)))
    last = known.groupBy(BUCKET).agg(F.max(EPOCH).alias(EPOCH)).collect()
    chosen = [(F.col(BUCKET) == r[BUCKET]) & (F.col(EPOCH) == r[EPOCH]) for r in last]
    return table.where(reduce(lambda a, b: a | b, chosen, F.lit(False)))


def merged_sink(
    stream: DataFrame, path: str, keys: Sequence[str], seq: Sequence[str], buckets: int = BUCKETS
) -> DataStreamWriter:
    """Keyed upsert: larger ``seq`` wins, a later flush wins ties, as ``upsert_documents`` does; read it with ``read_merged``.

    ``buckets`` stays what the table began with; choose it so that one bucket's documents fit a few tasks and a flush touches few. Without
    ``seq`` documents count by arrival. Null keys are a key like others.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            new = latest_documents(batch, keys, seq) if seq else batch.dropDuplicates(list(keys))
            new = new.withColumn(BUCKET, _bucket(keys, buckets))
            touched = [r[0] for r in new.select(BUCKET).distinct().collect()]  # no more than there are buckets
            every = new.withColumn("_arrival", F.lit(1))
            if epoch > 0 and touched:
                old = _live(_versions(spark, path, batch.schema), epoch, touched).drop(EPOCH)
                every = every.unionByName(old.withColumn("_arrival", F.lit(0)))
            merged = latest_documents(every, [*keys, BUCKET], [*seq, "_arrival"]).drop("_arrival")
            merged.repartition(BUCKET).write.partitionBy(BUCKET).mode("overwrite").parquet(f"{path}/{EPOCH}={epoch}")
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(write).trigger(processingTime=f"{FLUSH_SECONDS} seconds")


def read_merged(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The current document of each key, from one version of each bucket; ``schema`` is that of the documents."""
    return _live(_versions(spark, path, schema)).drop(EPOCH, BUCKET)


def stale_versions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``bucket, epoch`` of the folders that no reader opens: they may be removed while no flush runs."""
    all_ = _versions(spark, path, schema).select(BUCKET, EPOCH).distinct()
    last = all_.groupBy(BUCKET).agg(F.max(EPOCH).alias("last"))
    return all_.join(last, BUCKET).where(F.col(EPOCH) < F.col("last")).select(BUCKET, EPOCH)
