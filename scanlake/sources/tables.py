"""Parquet tables."""

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a folder; columns and filters are pushed into the scan."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
