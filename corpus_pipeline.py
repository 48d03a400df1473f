"""From raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir), where docs has the columns of ``documents``, and returns a DataFrame that is written as Parquet
and read again as the next one's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scanlake.llm import decontam, embed_quality, entropy_secrets, jaccard, packing
from scanlake.llm.shared import documents, written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the table ``labels``, accepts."""
    return embed_quality.accepted(docs, documents(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, with the smallest id, of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return jaccard.first_of_groups(docs, words=5, num=80, den=100)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the table ``benchmark``, verbatim or with other names, numbers or units."""
    return decontam.without_contaminated(docs, documents(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked; n_chars follows the text."""
    return entropy_secrets.without_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences."""
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", mask_secrets),
    ("packing", pack),
]

#: A classifier is no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = documents(spark, sf_dir)
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, f"stage{number + 1}")
    return docs
