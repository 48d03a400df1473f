"""Queries over indexed fields."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake.operators import search as ops
from scanlake.operators import text_index
from scanlake.plans.findings import reports
from scanlake.plans.query import Registry
from scanlake.operators.findings import vulnerability_array
from scanlake.sources.tables import table
from scanlake.streaming.records import fresh_folder

SEARCH = Registry()


@SEARCH.add(
    "terms_count",
    """SELECT l_suppkey, count(*) AS count FROM lineitem WHERE l_returnflag = 'R'
       GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def terms(spark: SparkSession, sf: str) -> DataFrame:
    return ops.terms_count(table(spark, sf, "lineitem"), "l_suppkey", 10, F.col("l_returnflag") == "R")


@SEARCH.add(
    "text_match",
    """
    WITH w AS (SELECT doc_id, regexp_split_to_array(lower("text"), '[^\\p{L}\\p{N}_]+') AS words FROM documents)
    SELECT doc_id, list_contains(words, 'token') OR list_contains(words, 'être') OR list_contains(words, 'thand') AS any_word,
           list_contains(words, 'the') AND list_contains(words, 'of') AS all_words
    FROM w
    """,
)
def words(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id",
        ops.text_match(F.col("text"), "Token ÊTRE thand").alias("any_word"),
        ops.text_match(F.col("text"), "the of", "and").alias("all_words"),
    )


@SEARCH.add(
    "nested_match",
    """SELECT l_orderkey, l_partkey FROM lineitem
       WHERE l_linenumber = 5 AND l_returnflag = 'R'""",
)
def nested(spark: SparkSession, sf: str) -> DataFrame:
    scans = reports(spark, sf).withColumn("vulnerabilities", vulnerability_array(F.col("results")))
    hit = ops.nested_match(
        scans,
        "vulnerabilities",
        lambda v: (v["severity"] == "7.4") & F.endswith(v["id"], F.lit("-2-2")) & (v["cve"] == ""),
    )
    return hit.select("l_orderkey", "l_partkey")


@SEARCH.add(
    "scans_per_day",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS count FROM events GROUP BY 1, 2""",
)
def per_day(spark: SparkSession, sf: str) -> DataFrame:
    return ops.per_day(table(spark, sf, "events"), "ts", ["event_type"])


@SEARCH.add(
    "latest_scan",
    """SELECT user_id, event_id, event_type
       FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def latest(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    return ops.latest_scan(events, ["user_id"], ["ts", "event_id"], ["event_id", "event_type"])


@SEARCH.add(
    "text_index_match",
    """
    WITH w AS (SELECT doc_id, regexp_split_to_array(lower("text"), '[^\\p{L}\\p{N}_]+') AS words FROM documents)
    SELECT doc_id, list_contains(words, 'token') OR list_contains(words, 'être') OR list_contains(words, 'thand') AS any_word,
           list_contains(words, 'the') AND list_contains(words, 'of') AS all_words,
           contains(' ' || array_to_string(words, ' ') || ' ', ' of the ') AS phrase
    FROM w
    """,
)
def indexed_words(spark: SparkSession, sf: str) -> DataFrame:
    """The index is written, then asked three times."""
    documents, path = table(spark, sf, "documents"), fresh_folder(spark, "text-index")
    text_index.write_text_index(documents, path)
    found = documents.select("doc_id")
    for name, query, operator in (("any_word", "Token ÊTRE thand", "or"), ("all_words", "the of", "and"), ("phrase", "of the", "phrase")):
        ids = text_index.match_index(spark, path, query, operator).select(F.col("id").alias("doc_id"), F.lit(True).alias(name))
        found = found.join(ids, "doc_id", "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return found
