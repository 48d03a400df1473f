"""An inverted index as a table: written once, read by term.

A row is a term in a range of documents: their ids as offsets in the range, and the places of the term in each. A frequent term is thus
split over as many rows as there are ranges, and no row grows with the table. The table is partitioned by a bucket of the term and sorted by
term inside a file, so a query opens the buckets of its terms and skips row groups without them. Offsets and places rise and are
written delta-coded by the file format.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from zlib import crc32

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake.functions.binding import bound
from scanlake.operators.search import _NO_WORD

BUCKETS = 64
#: Documents of one range: what the postings of one term in one row hold at most.
RANGE = 4096
#: Ranges that share a task when the index is written; each such part of a bucket has its own file.
RANGES = 64


def bucket_of(term: str) -> int:
    """The bucket of a term; the same as in the table."""
    return crc32(term.encode()) % BUCKETS


def words_of(query: str) -> list[str]:
    """The words of a query, in order."""
    words = [w for w in re.split(r"\W+", query.lower()) if w]
    if not words:
        raise ValueError("the query needs a word")
    return words


def write_text_index(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", span: int = RANGE) -> None:
    """Write the index of ``text``: words are runs of letters, digits and underscores, in lower case, and count from 0 in a document.

    ``id`` is an integer; rows with one id are found as one document that has the words of all. Rows without an id or a text
    are left out.
    """
    index_rows(docs, id, text, span).sortWithinPartitions("bucket", "term", "first").write.partitionBy("bucket").option(
        "parquet.writer.version", "v2"
    ).mode("errorifexists").parquet(path)


def index_rows(docs: DataFrame, id: str, text: str, span: int) -> DataFrame:
    """The rows of the index, those of one file in one task.

    The places of a word are put together inside its text; the postings are shuffled once, to the file they are written to.
    """
    # An empty word, before a leading mark or behind a last one, keeps its number but is no term.
    split = F.split(F.lower(F.col(text)), f"{_NO_WORD}+")
    words = F.filter(F.transform(split, lambda w, i: F.struct(w.alias("term"), i.alias("place"))), lambda w: w["term"] != "")
    by_term = _grouped(F.sort_array(words), "term", lambda run: F.transform(run, lambda w: w["place"]))
    texts = docs.where(F.col(id).isNotNull() & F.col(text).isNotNull())
    postings = texts.select(F.col(id).cast("long").alias("id"), F.explode(by_term).alias("w"))
    range_ = F.floor(F.col("id") / span).cast("long")
    bucket = F.crc32(F.col("w.key").cast("binary")) % BUCKETS
    slot = (F.floor(range_ / RANGES) * BUCKETS + bucket).cast("long").alias("slot")
    dealt = postings.select(slot, F.col("w.key").alias("term"), "id", F.col("w.found").alias("places")).repartition("slot")
    offset = (F.col("id") - F.col("range") * span).cast("int").alias("offset")
    rows = dealt.withColumn("range", range_).groupBy("slot", "term", "range").agg(F.sort_array(F.collect_list(F.struct(offset, "places"))).alias("d"))
    # Rows with one id become one.
    together = _grouped(F.col("d"), "offset", lambda run: F.sort_array(F.flatten(F.transform(run, lambda x: x["places"]))))
    together = F.transform(together, lambda x: F.struct(x["key"].alias("offset"), x["found"].alias("places")))
    repeated = F.size(F.array_distinct(F.col("d.offset"))) < F.size("d")
    rows = rows.withColumn("d", F.when(repeated, together).otherwise(F.col("d")))
    return rows.select(
        "term", (F.col("range") * span).alias("first"), F.col("d.offset").alias("offsets"), F.col("d.places").alias("places"),
        F.pmod("slot", F.lit(BUCKETS)).cast("int").alias("bucket"),
    )


def _grouped(rows: Column, key: str, found: Callable[[Column], Column]) -> Column:
    """A sorted array of structs by ``key``, as (key, found): what is made of the rows of each key. Null for an empty array."""

    def runs(sorted_: Column) -> Column:
        of = lambda i: F.element_at(sorted_, i)[key]
        firsts = F.filter(F.sequence(F.lit(1), F.size(sorted_)), lambda i: (i == 1) | (of(F.greatest(i - 1, F.lit(1))) != of(i)))

        def run(at: Column, first: Column, k: Column) -> Column:
            after = F.coalesce(F.get(at, k + 1), F.size(sorted_) + 1)
            return F.struct(of(first).alias("key"), found(F.slice(sorted_, first, after - first)).alias("found"))

        return bound(firsts, lambda at: F.transform(at, lambda first, k: run(at, first, k)))

    return bound(rows, lambda sorted_: F.when(F.size(sorted_) > 0, runs(sorted_)))


def read_terms(spark: SparkSession, path: str, terms: Sequence[str]) -> DataFrame:
    """The rows of some terms: only their buckets are opened, and the terms go down to the scan."""
    kind = "term string, first long, offsets array<int>, places array<array<int>>, bucket int"
    wanted = sorted(set(terms))
    return spark.read.schema(kind).parquet(path).where(F.col("bucket").isin(sorted({bucket_of(t) for t in wanted})) & F.col("term").isin(wanted))


def _documents(rows: DataFrame) -> DataFrame:
    return rows.select("first", F.explode("offsets").alias("offset")).select((F.col("first") + F.col("offset")).alias("id"))


def match_index(spark: SparkSession, path: str, query: str, operator: str = "or") -> DataFrame:
    """``id`` of the documents with any word of the query (``or``), with every one (``and``), or with all in a row (``phrase``).

    Only the terms of the query are read; what is shuffled is a number for each posting, combined before.
    """
    words = words_of(query)
    rows = read_terms(spark, path, words)
    if operator == "or":
        return _documents(rows).distinct()
    if operator == "and":
        found = _documents(rows).groupBy("id").agg(F.count("*").alias("n"))
        return found.where(F.col("n") == len(set(words))).select("id")
    if operator != "phrase":
        raise ValueError("operator is 'or', 'and' or 'phrase'")
    # Where the phrase would begin, for each place of each of its words; it does where all of them agree.
    at = F.create_map(*[F.lit(x) for w in sorted(set(words)) for x in (w, [i for i, v in enumerate(words) if v == w])])
    zipped = rows.select("term", "first", F.explode(F.arrays_zip("offsets", "places")).alias("d"))
    begins = zipped.select((F.col("first") + F.col("d.offsets")).alias("id"), F.explode("d.places").alias("place"), at[F.col("term")].alias("at"))
    begins = begins.select("id", "place", F.explode("at").alias("i")).groupBy("id", (F.col("place") - F.col("i")).alias("begin")).agg(F.count("*").alias("n"))
    return begins.where(F.col("n") == len(words)).select("id").distinct()
