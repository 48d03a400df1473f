"""Exact top-k search by inner product: exhaustive term-at-a-time accumulation.

Candidates are split over partitions of bounded size. A partition turns its vectors into postings (for each
dimension the rows with a weight other than 0); blocks of query vectors stream past it. For each dimension in
which a query has a weight, the weighted postings are added into the query's dense array of scores. The k best of
the partition are selected, and the partitions' selections meet in a window with a limit per group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors in a candidate partition, and queries in a block.
PARTITION_ROWS = 8192
QUERY_ROWS = 256

_PARTIAL = "query_id long, vec_id long, score long"


def whole_weights(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component as long; null if the vector is null or holds null, NaN or infinity."""
    usable = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    )
    return F.when(
        vector.isNotNull() & usable, F.transform(vector, lambda x: _checked(F.floor(x.cast("double") * scale).cast("long"), F.size(vector)))
    )


def _checked(weight: Column, size: Column) -> Column:
    """The weight, or an error where a product of two such vectors could pass 64 bits."""
    double = weight.cast("double")
    fits = double * double * size < F.lit(float(1 << 63))
    return F.when(fits, weight).otherwise(F.raise_error(F.lit("a vector's components are too large for scores of 64 bits")).cast("long"))


def exact_topk(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: int = 256,
    partition_rows: int = PARTITION_ROWS,
) -> DataFrame:
    """The k best candidates of every query: ``query_id, rank (from 1), vec_id, score``.

    Every row is a candidate of every query but itself; rows that share the query's id are taken as the query itself.
    Ties go to the smaller id; queries with fewer candidates return all of them. Vectors that are null, or hold a null
    or non-finite component, and rows without id take no part. Vectors of unequal length are compared on the dimensions that
    both have. An empty vector scores 0 with everything. Repeated rows (same id and vector) are each a row; a query id with
    several vectors is asked once, with the least of them. Components whose products could pass 64 bits are an error. Other columns are ignored.
    """
    table = (
        vectors.select(F.col(id_column).cast("long").alias("id"), whole_weights(F.col(vector_column), scale).alias("w"), is_query.alias("q"))
        .where(F.col("w").isNotNull() & F.col("id").isNotNull())
    )
    rows = max(1, vectors.count())
    parts = -(-rows // partition_rows)
    candidates = table.select(
        F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"), F.lit(0).alias("side"), "id", "w"
    )
    # The stated query set against all rows: each query visits every candidate partition.
    asked = table.where(F.coalesce(F.col("q"), F.lit(False))).groupBy("id").agg(F.min("w").alias("w"))
    queries = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(1).alias("side"), "id", "w"
    )
    partial = (
        candidates.unionByName(queries)
        .repartitionById(parts, "part")
        .sortWithinPartitions("part", "side", "id")
        .mapInArrow(_search(k), _PARTIAL)
    )
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (
        partial.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _search(k: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ids, weights, postings = None, [], [], None
        for batch in batches:
            parts = batch.column(0).to_numpy()
            sides = batch.column(1).to_numpy()
            keys = parts.astype(np.int64) * 2 + sides
            cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1), len(keys)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if part != parts[a]:
                    part, ids, weights, postings = parts[a], [], [], None
                piece = batch.slice(a, b - a)
                if sides[a] == 0:
                    ids.append(piece.column(2).to_numpy())
                    weights.append(piece.column(3))
                elif ids:
                    if postings is None:
                        postings = _postings(ids, weights)
                    for first in range(0, b - a, QUERY_ROWS):
                        yield from _answers(piece.slice(first, QUERY_ROWS), postings, k)

    return work


def _postings(ids: list, weights: list):
    """Ids in ascending order and, for each dimension, (rows, weights) of the entries other than 0."""
    ids = np.concatenate(ids)
    column = pa.concat_arrays(weights)
    flat = column.flatten().to_numpy()
    sizes = np.diff(column.offsets.to_numpy())
    rows = np.repeat(np.arange(len(ids)), sizes)
    dims = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    kept = np.flatnonzero(flat)
    order = kept[np.argsort(dims[kept], kind="stable")]
    cuts = np.searchsorted(dims[order], np.arange(int(sizes.max(initial=0)) + 1))
    lists = []
    for a, b in zip(cuts, cuts[1:], strict=False):
        at = order[a:b]
        # A list that holds every row needs no row numbers.
        lists.append((None if b - a == len(ids) else rows[at], flat[at]))
    return ids, lists


def _answers(queries: pa.RecordBatch, postings, k: int) -> Iterator[pa.RecordBatch]:
    ids, lists = postings
    found_query, found_id, found_score = [], [], []
    for query, vector in zip(queries.column(2).to_numpy(), queries.column(3), strict=True):
        scores = np.zeros(len(ids), np.int64)
        for weight, (rows, values) in zip(vector.values.to_numpy(), lists, strict=False):
            if weight == 0:
                continue
            if rows is None:
                scores += weight * values
            else:
                scores[rows] += weight * values
        other = ids != query
        scores, names = scores[other], ids[other]
        if len(scores) > k:
            least = np.partition(scores, len(scores) - k)[len(scores) - k]
            chosen = np.flatnonzero(scores > least)
            ties = np.flatnonzero(scores == least)
            ties = ties[np.argsort(names[ties], kind="stable")][: k - len(chosen)]
            chosen = np.concatenate((chosen, ties))
        else:
            chosen = np.arange(len(scores))
        found_query.append(np.full(len(chosen), query, np.int64))
        found_id.append(names[chosen])
        found_score.append(scores[chosen])
    if found_query:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x).astype(np.int64)) for x in (found_query, found_id, found_score)],
            ["query_id", "vec_id", "score"],
        )
