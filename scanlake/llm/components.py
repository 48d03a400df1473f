"""Connected components of a link table, by alternating large and small stars on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanlake.llm.shared import written


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links`` (``a, b``, of any one ordered type): the label is the component's least node.

    A large star links each larger neighbour of a node to the node's least neighbour; a small star does so for the smaller ones. The number of
    rounds grows with the logarithm of the size. Minima are combined before the shuffle, and each round is written to the
    shared folder, so a node with very many links is neither collected nor recomputed.
    """
    edges = written(links.where("a <> b").select("a", "b").distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = written(
            both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct(), "large"
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        edges = written(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "small")
        state = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("label"))
    ).distinct()
