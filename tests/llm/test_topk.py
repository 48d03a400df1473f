"""Exact top-k against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from scanlake.llm import topk


def brute(rows, k, divisor):
    usable = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable[i] = [math.floor(256 * x) for x in v]
    out = []
    for q in usable:
        if q % divisor == 0:
            scores = [(-sum(a * b for a, b in zip(usable[q], usable[c], strict=False)), c) for c in usable if c != q]
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(sorted(scores)[:k])]
    return sorted(out)


@pytest.mark.parametrize(("seed", "rows", "part"), [(1, 300, 40), (2, 4, 8192), (3, 200, 8192)])
def test_equals_brute_force(spark, seed, rows, part):
    r = random.Random(seed)
    base = [[r.choice([0.0, 0.0, 0.5, -1.25, r.uniform(-2, 2)]) for _ in range(7)] for _ in range(12)]
    data = [(i, r.choice(base) if i % 2 else [r.uniform(-1, 1) for _ in range(7)]) for i in range(rows)]
    data[0] = (0, [float("nan")] + [0.0] * 6)
    data[1] = (1, None)
    if rows > 10:
        data[5] = (5, [None] + [1.0] * 6)
        data[10] = (10, [float("inf")] + [1.0] * 6)
        data[15] = (15, [])
        data.append((None, [1.0] * 7))
    # Halves of single precision, so that both sides see the same numbers.
    schema = "vec_id long, embedding array<double>, score int, rank string"
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in data], schema).repartition(3)
    found = topk.exact_topk(frame, F.col("vec_id") % 5 == 0, 5, partition_rows=part)
    assert sorted(map(tuple, found.collect())) == brute(data, 5, 5)


def test_nothing_one_row_and_repeated_rows(spark):
    schema = "vec_id long, embedding array<float>"
    query = F.col("vec_id") % 50 == 0
    assert topk.exact_topk(spark.createDataFrame([], schema), query).count() == 0
    assert topk.exact_topk(spark.createDataFrame([(50, [1.0])], schema), query).count() == 0
    rows = [(50, [1.0, 2.0])] * 2 + [(3, [1.0, 0.5])] * 2
    found = topk.exact_topk(spark.createDataFrame(rows, schema), query).collect()
    assert sorted(map(tuple, found)) == [(50, 1, 3, 256 * 256 + 512 * 128), (50, 2, 3, 256 * 256 + 512 * 128)]


def test_a_query_id_with_several_vectors_does_not_depend_on_partitions(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [3.0, 0.0]), (2, [0.0, 4.0])]
    for parts in (1, 2, 5):
        frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(parts)
        found = topk.exact_topk(frame, F.col("vec_id") % 50 == 0).collect()
        assert sorted(map(tuple, found)) == [(0, 1, 2, 256 * 1024), (0, 2, 1, 0)]


def test_scores_past_64_bits_are_an_error(spark):
    frame = spark.createDataFrame([(0, [1e18]), (1, [1e18])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        topk.exact_topk(frame, F.col("vec_id") % 50 == 0).collect()
