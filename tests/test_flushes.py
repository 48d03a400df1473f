"""Bulk flushes against one document at a time."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from scanlake.operators import flushes

START = datetime(2024, 1, 1)


def brute(rows, size, seconds, clock):
    """A buffer as it fills: a flush before the document that comes too late, or after the one that fills it."""
    out, held, due, flush = {}, 0, None, 0
    for at, number in rows:
        second = (at - START).total_seconds() if at else None
        if held and due is not None and second is not None and second >= due:
            held, flush = 0, flush + 1
        if held and due is None and second is not None:
            held, flush = 0, flush + 1  # documents without a time came first
        if not held and second is not None:
            due = second + seconds if clock == "age" else (second // seconds + 1) * seconds
        held += 1
        out[number] = (flush, held)
        if held == size:
            held, flush = 0, flush + 1
    return out


def rows_of(seed, gaps, number=300):
    r, at, rows = random.Random(seed), START, []
    for i in range(number):
        at += timedelta(seconds=r.choice(gaps))
        rows.append((at, i))
    return rows


CASES = [(1, [0, 0, 1, 30], 5, 10), (2, [0], 7, 10), (3, [100], 4, 10), (4, [0, 1, 2, 3, 4000], 50, 10), (5, [1, 2], 1, 3), (6, [0, 5, 5, 10], 6, 20)]


@pytest.mark.parametrize("clock", flushes.CLOCKS)
@pytest.mark.parametrize(("seed", "gaps", "size", "seconds"), CASES)
def test_equals_one_at_a_time(spark, seed, gaps, size, seconds, clock):
    """Slices of a minute: many begin and end inside flushes, some hold less than one, some hold hundreds."""
    rows = rows_of(seed, gaps)
    docs = spark.createDataFrame([(t, i, "x") for t, i in rows], "ts timestamp, id int, n string").repartition(4)
    found = flushes.bulk_flushes(docs, ["ts", "id"], "minute", size=size, seconds=seconds, clock=clock, origin="2024-01-01")
    assert found.columns == ["ts", "id", "n", "flush", "position"]
    assert {r.id: (r.flush, r.position) for r in found.collect()} == brute(rows, size, seconds, clock)


def test_slices_do_not_matter(spark):
    rows = rows_of(8, [0, 1, 2, 20])
    docs = spark.createDataFrame(rows, "ts timestamp, id int")
    results = [
        {r.id: (r.flush, r.position) for r in flushes.bulk_flushes(docs, ["ts", "id"], cut, size=9, seconds=15, clock="age").collect()}
        for cut in ("second", "hour", F.lit("one"))
    ]
    assert results[0] == results[1] == results[2] == brute(rows, 9, 15, "age")


def test_buffers_nulls_and_an_empty_table(spark):
    rows = rows_of(9, [0, 1, 9], 60)
    early = [(None, 1000), (None, 1001)]
    keyed = [(k, t, i) for k in ("a", None, "") for t, i in early + rows]
    docs = spark.createDataFrame(keyed, "key string, ts timestamp, id int")
    found = flushes.bulk_flushes(docs, ["ts", "id"], "minute", ["key"], size=6, seconds=12, clock="age").collect()
    for key in ("a", None, ""):
        assert {r.id: (r.flush, r.position) for r in found if r.key == key} == brute(early + rows, 6, 12, "age")
    assert flushes.bulk_flushes(docs.where("false"), ["ts", "id"], "minute").count() == 0


@pytest.mark.parametrize("bad", [{"size": 0}, {"seconds": 0}, {"clock": "sun"}])
def test_bad_settings(spark, bad):
    with pytest.raises(ValueError):
        flushes.bulk_flushes(spark.range(1), ["id"], F.lit(1), **bad)
