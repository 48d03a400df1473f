import random
import re
from datetime import datetime, timedelta

import pytest

from scanlake.operators import monitoring as ops

START = datetime(2024, 1, 1)


@pytest.mark.parametrize(
    "glob, yes, no",
    [
        ("*_queue", ["a_queue", "_queue"], ["a_queue2", "queue"]),
        ("q?", ["q1"], ["q", "q12"]),
        ("q[a-c]x", ["qax", "qcx"], ["qdx", "q-x"]),
        ("q[^a]", ["qb"], ["qa"]),
        ("a.b*", ["a.b", "a.bc"], ["axb"]),
        (r"a\*", ["a*"], ["ab"]),
        ("a[", ["a["], ["a"]),
    ],
)
def test_glob(glob, yes, no):
    pattern = re.compile(ops.glob_regex(glob).replace("(?s:.*)", "[\\s\\S]*").replace("(?s:.)", "[\\s\\S]"))
    assert all(pattern.match(x) for x in yes) and not any(pattern.match(x) for x in no)


def test_discover_queues_sorted_lists_only(spark):
    rows = [("b_queue", "list"), ("a_queue", "list"), ("c_queue", "string"), ("a_queue", "list"), ("other", "list")]
    df = ops.discover_queues(spark.createDataFrame(rows, "queue string, key_type string"))
    assert [r.queue for r in df.collect()] == ["a_queue", "b_queue"]


def watch_queues(samples):
    """Tick by tick: a queue missing from a tick is forgotten."""
    out, stats = {}, {}
    for tick in sorted({ts for _, ts, _ in samples}):
        here = {q: n for q, ts, n in samples if ts == tick}
        stats = {q: s for q, s in stats.items() if q in here}
        for q, n in here.items():
            length, at, rate = stats.get(q, (0, None, 0.0))
            if length > 0:
                rate = (n - length) / ((tick - at).total_seconds() / 60)
            stats[q] = (n, tick, rate)
            out[q, tick] = rate
    return out


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("unit", ["minute", "hour", "year"])
def test_queue_rates_equal_tick_by_tick(spark, seed, unit):
    random.seed(seed)
    samples = []
    for i in range(120):
        ts = START + timedelta(seconds=20 * i + random.randint(0, 5))
        for q in ("a", "b", "c"):
            if random.random() < 0.8:
                samples.append((q, ts, random.choice([0, 0, 1, 5, 9])))
    df = spark.createDataFrame(samples, "queue string, ts timestamp_ntz, length long")
    got = {(r.queue, r.ts): r.rate for r in ops.queue_rates(df, slice_by=unit).collect()}
    expected = watch_queues(samples)
    assert got.keys() == expected.keys()
    assert all(got[k] == pytest.approx(expected[k], abs=1e-9) for k in got)


def test_queue_rates_with_a_pause_limit(spark):
    rows = [("q", START + timedelta(seconds=s), n) for s, n in ((0, 5), (5, 7), (20, 9), (25, 9), (30, 0), (35, 4))]
    df = spark.createDataFrame(rows, "queue string, ts timestamp_ntz, length long")
    got = [r.rate for r in ops.queue_rates(df, max_gap_seconds=7.5).orderBy("ts").collect()]
    assert got == pytest.approx([0, 24, 0, 0, -108, -108])


def watch_folder(samples):
    out, last, at, rate = {}, 0, None, 0.0
    for ts, size in sorted(samples):
        if size is None:
            rate = 0.0
        else:
            if last > 0:
                rate = (size - last) / 1048576 / ((ts - at).total_seconds() / 60)
            last, at = size, ts
        out[ts] = rate
    return out


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("unit", ["minute", "hour", "year"])
def test_growth_equals_sample_by_sample(spark, seed, unit):
    random.seed(seed)
    samples = [(START + timedelta(seconds=25 * i), random.choice([None, 0, 10**6, 5 * 10**7, 7 * 10**8])) for i in range(200)]
    df = spark.createDataFrame(samples, "ts timestamp_ntz, size long")
    got = {r.ts: r.growth for r in ops.growth_rates(df, slice_by=unit).collect()}
    expected = watch_folder(samples)
    assert got.keys() == expected.keys()
    assert all(got[k] == pytest.approx(expected[k], abs=1e-9) for k in got)


def test_recent_items_newest_first(spark):
    rows = [("q", i, f'{{"org":"o","name":"n{i}"}}') for i in range(10)] + [("r", 1, "plain")]
    df = spark.createDataFrame(rows, "queue string, at int, item string")
    got = sorted(tuple(r) for r in ops.recent_items(df, ["at"]).collect())
    assert got == [("q", 1, "o/n9"), ("q", 2, "o/n8"), ("q", 3, "o/n7"), ("r", 1, "plain")]


def test_pipeline_summary_of_the_last_tick(spark):
    rows = [("a", START, 9), ("gone", START, 1), ("a", START + timedelta(1), 0), ("b", START + timedelta(1), 4)]
    df = spark.createDataFrame(rows, "queue string, ts timestamp_ntz, length long")
    assert tuple(ops.pipeline_summary(df).first()) == (2, 1, 4)
    assert tuple(ops.pipeline_summary(df.filter("length > 100")).first()) == (0, 0, 0)


def test_folder_stats(spark):
    rows = [
        ("/s", True, None), ("/s/r1", True, None), ("/s/r1/sub", True, None), ("/s/r1/a", False, 10), ("/s/r1/sub/b", False, 5),
        ("/s/empty", True, None), ("/s/file", False, 1), ("/s/bad", False, None), ("/s2/x", False, 100), ("/t/y", False, 100),
    ]
    df = spark.createDataFrame(rows, "path string, is_dir boolean, size long")
    assert tuple(ops.folder_stats(df, "/s").first()) == (16, 4, 2)
    assert tuple(ops.folder_stats(df.filter("NOT is_dir"), "/s/").first()) == (16, 4, 1)
    assert tuple(ops.folder_stats(df, "/missing").first()) == (0, 0, 0)
    assert tuple(ops.folder_stats(df, "./s", cwd="/").first()) == (16, 4, 2)


def test_branch_counts_keep_repositories_without_branches(spark):
    rows = [("o", "a", "refs/heads/main"), ("o", "a", "refs/heads/x/y"), ("o", "a", "refs/tags/v1"), ("o", "b", "refs/heads"), ("o", "b", "HEAD")]
    df = spark.createDataFrame(rows, "org string, name string, ref string")
    assert sorted(tuple(r) for r in ops.branch_counts(df).collect()) == [("o", "a", 2), ("o", "b", 0)]


def test_queue_lengths(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "queue string")
    assert sorted(tuple(r) for r in ops.queue_lengths(df).collect()) == [("a", 2), ("b", 1)]
