"""Removal of passages of earlier documents against brute force over all windows."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from scanlake.llm import level_dedup


def brute(rows, window):
    """Every window of every text by its words."""
    words = [[w for w in re.split("[ \t-\r]+", t or "") if w] for _, t in rows]
    least = {}
    for (doc_id, _), ws in zip(rows, words, strict=True):
        for i in range(len(ws) - window + 1):
            if doc_id is not None:
                key = tuple(ws[i : i + window])
                least[key] = min(doc_id, least.get(key, doc_id))
    out = []
    for (doc_id, _), ws in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(ws) - window + 1):
            if doc_id is not None and least[tuple(ws[i : i + window])] < doc_id:
                gone.update(range(i, i + window))
        out.append((doc_id, len(ws), len(gone), " ".join(w for i, w in enumerate(ws) if i not in gone)))
    return sorted(out, key=str)


def run(spark, rows, window, **options):
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, found string, copy string").repartition(3)
    return sorted(map(tuple, level_dedup.without_repeats(docs, window, **options).collect()), key=str)


def corpus(seed):
    r = random.Random(seed)
    prose = lambda n: " ".join(r.choice("abcdefghijé") * r.randint(1, 2) for _ in range(n))
    shared = [prose(r.randint(3, 40)) for _ in range(8)] + ["a " * 30, "b c " * 20]
    texts = [None, "", " \n", "x", shared[0], shared[1] * 3]
    for _ in range(70):
        texts.append(r.choice([" ", "\n", "\t "]).join(r.choice([prose(r.randint(0, 9)), r.choice(shared)]) for _ in range(r.randint(1, 5))))
    rows = [(r.randint(0, 60), t) for t in texts + texts[6:12]]
    return rows + [(None, texts[9]), (None, texts[9]), rows[7], rows[8], (99, texts[10] + " z"), (-3, texts[12])]


@pytest.mark.parametrize(("seed", "window", "options"), [(1, 13, {}), (2, 13, {"shortest": 2}), (3, 5, {"shortest": 1}), (4, 1, {}), (5, 30, {"shortest": 4})])
def test_equals_brute_force(spark, seed, window, options):
    rows = corpus(seed)
    assert run(spark, rows, window, **options) == brute(rows, window)


def test_levels():
    assert level_dedup.level_lengths(13, 7) == [7, 13]
    assert level_dedup.level_lengths(50, 7) == [7, 13, 25, 50]
    assert level_dedup.level_lengths(6, 7) == [6]


def test_a_group_over_many_batches():
    """The smallest id and the rest of a hash may come in different batches."""
    r = np.random.default_rng(0)
    pairs = sorted({(int(h), int(i)) for h, i in zip(r.integers(0, 12, 400), r.integers(0, 40, 400), strict=True)} | {(20, 1), (21, 1), (21, 2)})
    ids = {}
    for h, i in pairs:
        ids.setdefault(h, []).append(i)
    for size in (1, 2, 3, 7, 1000):
        batches = [
            pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pairs[k : k + size], strict=True)], ["hash", "doc_id"])
            for k in range(0, len(pairs), size)
        ]
        for last in (False, True):
            got = sorted((h, i) for b in level_dedup._shared(last)(iter(batches)) for h, i in zip(*(c.to_pylist() for c in b.columns), strict=True))
            assert got == [(h, i) for h, i in pairs if len(ids[h]) > 1 and (not last or i > min(ids[h]))]


def test_empty_table(spark):
    assert level_dedup.without_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_texts_are_shuffled_once(spark):
    """All levels and the result read one exchange of the texts."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(i, f"w{i} " * 3 + "one two three four five six seven eight nine ten eleven twelve thirteen fourteen") for i in range(300)]
        found = level_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
        assert found.where("n_removed = 14").count() == 299
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ReusedExchange") + plan.count("ReusedStage") >= 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
