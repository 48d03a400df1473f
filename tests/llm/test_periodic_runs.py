"""Word runs against brute force over all stretches of a text."""

import random

import numpy as np
import pytest

from scanlake.llm import periodic_runs


def brute(words, least, times):
    """Every stretch by its definition."""
    n, out = len(words), set()
    for start in range(n):
        for q in range(1, n):
            end = start + q
            while end < n and words[end] == words[end - q]:
                end += 1
            if start and start + q <= n and words[start - 1] == words[start - 1 + q]:
                continue  # a word to the left extends it
            if end - start < max(least, times * q):
                continue
            if all(any(words[i] != words[i + p] for i in range(start, end - p)) for p in range(1, q)):
                out.add((start, end - start, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize(("least", "times"), [(6, 4), (6, 3), (25, 4), (2, 5)])
def test_runs_equal_brute_force(least, times):
    r = random.Random(least * times)
    for _ in range(150):
        words = []
        while len(words) < r.randint(0, 90):
            unit = [r.randint(0, 2) for _ in range(r.randint(1, 9))]
            words += (unit * r.randint(1, 7))[: r.randint(1, 60)]
        assert periodic_runs.find_runs(np.array(words, np.int64), least, times) == brute(words, least, times)


def test_a_period_whose_grams_all_repeat_inside_it():
    a, b = [0, 1, 2, 3, 4, 5, 6], [7, 8, 9, 10, 11, 12, 13]
    unit = a + a + b + b + a + a + b + a + b + b
    assert periodic_runs.find_runs(np.array(unit * 4)) == brute(unit * 4, 6, 4) == [(0, len(unit) * 4, len(unit))]


def test_long_texts_take_linear_steps():
    for unit in ([0], [0, 1], [0, 0, 1], list(range(40_000))):
        n = len(unit) * (400_000 // len(unit))
        assert periodic_runs.find_runs(np.tile(unit, 400_000 // len(unit))) == [(0, n, len(unit))]


def texts():
    r = random.Random(5)
    out = [None, "", " \t\n", "a", "a " * 5, "a " * 6, "é x y\n" * 9, "x " + "a b c " * 5 + "a z"]
    for _ in range(60):
        out.append(" ".join(" ".join(r.choice("pqr") for _ in range(r.randint(1, 8))) + " " for _ in range(3)) + " " + "v w x " * r.randint(0, 6))
    return out


def test_collapsed_text_and_digest(spark):
    rows = [(i, t, 7) for i, t in enumerate(texts())] + [(None, "b " * 8, 7), (None, None, 7), (8, texts()[8], 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int").repartition(4)
    found = periodic_runs.collapse_runs(docs).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    for i, text in enumerate(texts()):
        words = [w for w in __import__("re").split("[ \t-\r]+", text or "") if w]
        runs = brute(words, 6, 4)
        assert [tuple(x) for x in by_id[i].runs] == runs
        gone = {j for s, length, q in runs for j in range(s + q, s + length)}
        assert by_id[i].collapsed == " ".join(w for j, w in enumerate(words) if j not in gone)
    digest = {r.doc_id: r for r in periodic_runs.run_digest(periodic_runs.collapse_runs(docs)).collect()}
    empty = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert digest[0][1:6] == (0, None, None, None, None) and digest[0].runs_sha256 == digest[0].collapsed_sha256 == empty
    assert digest[7][1:6] == (1, 1, 16, 3, 5333)


def test_planted_periods():
    words = [b"w%d" % i for i in range(50)]
    from zlib import crc32

    for doc_id in range(200):
        g, last = divmod(crc32(b"%d" % doc_id), 10)
        planted = periodic_runs.plant_period(doc_id, words)
        a, p = g % 50, 1 + (50 - g % 50) // (3 + g % 8)
        assert planted == (words if last else [words[i] if i < a else words[a + (i - a) % p] for i in range(50)])
    assert periodic_runs.plant_period(None, words) == words and periodic_runs.plant_period(0, []) == []


def test_empty_table(spark):
    assert periodic_runs.run_digest(periodic_runs.collapse_runs(spark.createDataFrame([], "doc_id long, text string"))).count() == 0
