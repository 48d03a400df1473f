"""Repeated byte strings against brute force over all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from scanlake.llm import suffix_dedup


def brute(texts, length):
    """Counts every window of every text."""
    raw = [(t or "").encode() for t in texts]
    counts = Counter(x[i : i + length] for x in raw for i in range(len(x) - length + 1))
    out = []
    for x in raw:
        gone = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if counts[x[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = [(i, j) for i, j in runs_of(gone)]
        kept = bytes(b for b, g in zip(x, gone, strict=True) if not g)
        out.append((len(x), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def runs_of(gone):
    start = None
    for i, g in enumerate([*gone, 0]):
        if g and start is None:
            start = i
        if not g and start is not None:
            yield start, i
            start = None


def run(spark, texts, length, **options):
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_bytes string").repartition(3)
    found = suffix_dedup.repeated_spans(docs, length, **options).collect()
    by_id = {r.doc_id: (r.n_bytes, r.n_removed, [(s.start, s.end) for s in r.spans], r.kept_sha256) for r in found}
    return [by_id[i] for i in range(len(texts))]


def corpus(seed, number, length):
    """Texts with shared passages of about the length, copies, periods, nulls, empty and short texts."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdé") for _ in range(r.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(r.randint(2, 30)) for _ in range(12)] + ["ab" * 40, "a" * 90]
    texts = [None, "", "a", "é" * 30, "é" * 31, prose(400), passages[0] * 20]
    for _ in range(number):
        texts.append(" ".join(r.choice([prose(r.randint(0, 25)), r.choice(passages)]) for _ in range(r.randint(1, 6))))
    texts += texts[7:12] + [texts[8][3:], texts[9] + "x", texts[10][: len(texts[10]) // 2]]
    return texts


@pytest.mark.parametrize(("seed", "length", "options"), [(1, 20, {}), (2, 33, {"hot": 5}), (3, 8, {"anchor": 3, "hot": 3}), (4, 40, {"anchor": 40})])
def test_equals_brute_force(spark, seed, length, options):
    texts = corpus(seed, 60, length)
    assert run(spark, texts, length, **options) == brute(texts, length)


def test_empty_table_and_null_ids(spark):
    schema = "doc_id long, text string"
    assert suffix_dedup.repeated_spans(spark.createDataFrame([], schema)).count() == 0
    rows = suffix_dedup.repeated_spans(spark.createDataFrame([(None, "x" * 300), (5, "y" * 30)], schema)).collect()
    found = {r.doc_id: (r.n_bytes, r.n_removed) for r in rows}
    assert found == {None: (300, 300), 5: (30, 0)}


def test_suffix_order_is_right_to_the_depth():
    random_ = np.random.default_rng(0)
    for n in (0, 1, 2, 3, 4, 5, 8, 40, 200):
        for _ in range(20):
            text = random_.integers(1, random_.integers(2, 5), n)
            need = int(random_.integers(1, 60))
            order = suffix_dedup.suffix_order(text, need)
            keys = [tuple(text[i : i + need]) for i in order]
            assert sorted(order) == list(range(n))
            assert keys == sorted(keys)
