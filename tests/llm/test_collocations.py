"""Phrase counts and collocations against brute force over all phrases."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from scanlake.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
        words = [w for w in re.split("[ \t]+", piece) if w]
        if words:
            yield words


def brute_counts(rows):
    counts = Counter()
    for text, lang in rows:
        for words in pieces(text):
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts["und" if lang is None else lang, tuple(words[i : i + k])] += 1
    return counts


def brute(rows, least, top, cover):
    counts = brute_counts(rows)
    out = []
    for lang in {x for x, _ in counts}:
        f = {p: c for (x, p), c in counts.items() if x == lang}
        n = sum(c for p, c in f.items() if len(p) == 1)
        scored = []
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            if any(len(q) > len(p) and c >= least and 100 * c >= cover * a and p in (q[:2], q[1:]) for q, c in f.items()):
                continue
            score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def corpus(seed, number=120):
    r = random.Random(seed)
    texts = [(None, "x"), ("", "x"), (" .,\n", None), ("A a A\tB. É é;c", None), ("one", "a\tb c")]
    for _ in range(number):
        words = [r.choice(["the", "The", "of", "a", "é", "b1", "new york city", "d\tx"]) for _ in range(r.randint(0, 25))]
        texts.append(("".join(w + r.choice([" ", " ", "  ", ". ", ",", "\n", "\r\n"]) for w in words), r.choice(["x", "y", "y", None, "und", "a\tb c"])))
    return texts + texts[5:15] * 3


@pytest.mark.parametrize(("seed", "least", "top", "cover"), [(1, 10, 2000, 50), (2, 2, 7, 50), (3, 3, 40, 90), (4, 1, 2000, 20)])
def test_equals_brute_force(spark, seed, least, top, cover):
    rows = corpus(seed)
    docs = spark.createDataFrame([(t, x, "1", 2) for t, x in rows], "text string, lang string, n string, size int").repartition(3)
    assert sorted(map(tuple, collocations.collocations(docs, least, top, cover).collect())) == brute(rows, least, top, cover)


@pytest.mark.parametrize("most", [10_000, 0])
def test_counts_over_many_shards(spark, most):
    """As shards of graphs and as single rows."""
    rows = corpus(9)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    got = collocations.phrase_counts(docs, 1, shard_chars=500, most_shards=most).collect()
    totals = {r.lang: r.f for r in docs.sparkSession.createDataFrame([(r.lang, r.f) for r in got if not r["size"]], "lang string, f long").groupBy("lang").sum("f").toDF("lang", "f").collect()}
    assert totals == {x: sum(r.f for r in got if r.lang == x and r["size"] == 1) for x in totals}
    phrases = [r for r in got if r["size"]]
    assert len(phrases) == len({(r.lang, *r.words) for r in phrases})
    assert {(r.lang, tuple(r.words)): r.f for r in phrases} == brute_counts(rows)


def test_flows_of_graphs_cut_anywhere(monkeypatch):
    """Blocks end inside pieces; counts stay those of whole texts."""
    rows = corpus(7, 40)
    want = brute_counts(rows)
    for block in (1, 2, 3, 10, 1000):
        monkeypatch.setattr(collocations, "_BLOCK", block)
        got, graph = Counter(), collocations.Graph()

        def take(graph, got=got):
            for k, (codes, counts) in enumerate(graph.flows(), 1):
                for code, count in zip(codes.tolist(), counts.tolist(), strict=True):
                    numbers = [(code >> (21 * (k - 1 - j))) & (2**21 - 1) for j in range(k)]
                    got[graph.langs[numbers[0]], tuple(graph.words[x].decode() for x in numbers)] += count
            graph.__init__()

        for full in graph.add(pa.array([t for t, _ in rows]), ["und" if x is None else x for _, x in rows]):
            take(full)
        if graph.size:
            take(graph)
        assert got == want


def test_sums_of_phrases_wider_than_a_number():
    rows = corpus(3)
    graph = collocations.Graph()
    blobs = []
    for part in (rows[:50], rows[50:]):
        list(graph.add(pa.array([t for t, _ in part]), ["und" if x is None else x for _, x in part]))
        blobs += [collocations.packed(list(w), list(x), g, c) for _, w, x, g, c in graph.shards(1)]
        graph.__init__()
    batch = pa.RecordBatch.from_arrays([pa.array([0, 0], pa.int32()), pa.array(blobs, pa.binary())], ["shard", "graph"])
    for wide in (63, 12, 7):
        out = [r for b in collocations._sums(2, wide)(iter([batch])) for r in b.to_pylist()]
        assert {(r["lang"], tuple(r["words"])): r["f"] for r in out if r["size"]} == {p: c for p, c in brute_counts(rows).items() if c > 1}


def test_scores_past_64_bits(spark, monkeypatch):
    big = 4_000_000_000_000
    counts = [("x", 0, None, 9 * big), ("x", 1, ["a"], 2 * big), ("x", 1, ["b"], 3 * big + 1), ("x", 2, ["a", "b"], big)]
    table = spark.createDataFrame(counts, "lang string, size int, words array<string>, f long")
    monkeypatch.setattr(collocations, "phrase_counts", lambda *_: table)
    row = collocations.collocations(table).first()
    assert tuple(row) == ("x", 1, "a b", big, 2 * big, 3 * big + 1, 9 * big, 1000000 * big * big // (2 * big * (3 * big + 1)))


def test_unary_paths(spark):
    texts = ["a b c d e f g", "q b c d e f h", "r1 r2 r3 r1 r2"]
    counts = collocations.phrase_counts(spark.createDataFrame([(t, "x") for t in texts], "text string, lang string"), 1)
    found = {" ".join(r.words): (r.edges, r.least, r.most) for r in collocations.unary_paths(counts).collect()}
    ring = {"r1 r2 r3": (1, 1, 1), "r2 r3 r1": (1, 1, 1), "r3 r1 r2": (1, 1, 1)}
    assert found == {"a b c": (1, 1, 1), "q b c": (1, 1, 1), "b c d e f": (3, 2, 2), "e f g": (1, 1, 1), "e f h": (1, 1, 1)} | ring


def test_long_unary_path(spark):
    text = " ".join(f"w{i}" for i in range(300))
    counts = collocations.phrase_counts(spark.createDataFrame([(text, "x")], "text string, lang string"), 1)
    (path,) = collocations.unary_paths(counts).collect()
    assert (" ".join(path.words), path.edges) == (text, 298)


def test_no_texts(spark):
    for rows in ([], [(None, None)], [("..", "x")]):
        assert collocations.collocations(spark.createDataFrame(rows, "text string, lang string")).count() == 0
