"""Quality and toxicity: held-out accuracy on made texts, unused inputs, odd rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from scanlake.llm import embed_quality, features, nb_toxicity

BAD = ["blorxeng", "vexatum", "grumoil"]


def word(r):
    return "".join(r.choice("bdfgklmnprstv") + r.choice("aeiou") for _ in range(r.randint(1, 4)))


def text(r, junk, toxic):
    words = [word(r) for _ in range(r.randint(8, 150))]
    if junk:
        words = [w.upper() + "!!" for w in words] if r.random() < 0.5 else [words[0].capitalize()] * 30 + words[:3]
    if toxic:
        for _ in range(r.randint(1, 4)):
            words.insert(r.randrange(len(words)), r.choice(BAD) + r.choice(["", "e", "ur", ","]))
    return " ".join(words) + "."


@pytest.fixture(scope="module")
def corpus(spark):
    r = random.Random(6)
    rows, labels = [], []
    for i in range(1500):
        junk, toxic = r.random() < 0.2, r.random() < 0.15
        rows.append((i, text(r, junk, toxic), f"s{junk}{toxic}"))
        if r.random() < 0.8:
            labels.append((i, int(not junk), int(toxic)))
    rows += [(9001, None, "x"), (9002, "", "x"), (None, "lone text", "x"), (0, rows[0][1], "x"), (9003, word(r) * 60_000, "x")]
    labels += [(9001, 1, 1), (None, 1, 1), (1, None, None), (77777, 0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(4).cache()
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").cache(), labels


@pytest.mark.parametrize("name", ["quality", "toxic"])
def test_held_out_accuracy(corpus, name):
    docs, labels, known = corpus
    if name == "quality":
        found = embed_quality.score_quality(docs, labels).collect()
    else:
        found = nb_toxicity.score_toxicity(docs, labels).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    threshold = 0.5 if name == "quality" else 0.7
    assert all(r.predicted == (r.score >= threshold) for r in found)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found if r.doc_id is not None)
    column = 1 if name == "quality" else 2
    truth = {k[0]: k[column] for k in known if k[0] is not None and k[0] < 1500}
    right = [r.predicted == truth[r.doc_id] for r in found if r.held_out and truth.get(r.doc_id) is not None]
    assert len(right) > 300 and np.mean(right) > 0.97
    again = {r.doc_id: r.score for r in found if r.doc_id == 0}
    assert len(again) == 1


def test_training_rows_are_bounded_and_outside_the_fold(corpus):
    docs, labels, known = corpus
    rows = features.training_rows(docs, labels, "toxic", 40).collect()
    assert all(zlib.crc32(str(r["_id"]).encode()) % 3 != 1 for r in rows)
    by_class = [len({r["_id"] for r in rows if r.target == t}) for t in (0, 1)]
    # One of the labelled ids has no text.
    assert by_class[0] == 40 and by_class[1] in (39, 40)


def test_ids_and_sources_are_no_inputs(spark, corpus):
    docs, labels, _ = corpus
    texts = ["some text here", "blorxeng you " * 3]
    rows = [(i, t, s) for i, (t, s) in enumerate([(t, s) for t in texts for s in ("a", "b")])]
    table = np.frombuffer(nb_toxicity.fit([(texts[0], 0), (texts[1], 1)] * 8), np.float32)
    scores = nb_toxicity.scores(table, [t for _, t, _ in rows])
    assert scores[0] == scores[1] and scores[2] == scores[3]


@pytest.mark.parametrize("module", [embed_quality, nb_toxicity])
def test_one_class_or_none(module):
    for pairs, expected in (([], None), ([("a b", 1)] * 3, 1), ([("a b", 0)] * 3, 0)):
        table = np.frombuffer(module.fit(iter(pairs)), np.float32)
        score = module.scores(table, ["a b", "", "zzz"])
        assert len(score) == 3 and (expected is None or (np.round(score) == expected).all())


@pytest.mark.parametrize("module", [embed_quality, nb_toxicity])
def test_texts_are_scored_alone(module):
    r = random.Random(8)
    pairs = [(text(r, False, t), t) for t in (0, 1) for _ in range(40)]
    table = np.frombuffer(module.fit(pairs), np.float32)
    texts = ["", "a", "ab\ncd", *[text(r, False, i % 2) for i in range(20)], "", "x" * 4000]
    together = module.scores(table, texts)
    for t, score in zip(texts, together, strict=True):
        assert module.scores(table, [t])[0] == pytest.approx(score, abs=1e-6)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert embed_quality.score_quality(docs, labels).count() == 0
    assert nb_toxicity.score_toxicity(docs, labels).count() == 0


def test_an_id_with_very_many_texts_gives_one_training_row(spark):
    used = next(i for i in range(9) if zlib.crc32(str(i).encode()) % 3 != 1)
    docs = spark.range(10_000).select(F.lit(used).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    labels = spark.createDataFrame([(used, 1)], "doc_id long, toxic int")
    assert [tuple(r) for r in features.training_rows(docs, labels, "toxic", 2).collect()] == [(used, 1, "text 0")]
