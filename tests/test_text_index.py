"""The text index against looking at every text."""

import random
import re

import pytest

from scanlake.operators import text_index

WORDS = ["the", "of", "été", "x_1", "Θeta", "the"]


def texts(seed):
    r = random.Random(seed)
    out = [None, "", "...", "the", "The, the; of", "of\nthe of the"]
    return out + [r.choice([" ", ", ", "-"]).join(r.choice(WORDS) for _ in range(r.randint(1, 12))) for _ in range(80)]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / "table")
    rows = [(i * 7 - 50, t) for i, t in enumerate(texts(1))] + [(None, "the of"), (6, "lonely")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    text_index.write_text_index(docs, path, span=32)
    return path, rows


def words(text):
    return [w for w in re.split(r"\W+", (text or "").lower()) if w]


@pytest.mark.parametrize("query", ["the", "THE of", "the the", "the of the", "été θeta", "missing of", "lonely", "x_1 the of été"])
@pytest.mark.parametrize("operator", ["or", "and", "phrase"])
def test_equals_looking_at_all(spark, index, query, operator):
    path, rows = index
    asked = words(query)
    holds = {
        "or": lambda ws: any(w in ws for w in asked),
        "and": lambda ws: all(w in ws for w in asked),
        "phrase": lambda ws: any(ws[i : i + len(asked)] == asked for i in range(len(ws))),
    }[operator]
    want = sorted(i for i, t in rows if i is not None and holds(words(t)))
    assert sorted(r.id for r in text_index.match_index(spark, path, query, operator).collect()) == want


def test_only_asked_terms_are_read(spark, index):
    path, _ = index
    rows = text_index.read_terms(spark, path, ["the", "of"])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    assert "In(term, [of,the])" in plan.replace("`", "")
    assert {r.term for r in rows.collect()} == {"the", "of"}
    assert rows.where("term = 'the'").count() > 5  # a frequent term is split by document range


def test_queries_without_a_word_and_other_operators(spark, index):
    with pytest.raises(ValueError):
        text_index.match_index(spark, index[0], "...")
    with pytest.raises(ValueError):
        text_index.match_index(spark, index[0], "the", "xor")


def test_postings_are_shuffled_once_and_rows_of_one_id_are_one(spark):
    docs = spark.createDataFrame([(5, "the x the"), (5, "of the"), (9000, "the"), (9000 * 64, "the"), (7, "..."), (-3, "the of")], "id long, t string").repartition(4)
    rows = text_index.index_rows(docs, "id", "t", 4096)
    plan = rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1
    found = {(r.term, r["first"]): (r.offsets, r.places) for r in rows.collect()}
    assert found == {
        ("the", 0): ([5], [[0, 1, 2]]), ("x", 0): ([5], [[1]]), ("of", 0): ([5], [[0]]), ("the", -4096): ([4093], [[0]]), ("of", -4096): ([4093], [[1]]),
        ("the", 8192): ([808], [[0]]), ("the", 573440): ([2560], [[0]]),
    }
    assert {r.term: r.bucket for r in rows.collect()} == {t: text_index.bucket_of(t) for t in ("the", "x", "of")}
