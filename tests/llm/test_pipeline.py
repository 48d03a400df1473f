"""The pipeline over the small tables, against stages in plain Python; and every registered query."""

import os
import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline
import oracle
from scanlake.llm import decontam, embed_quality, entropy_secrets
from scanlake.llm.queries import LLM_QUERIES
from test_jaccard import brute

SMALL = "/root/testdata/sf0.001"
FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


def test_registration():
    assert {f"op{n}" for n in range(1, 14)} == {re.match(r"op\d+", n)[0] for n in LLM_QUERIES}
    assert set(LLM_QUERIES) | {"pipeline"} <= set(entry.queries())


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    rows = {r.doc_id: r.text for r in docs.collect()}
    (_, good), (_, unique), (_, clean), (_, safe), (_, packed) = corpus_pipeline.STAGES

    first = good(spark, docs, SMALL).cache()
    scores = embed_quality.score_quality(docs, spark.read.parquet(f"{SMALL}/labels.parquet")).collect()
    assert first.columns == columns
    assert {r.doc_id for r in first.collect()} == {r.doc_id for r in scores if r.predicted == 1}

    second = unique(spark, first, SMALL).cache()
    ids = sorted(r.doc_id for r in first.collect())
    labels = brute([rows[i] for i in ids], 5, 80, 100)
    assert {r.doc_id for r in second.collect()} == {ids[n] for n, (_, root) in enumerate(labels) if root == n}

    third = clean(spark, second, SMALL).cache()
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    bad = {r.doc_id for r in decontam.find_contamination(second, benchmark).collect()}
    assert {r.doc_id for r in third.collect()} == {r.doc_id for r in second.collect()} - bad

    fourth = safe(spark, third, SMALL).cache()
    for r in fourth.collect():
        assert r.text == entropy_secrets.masked(rows[r.doc_id])
        assert r.n_chars == len(r.text) or r.text == rows[r.doc_id]
    assert fourth.columns == columns and fourth.count() == third.count()

    pieces = packed(spark, fourth, SMALL).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in fourth.collect()}
    run = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in run) == sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in pieces) or {
        r.doc_id: r.doc_tokens for r in run
    } == {r.doc_id: r.doc_tokens for r in pieces}


@pytest.mark.parametrize("name", [n for n, q in LLM_QUERIES.items() if q.sql])
def test_query_equals_sql(spark, name):
    df = entry.queries()[name](spark, FOLDER)
    assert oracle.compare(df, oracle.connect(FOLDER), entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", [n for n in LLM_QUERIES if n not in ("op2_jaccard", "op4_quality", "op6_toxicity")])
def test_queries_give_a_row_where_they_should(spark, name):
    table = {"op1": "pages", "op9": "embeddings"}.get(name.split("_")[0], "documents")
    rows = entry.queries()[name](spark, SMALL)
    count = spark.read.parquet(f"{SMALL}/{table}.parquet").count()
    found = rows.count()
    if name.startswith(("op1_", "op3", "op7", "op8")):
        assert found == count
    else:
        assert found > 0
