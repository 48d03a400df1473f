import re

import pytest
from pyspark.sql import functions as F

from scanlake.operators import search as ops

TEXTS = ["The token.", "tokens only", "a_token", "TOKEN", "l'être là", "étêtre", "of\nthe end", "theof", "", None, "naïve—token"]


def words(text):
    return set(re.findall(r"\w+", (text or "").lower()))


@pytest.mark.parametrize("query, operator", [("token", "or"), ("Token, être", "or"), ("the of", "and"), ("END the", "and")])
def test_text_match_equals_word_sets(values, query, operator):
    test = any if operator == "or" else all
    got = values(TEXTS).select("value", ops.text_match(F.col("value"), query, operator).alias("m")).collect()
    for r in got:
        expected = None if r.value is None else test(w in words(r.value) for w in words(query))
        assert r.m == expected, r.value


def test_text_match_needs_a_word():
    with pytest.raises(ValueError):
        ops.text_match(F.lit("x"), " ")
    with pytest.raises(ValueError):
        ops.text_match(F.lit("x"), "a", "near")


def test_nested_match_needs_one_element_to_meet_all_conditions(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, array(named_struct('p','a','s','HIGH'), named_struct('p','b','s','LOW'))),"
        " (2, array(named_struct('p','a','s','LOW'))), (3, NULL) AS t(n, v)"
    )
    both = lambda v: (v["p"] == "a") & (v["s"] == "LOW")
    assert [r.n for r in ops.nested_match(df, "v", both).collect()] == [2]


def test_terms_days_and_latest(spark):
    df = spark.sql(
        "SELECT * FROM VALUES ('x', timestamp'2024-01-01 23:59:59', 1), ('y', timestamp'2024-01-02', 2), ('x', timestamp'2024-01-02', 3) AS t(k, ts, n)"
    )
    assert [tuple(r) for r in ops.terms_count(df, "k", 1).collect()] == [("x", 2)]
    assert [tuple(r) for r in ops.terms_count(df, "k", 5, F.col("n") > 1).collect()] == [("x", 1), ("y", 1)]
    assert sorted(tuple(r) for r in ops.per_day(df, "ts").collect()) == [("2024-01-01", 1), ("2024-01-02", 2)]
    assert sorted(tuple(r) for r in ops.latest_scan(df, ["k"], ["ts"], ["n"]).collect()) == [("x", 3), ("y", 2)]
