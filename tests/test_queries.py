"""Every registered query against its SQL over the whole tables, and its plan."""

import os
import re

import pytest

import __spark_entry__ as entry
import oracle
from scanlake.plans import QUERIES
from scanlake.plans.streams import STREAMS

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


def test_every_query_has_sql():
    assert QUERIES.keys() <= entry.queries().keys()
    assert QUERIES.keys() <= entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    assert oracle.compare(df, con, entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in STREAMS])
def test_plan_stays_in_the_jvm_and_never_crosses(spark, name):
    plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoop|BatchEvalPython|ArrowEvalPython|MapInPandas", plan), plan


def test_scans_read_only_needed_columns(spark):
    plan = entry.queries()["terms_count"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in plan
    assert "ReadSchema: struct<l_suppkey:bigint,l_returnflag:string>" in plan


def test_top_items_are_limited_before_the_shuffle(spark):
    plan = entry.queries()["recent_items"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Partial") > plan.index("Exchange") and "WindowGroupLimit" in plan


@pytest.mark.parametrize("name", ["secret_documents", "vulnerability_documents", "detect_secrets", "decode_records", "bulk_lines"])
def test_record_work_does_not_shuffle(spark, name):
    plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan, plan


@pytest.mark.parametrize("name", ["bulk_batches", "completion_barrier", "active_jobs", "queue_rates", "growth_rates"])
def test_ordered_rows_are_cut_into_slices(spark, name):
    """A window over rows is always inside a slice; only slice summaries meet by key."""
    plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    over_key = [line for line in plan.splitlines() if "Exchange hashpartitioning(_key0" in line and "_slice" not in line]
    assert len(over_key) == 1 and "hashpartitioning(_key0" in plan
    below = plan[plan.index(over_key[0]) + len(over_key[0]) :].lstrip().splitlines()[0]
    assert "Aggregate" in below, below


def test_entry_gives_a_document_for_every_text(spark):
    rows = entry.entry(spark)
    assert rows.count() == 200 and rows.filter("secret_type = 'NO_SECRETS_FOUND'").count() == 200
