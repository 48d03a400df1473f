import posixpath
import random

import pytest
from pyspark.sql import functions as F

from scanlake.functions import paths


def test_clean_path_matches_lexical_cleaning(values):
    random.seed(3)
    parts = ["a", "b", "..", ".", "", "c.d", "..."]
    cases = ["", "/", "..", "/..", "//x//y/./z/", "a/../.."]
    cases += [
        random.choice(["", "/"]) + "/".join(random.choice(parts) for _ in range(random.randint(1, 7)))
        for _ in range(500)
    ]
    rows = values(cases).select("value", paths.clean_path(F.col("value")).alias("c")).collect()
    for r in rows:
        expected = posixpath.normpath(r.value)
        # normpath keeps a leading double slash; cleaning does not.
        expected = "/" + expected.lstrip("/") if expected.startswith("/") else expected
        assert r.c == expected, r.value


@pytest.mark.parametrize(
    "root, path, within, prefix",
    [
        ("/", "/x", True, True),
        ("/", "/", False, True),
        ("/a/b", "/a/b", False, True),
        ("/a/b", "/a/bc", False, True),
        ("/a/b", "/a/bc/../b/d", True, True),
        ("/a/b", "/a/b/c/../../d", False, False),
        ("/a/b/", "//a/./b//c", True, True),
        ("/a/b", "/a", False, False),
        ("/a/b", "b", False, False),
        ("w/../v", "v/x", True, True),
        ("v", "/work/v/x", True, True),
        ("v", "../v/x", False, False),
        ("/a/..", "/z", True, True),
    ],
)
def test_path_is_within(values, root, path, within, prefix):
    row = values([path]).select(
        paths.path_is_within(F.col("value"), root, "/work").alias("a"),
        paths.path_is_within(F.col("value"), root, "/work", prefix_only=True).alias("b"),
    ).first()
    assert (row.a, row.b) == (within, prefix)


def test_work_path_url_and_ids(spark):
    row = spark.sql("SELECT 'o' AS o, 'n' AS n, 'abc' AS c, 42 AS l, 0 AS i, timestamp'2024-01-01 00:00:01.9' AS t").select(
        paths.work_path("./shared", F.col("o"), F.col("n"), F.lit("ff")).alias("w"),
        paths.work_path("/shared", F.col("o"), F.col("n")).alias("r"),
        paths.repo_url(F.col("o"), F.col("n")).alias("u"),
        paths.finding_id(F.col("o"), F.col("n"), F.col("c"), F.col("l"), F.col("i")).alias("f"),
        paths.summary_id(F.col("o"), F.col("n"), F.col("t")).alias("s"),
        paths.vulnerability_id(F.col("o"), F.col("n"), F.col("t")).alias("v"),
    ).first()
    assert row.w == "shared/o_n_ff"
    assert row.r.startswith("/shared/o_n_") and len(row.r) == len("/shared/o_n_") + 32
    assert row.u == "https://github.com/o/n.git"
    assert (row.f, row.s, row.v) == ("o_n_abc_42_0", "o_n_summary_1704067201", "o_n_osv_1704067201")


def test_epoch_floors_before_1970(spark):
    row = spark.sql("SELECT timestamp'1969-12-31 23:59:59.5' AS t").select(
        paths.summary_id(F.lit("o"), F.lit("n"), F.col("t")).alias("s")
    ).first()
    assert row.s == "o_n_summary_-1"
