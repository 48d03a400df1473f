import random

import pytest
from pyspark.sql import functions as F

from scanlake.functions import labels


def texts(df, *columns):
    return [tuple(r) if len(columns) > 1 else r[0] for r in df.select(*columns).collect()]


def test_one_decimal_matches_correct_rounding(values):
    random.seed(7)
    numbers = [1.25, 0.35, 0.05, -0.04, 9.949999999999999, 1e14 + 0.25, 123456.75, 1e9 + 0.05, 0.0, 3e8 + 0.45]
    numbers += [random.uniform(-100, 100) for _ in range(5000)]
    numbers += [round(random.uniform(-1000, 1000), 2) for _ in range(5000)]
    numbers += [random.randint(-(10**6), 10**6) / 20 for _ in range(5000)]
    numbers += [random.randint(-(10**12), 10**12) / 20 for _ in range(2000)]
    df = values(numbers, "x", "double").select("x", labels.one_decimal(F.col("x"), signed=True).alias("y"))
    assert [r for r in df.collect() if r.y != "%+.1f" % r.x] == []


def test_signed_rate_shows_zero_without_sign(values):
    df = values([0.0, 1.25, -0.26, 12.0], "x", "double")
    assert texts(df, labels.signed_rate(F.col("x"), " MB/m")) == ["0.0 MB/m", "+1.2 MB/m", "-0.3 MB/m", "+12.0 MB/m"]


def test_format_bytes(values):
    cases = {
        0: "0 B", 1023: "1023 B", 1024: "1.0 KB", 1280: "1.2 KB", 1536: "1.5 KB", 1048575: "1024.0 KB",
        1048576: "1.0 MB", 3 * 2**30: "3.0 GB", 2**40 + 5: "1.0 TB", 2**50: "1.0 PB", 2**62: "4.0 EB", -5: "-5 B",
    }
    assert texts(values(list(cases), "n", "bigint"), labels.format_bytes(F.col("n"))) == list(cases.values())


def test_format_duration(values):
    second = 10**9
    cases = {
        0: "0s", 1_499_999_999: "1s", 1_500_000_000: "2s", -1_500_000_000: "-2s", 61 * second: "1m 1s",
        3600 * second: "1h 0m 0s", 3_723_500_000_000: "1h 2m 4s", 2**63 - 1: "2562047h 47m 17s",
    }
    assert texts(values(list(cases), "n", "bigint"), labels.format_duration(F.col("n"))) == list(cases.values())


@pytest.mark.parametrize(
    "item, label",
    [
        ('{"org":"a","name":"b","url":"x/y"}', "a/b"),
        ('{"org":5,"name":"b"}', "name: b"),
        ('{"org":"a"}', "org: a"),
        ('{"repository":"r","url":"x/y"}', "r"),
        ('{"url":"https://host/y/z.git"}', "y/z.git"),
        ('{"url":"plain"}', "plain"),
        ('{"url":""}', ""),
        ('{"z":"1","b":2,"c":"x","a":""}', "c: x"),
        ('{"n":1}', '{"n":1}'),
        ("null", "null"),
        ("{'org':'a','name':'b'}", "{'org':'a','name':'b'}"),
        ("[1]", "[1]"),
        ("x" * 50, "x" * 50),
        ("x" * 51, "x" * 47 + "..."),
        ("é" * 30, "é" * 23 + "..."),
        ('{"org":"a","name":"b"} tail', '{"org":"a","name":"b"} tail'),
    ],
)
def test_item_label(values, item, label):
    assert texts(values([item]), labels.item_label(F.col("value"))) == [label]


def test_ellipsize_counts_bytes_and_keeps_characters(values):
    rows = ["a" * 25, "a" * 26, "é" * 12, "é" * 13, "€" * 9, "😀" * 7]
    got = texts(values(rows), labels.ellipsize(F.col("value"), 25))
    assert got == ["a" * 25, "a" * 22 + "...", "é" * 12, "é" * 11 + "...", "€" * 7 + "...", "😀" * 5 + "..."]


def test_parse_info_last_value_wins(values):
    rows = ["a:1\r\n b : 2:3 \u00a0\nnope\na:9\n:empty\n#x", "", "none", None]
    got = texts(values(rows), labels.parse_info(F.col("value")))
    assert got == [{"a": "9", "b": "2:3", "": "empty"}, {}, {}, None]


def test_rfc3339_trims_the_fraction(spark):
    df = spark.sql(
        "SELECT explode(array(timestamp'2024-01-01 10:00:00', timestamp'2024-01-01 10:00:30.120',"
        " timestamp'2024-01-01 10:00:00.000001', timestamp'0001-01-01 00:00:00')) AS t"
    )
    assert texts(df, labels.rfc3339(F.col("t"))) == [
        "2024-01-01T10:00:00Z", "2024-01-01T10:00:30.12Z", "2024-01-01T10:00:00.000001Z", "0001-01-01T00:00:00Z",
    ]
