import json
import random

import pytest
from pyspark.sql import functions as F

from scanlake import schemas
from scanlake.functions import nested
from scanlake.operators import documents as docs
from scanlake.sources.records import decode_records

ENVELOPE = {
    "org": "o", "name": "n", "processed_at": "2024-01-01T00:00:00Z", "scanned_at": "2024-01-01T00:00:01.5Z",
    "worker_id": 3, "scan_duration": 1800000000000,
}


def scan(**more):
    return json.dumps({**ENVELOPE, **more})


def finding(**more):
    return {"secret_type": "AWS", "description": "Found AWS secret", "file": "a.yml", "line": 4, "commit": "abc",
            "confidence": "high", "validated": True, "service": "dropped", **more}


def secret_rows(values, *texts):
    return docs.secret_documents(decode_records(values(texts), schemas.SECRET_SCAN))


@pytest.mark.parametrize("empty", [{"valid_secrets": None}, {"valid_secrets": []}, {}])
def test_summary_document(values, empty):
    df = secret_rows(values, scan(scan_status="failed", **empty))
    row = df.first()
    assert df.count() == 1 and row.id == "o_n_summary_1704067201" and row["index"] == "secrets"
    assert (row.secret_type, row.description) == ("NO_SECRETS_FOUND", "No secrets found in repository")
    assert (row.file_path, row.line_number, row.commit_hash, row.confidence, row.validated) == ("", 0, "", "", False)
    assert (row.scan_status, row.worker_id, row.organization, row.repository) == ("failed", 3, "o", "n")


def test_finding_documents(values):
    df = secret_rows(values, scan(scan_status="success", valid_secrets=[finding(), finding(line=9, validated=False)]))
    assert df.columns == ["index", "id", *schemas.SECRET_DOCUMENT.names]
    rows = {r.id: r for r in df.collect()}
    assert set(rows) == {"o_n_abc_4_0", "o_n_abc_9_1"}
    assert rows["o_n_abc_4_0"].validated and rows["o_n_abc_9_1"].line_number == 9


def vulnerability(severity, **more):
    return {"id": "V", "package": "p", "version": "1", "ecosystem": "npm", "severity": severity, "summary": "s", "details": "d",
            "aliases": ["A"], "fixed": "2", "cve": "", "cwe": None, "package_file": "f", **more}


def test_vulnerability_document(values):
    levels = ["Critical", "HIGH", "medium", "low", "", "7.4", "HIGH"]
    text = scan(scan_status="success", vulnerabilities_found=99, error_message="", vulnerabilities=[vulnerability(s) for s in levels])
    df = docs.vulnerability_documents(decode_records(values([text]), schemas.VULNERABILITY_SCAN))
    row = df.drop("processed_at", "scanned_at").first()
    assert row.id == "o_n_osv_1704067201" and row.vulnerability_count == 99 and row.scan_duration == 1800000000000
    assert (row.critical_count, row.high_count, row.medium_count, row.low_count, row.unknown_count) == (1, 2, 1, 1, 2)
    assert [v.severity for v in row.vulnerabilities] == levels
    assert row.vulnerabilities[0].asDict().keys() == set(schemas.INDEXED_VULNERABILITY.names)


def test_vulnerability_document_without_findings(values):
    text = scan(scan_status="no_vulnerabilities", vulnerabilities=None)
    row = docs.vulnerability_documents(decode_records(values([text]), schemas.VULNERABILITY_SCAN)).drop("processed_at", "scanned_at").first()
    assert (row.vulnerabilities, row.unknown_count) == ([], 0)


def test_cvss_bands_only_on_request(spark):
    df = spark.createDataFrame([(s,) for s in ("9.8", "7.0", "6.9", "0.1", "0.0", "x", "LOW")], "severity string")
    plain = [r[0] for r in df.select(nested.severity_level(F.col("severity"))).collect()]
    assert plain == ["unknown"] * 6 + ["low"]
    banded = [r[0] for r in df.select(nested.severity_level(F.col("severity"), True)).collect()]
    assert banded == ["critical", "high", "medium", "low", "unknown", "unknown", "low"]


def keyed(spark, rows):
    return spark.createDataFrame(rows, "index string, id string, seq int, body string")


def test_upsert_last_write_wins_across_flushes(spark):
    target = keyed(spark, [("i", "a", 1, "old"), ("i", "b", 9, "newer"), ("i", "c", 5, "tie"), ("j", "a", 1, "other index")])
    batch = keyed(spark, [("i", "a", 2, "x"), ("i", "a", 3, "new"), ("i", "b", 4, "older"), ("i", "c", 5, "batch"), ("i", "d", 1, "add")])
    merged = docs.upsert_documents(target, batch, ["index", "id"], ["seq"])
    got = {(r["index"], r["id"]): r["body"] for r in merged.collect()}
    assert got == {("i", "a"): "new", ("i", "b"): "newer", ("i", "c"): "batch", ("i", "d"): "add", ("j", "a"): "other index"}
    assert merged.columns == target.columns


def test_upsert_does_not_shuffle_a_bucketed_target(spark):
    spark.sql("DROP TABLE IF EXISTS upsert_target")
    rows = spark.range(100).select(F.lit("i").alias("index"), F.col("id").cast("string").alias("id"), F.lit(1).alias("seq"), F.lit("x").alias("body"))
    rows.write.bucketBy(8, "index", "id").sortBy("index", "id").saveAsTable("upsert_target")
    merged = docs.upsert_documents(spark.table("upsert_target"), keyed(spark, [("i", "5", 2, "y")]), ["index", "id"], ["seq"])
    assert merged.count() == 100 and merged.filter("body = 'y'").count() == 1
    plan = merged._jdf.queryExecution().executedPlan().toString()
    # The only exchange left is that of the batch's own aggregate.
    assert plan.count("Exchange hashpartitioning") == 1, plan
    spark.sql("DROP TABLE upsert_target")


def test_bulk_lines_and_files(values, spark, tmp_path):
    text = scan(scan_status="success", vulnerabilities_found=1, vulnerabilities=[vulnerability("LOW")])
    rows = docs.vulnerability_documents(decode_records(values([text]), schemas.VULNERABILITY_SCAN))
    omit = schemas.OMIT_EMPTY["vulnerability_document"]
    action, body = [r.line for r in docs.bulk_lines(rows, omit_empty=omit).orderBy("pos").collect()]
    assert action == '{"index":{"_id":"o_n_osv_1704067201","_index":"vulnerabilities"}}'
    parsed = json.loads(body)
    assert parsed["scanned_at"] == "2024-01-01T00:00:01.5Z" and "error_message" not in parsed
    assert parsed["vulnerabilities"] == [
        {"id": "V", "package": "p", "version": "1", "ecosystem": "npm", "severity": "LOW", "summary": "s", "package_file": "f"}
    ]
    path = str(tmp_path / "bulk")
    docs.write_bulk(rows.union(rows), path, omit_empty=omit)
    assert [r.value for r in spark.read.text(path).collect()] == [action, body] * 2


def test_batches_equal_brute_force_with_a_hot_source(spark):
    random.seed(5)
    rows = [(random.choice(["hot"] * 8 + ["a", "b"]), random.randint(0, 500), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "source string, at int, n int")
    got = docs.assign_batches(df, ["at", "n"], ["source"], F.floor(F.col("at") / 20), size=50).collect()
    expected = set()
    for source in ("hot", "a", "b"):
        mine = sorted((at, n) for s, at, n in rows if s == source)
        expected |= {(source, at, n, i // 50, i % 50 + 1) for i, (at, n) in enumerate(mine)}
    assert {(r.source, r.at, r.n, r.batch, r.position) for r in got} == expected and len(got) == len(rows)
    with pytest.raises(ValueError):
        docs.assign_batches(df, ["at"], ["source"], F.lit(0), size=0)


def test_batches_keep_rows_with_a_null_source(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "source string, at int")
    assert docs.assign_batches(df, ["at"], ["source"], F.col("at")).count() == 3


def test_a_hot_source_is_spread_over_tasks(spark):
    """Half of all rows belong to one source; no task may get most of them."""
    rows = spark.range(100_000).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("source"), F.col("id").alias("at")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = docs.assign_batches(rows, ["at"], ["source"], F.floor(F.col("at") / 500))
        parts = got.groupBy(F.spark_partition_id().alias("p")).count().collect()
        last = got.filter("source = 'hot'").agg(F.max("batch")).first()[0]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in parts) == 100_000 and last == 999
    assert max(r["count"] for r in parts) < 30_000
