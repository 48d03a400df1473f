import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from scanlake.operators import coordination as ops
from scanlake.schemas import SCANNERS

A, B = SCANNERS
START = datetime(2024, 1, 1)
SCHEMA = "clone_path string, org string, name string, scanner_type string, completed_at timestamp_ntz, worker_id int, scan_status string, scan_duration long"


def message(path, scanner, minute, status="success", org="test-org", name="test-repo"):
    return (path, org, name, scanner, START + timedelta(minutes=minute), 1, status, 300_000_000_000)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def replay(rows, timeout=None):
    """One message at a time, as a single consumer does it."""
    jobs, done = {}, []
    for path, org, name, scanner, at, _, status, _ in sorted(rows, key=lambda r: r[4]):
        if scanner not in SCANNERS:
            continue
        if timeout and path in jobs and at - jobs[path]["last"] > timedelta(minutes=timeout):
            j = jobs.pop(path)
            done.append((path, j["org"], j["name"], j["start"], j["last"], j.get(A), j.get(B)))
        job = jobs.setdefault(path, {"org": org, "name": name, "start": at})
        job[scanner], job["last"] = status, at
        if A in job and B in job:
            done.append((path, job["org"], job["name"], job["start"], at, job[A], job[B]))
            del jobs[path]
    open_jobs = {
        (p, j["org"], j["name"], j["start"], j["last"], A in j, B in j, j.get(A, ""), j.get(B, "")) for p, j in jobs.items()
    }
    return sorted(done, key=str), open_jobs


def cleanup(df):
    names = ["clone_path", "org", "name", "started_at", "requested_at", "secrets_status", "vulnerabilities_status"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


def still_open(df):
    names = ["clone_path", "org", "name", "started_at", "last_updated", "secrets_complete", "vulnerabilities_complete",
             "secrets_status", "vulnerabilities_status"]
    return {tuple(r) for r in df.select(*names).collect()}


def test_first_scanner_keeps_the_job_open(spark):
    df = frame(spark, [message("/p", A, 0)])
    assert ops.completion_barrier(df).count() == 0
    row = ops.open_jobs(df).first()
    assert (row.secrets_complete, row.vulnerabilities_complete, row.secrets_status, row.org) == (True, False, "success", "test-org")
    assert ops.completed_jobs(ops.job_progress(df)).count() == 0


def test_second_scanner_gives_one_cleanup_row(spark):
    df = frame(spark, [message("/p", A, 0), message("/p", B, 5, "no_vulnerabilities")])
    row = ops.completion_barrier(df).first()
    assert (row.clone_path, row.org, row.name, row.worker_id) == ("/p", "test-org", "test-repo", 0)
    assert (row.secrets_status, row.vulnerabilities_status) == ("success", "no_vulnerabilities")
    assert ops.open_jobs(df).count() == 0
    jobs = ops.cleanup_jobs(ops.completed_jobs(ops.job_progress(df)), "last_updated")
    assert [tuple(r) for r in jobs.collect()] == [("/p", "test-org", "test-repo", START + timedelta(minutes=5), 0)]


def test_unknown_scanner_is_rejected(spark):
    df = frame(spark, [message("/p", "unknown-scanner", 0), message("/q", None, 0), message("/r", A, 0)])
    assert sorted(r.clone_path for r in ops.unknown_scanner(df).collect()) == ["/p", "/q"]
    assert [r.clone_path for r in ops.open_jobs(df).collect()] == ["/r"]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("width", [1, 7, 1000])
def test_replay_equals_one_at_a_time(spark, seed, width):
    """Many short paths and one hot path, cut into slices of different width."""
    random.seed(seed)
    skew = random.choice([0.5, 0.8, 0.95])
    rows = []
    for i in range(1500):
        path = random.choice(["hot"] * 10 + [f"p{k}" for k in range(20)])
        scanner = A if random.random() < skew else B
        if random.random() < 0.05:
            scanner = "other"
        rows.append(message(path, scanner, i, f"s{i}", f"o{i}", f"n{i}"))
    done, waiting = replay(rows)
    df = frame(spark, rows)
    minute = F.floor(F.unix_seconds(F.col("completed_at").cast("timestamp")) / (60 * width))
    assert cleanup(ops.completion_barrier(df, slice_by=minute)) == done
    assert still_open(ops.open_jobs(df, slice_by=minute)) == waiting
    assert len(done) > 50


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("width", [1, 7, 1000])
def test_replay_with_expiry_equals_one_at_a_time(spark, seed, width):
    random.seed(seed)
    rows, minute = [], 0
    for i in range(1200):
        minute += random.choice([0.5, 1, 3])
        path = random.choice(["hot"] * 4 + [f"p{k}" for k in range(12)])
        rows.append(message(path, random.choice([A, A, B]), minute, f"s{i}", f"o{i}", f"n{i}"))
    done, waiting = replay(rows, timeout=12)
    df = frame(spark, rows)
    slices = F.floor(F.unix_seconds(F.col("completed_at").cast("timestamp")) / (60 * width))
    found = ops.completion_barrier(df, slice_by=slices, timeout_minutes=12)
    assert cleanup(found) == done
    assert {r.expired for r in found.collect()} == {True, False}
    assert found.filter("expired AND secrets_status IS NOT NULL AND vulnerabilities_status IS NOT NULL").count() == 0
    assert still_open(ops.open_jobs(df, slice_by=slices, timeout_minutes=12)) == waiting
    with pytest.raises(ValueError):
        ops.completion_barrier(df, timeout_minutes=0)


def test_a_completed_job_does_not_expire(spark):
    df = frame(spark, [message("/p", A, 0), message("/p", B, 1), message("/q", A, 0)])
    progress = ops.job_progress(df)
    now = F.lit("2024-01-02 00:00:00").cast("timestamp")
    assert [r.clone_path for r in ops.completed_jobs(progress).collect()] == ["/p"]
    assert [r.clone_path for r in ops.expire_jobs(progress, now).collect()] == ["/q"]


def test_idle_limit_is_strict(spark):
    df = frame(spark, [message("/old", A, 0), message("/edge", A, 30), message("/new", A, 85)])
    now = F.lit("2024-01-01 01:30:00").cast("timestamp")
    state = ops.open_jobs(df)
    assert [r.clone_path for r in ops.expire_jobs(state, now).collect()] == ["/old"]
    assert sorted(r.clone_path for r in ops.active_jobs(state, now).collect()) == ["/edge", "/new"]
    later = F.lit("2024-01-01 01:30:00.000001").cast("timestamp")
    assert sorted(r.clone_path for r in ops.expire_jobs(state, later).collect()) == ["/edge", "/old"]
    row = ops.cleanup_jobs(ops.expire_jobs(state, now), now).first()
    assert (row.clone_path, row.worker_id) == ("/old", 0)
    with pytest.raises(ValueError):
        ops.expire_jobs(state, now, 0)


def test_failed_message_sent_twice_counts_once(spark):
    rows = [message("/p", B, 0), message("/p", A, 1, "failed"), message("/p", A, 2, "failed")]
    df = frame(spark, rows)
    assert ops.open_jobs(df).count() == 1  # the second failed message opens the job again
    single = ops.dedup_messages(df)
    assert single.count() == 2 and ops.open_jobs(single).count() == 0
    assert ops.completion_barrier(single).first().requested_at == START + timedelta(minutes=1)


def test_cleanup_plan(spark):
    jobs = spark.createDataFrame([("/s/a",), ("/s/./b/",), ("/s/../etc",), ("/s",), ("/s/gone",), (None,), ("/s/a",)], "clone_path string")
    inventory = spark.createDataFrame([("/s/a",), ("/s//b",), ("/etc",), ("/s/a",)], "path string")
    got = sorted((str(r.clone_path), r.action) for r in ops.cleanup_plan(jobs, inventory, "/s").collect())
    assert got == [
        ("/s", "unsafe"), ("/s/../etc", "unsafe"), ("/s/./b/", "remove"), ("/s/a", "remove"), ("/s/a", "remove"),
        ("/s/gone", "missing"), ("None", "unsafe"),
    ]


def test_completion_message_of_a_scan(spark):
    scan = spark.sql(
        "SELECT '/p' AS clone_path, 'o' AS org, 'n' AS name, timestamp_ntz'2024-01-01' AS scanned_at, 2 AS worker_id,"
        " 'failed' AS scan_status, 7L AS scan_duration"
    )
    row = ops.completion_messages(scan, A).first()
    assert (row.clone_path, row.scanner_type, row.scan_status, row.worker_id) == ("/p", A, "failed", 2)
