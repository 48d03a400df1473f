"""The stateful barrier: late messages, timers, saved jobs and state, over restarts."""

from datetime import datetime, timedelta

import pytest

from scanlake.streaming import records as streams
from scanlake.streaming.jobs import job_barrier_stream, jobs_in_state, state_in_rocksdb

SCHEMA = "clone_path string, org string, name string, scanner_type string, scan_status string, completed_at timestamp"
A, B = "secrets", "vulnerabilities"


def at(minute):
    return None if minute is None else datetime(2024, 1, 1) + timedelta(minutes=minute)


@pytest.fixture
def run(spark, tmp_path):
    """Feeds triggers, each a list of (path, scanner, status, minute); runs of one checkpoint share it."""
    source, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))

    def go(*triggers, **options):
        for rows in triggers:
            data = [(p, "o", "n", scanner, status, at(m)) for p, scanner, status, m in rows]
            spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        msgs = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        found = job_barrier_stream(msgs, (A, B), **options)
        with state_in_rocksdb(spark):
            streams.drain(streams.fan_out(found, {out: lambda batch: batch}), checkpoint)
        rows = streams.read_epochs(spark, out).collect()
        return sorted((r.clone_path, r.kind, r.started_at, r.requested_at, r.secrets_status, r.vulnerabilities_status) for r in rows if r.kind), checkpoint

    return go


def test_late_messages_come_back_and_change_nothing(run):
    found, _ = run(
        [("p", A, "ok", 100), ("q", A, "ok", 0), ("q", B, "bad", 1)],
        [("p", B, "late", 10), ("q", A, None, 95), ("r", A, "late", 0)],
        [("p", B, "ok", 101)],
        timeout_minutes=60,
    )
    assert [r for r in found if r[1] == "late"] == [("p", "late", None, at(10), None, "late"), ("r", "late", None, at(0), "late", None)]
    assert [r for r in found if r[1] == "done"] == [("p", "done", at(100), at(101), "ok", "ok"), ("q", "done", at(0), at(1), "ok", "bad")]


def test_timers_and_gaps_expire_jobs(run):
    found, _ = run(
        [("p", A, "ok", 0), ("q", A, "ok", 0), ("q", A, "again", 90), ("q", B, "ok", 91)],
        [("s", A, "ok", 200)],
        timeout_minutes=60,
    )
    assert found == [
        ("p", "expired", at(0), at(0), "ok", None), ("q", "done", at(90), at(91), "again", "ok"), ("q", "expired", at(0), at(0), "ok", None),
    ]


def test_a_restart_keeps_jobs_and_their_timers(spark, run):
    found, checkpoint = run([("p", A, "ok", 0), ("q", B, None, 1)], timeout_minutes=60)
    assert found == []
    jobs = {r.clone_path: r for r in jobs_in_state(spark, checkpoint).collect()}
    assert {p: (r.secrets_complete, r.vulnerabilities_complete, r.started_at) for p, r in jobs.items()} == {
        "p": (True, False, at(0)), "q": (False, True, at(1)),
    }
    found, checkpoint = run([("p", B, "ok", 30)], [("x", A, "ok", 500)], timeout_minutes=60)
    assert found == [("p", "done", at(0), at(30), "ok", "ok"), ("q", "expired", at(1), at(1), None, "")]
    assert [r.clone_path for r in jobs_in_state(spark, checkpoint).collect()] == ["x"]


def test_saved_jobs_go_on(spark, run):
    kind = (
        "clone_path string, org string, name string, started_at timestamp, last_updated timestamp, secrets_complete boolean, "
        "vulnerabilities_complete boolean, secrets_status string, vulnerabilities_status string"
    )
    saved = spark.createDataFrame(
        [("p", "o", "n", at(0), at(5), True, False, "old", ""), ("q", "o", "n", at(0), at(5), False, True, "", "old")], kind
    )
    found, _ = run([("p", B, "new", 20)], [("x", A, "ok", 300)], timeout_minutes=60, open_jobs=saved)
    assert found == [("p", "done", at(0), at(20), "old", "new"), ("q", "expired", at(0), at(5), None, "old")]


def test_a_limit_must_be_positive(spark):
    with pytest.raises(ValueError):
        job_barrier_stream(spark.createDataFrame([], SCHEMA), timeout_minutes=0)
