import json
import random
import time
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from scanlake import schemas
from scanlake.operators.coordination import completion_barrier
from scanlake.operators.documents import upsert_documents
from scanlake.schemas import SCANNERS
from scanlake.sources.records import decode_records
from scanlake.streaming import records as streams
from scanlake.streaming import barrier
from scanlake.streaming.barrier import OUTPUT, barrier_step, completion_barrier_stream
from test_coordination import cleanup

A, B = SCANNERS
START = pd.Timestamp("2024-01-01")


def test_record_stream_decodes_and_drops_bad_records(spark, tmp_path):
    source = tmp_path / "queue"
    source.mkdir()
    (source / "1.txt").write_text('{"org":"o","name":"a"}\n{bad\n')
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")

    def run():
        records = decode_records(streams.record_stream(spark, str(source)), schemas.REPOSITORY)
        query = streams.drain(streams.fan_out(records, {table: lambda b: b}), checkpoint)
        return sum(p["input_rows"] for p in streams.progress_rows(query))

    assert run() == 2
    (source / "2.txt").write_text('{"org":"o","name":"b"}\n')
    assert run() == 1  # the checkpoint remembers what was read
    assert sorted(r.name for r in streams.read_epochs(spark, table).collect()) == ["a", "b"]


@pytest.mark.parametrize("whole", [True, False])
def test_table_stream_reads_a_file_or_a_folder(spark, tmp_path, whole):
    rows = spark.range(20, numPartitions=1 if whole else 4)
    if whole:
        rows.toPandas().to_parquet(tmp_path / "t.parquet")
    else:
        rows.write.parquet(str(tmp_path / "t.parquet"))
    rows.write.parquet(str(tmp_path / "other.parquet"))
    stream = streams.table_stream(spark, str(tmp_path), "t", rows.schema, files_per_trigger=3)
    query = streams.drain(streams.fan_out(stream, {str(tmp_path / "out"): lambda b: b}), str(tmp_path / "c"))
    assert streams.read_epochs(spark, str(tmp_path / "out")).count() == 20
    assert [p["input_rows"] for p in streams.progress_rows(query)] == ([20] if whole else [15, 5])


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    batch = spark.createDataFrame([("i", "a", 1), ("i", "a", 2), ("i", "b", 1)], "index string, id string, seq int")
    path = str(tmp_path / "docs")
    for epoch in (0, 1, 1):
        streams._write_epoch(batch.withColumn("seq", F.col("seq") + 10 * epoch), path, epoch)
    assert streams.read_epochs(spark, path).count() == 6


def test_document_sink_orders_by_seq_or_by_arrival(spark, tmp_path):
    source = tmp_path / "docs-in"
    source.mkdir()
    path, checkpoint = str(tmp_path / "docs"), str(tmp_path / "checkpoint")

    def flush(name, *docs):
        (source / f"{name}.json").write_text("\n".join(json.dumps(d) for d in docs))
        stream = spark.readStream.schema("id string, seq int, body string").json(str(source))
        streams.drain(streams.document_sink(stream, path, ["id"], ["seq"]), checkpoint)

    flush("1", {"id": "a", "seq": 1, "body": "x"}, {"id": "a", "seq": 2, "body": "y"}, {"id": "b", "seq": 1, "body": "z"})
    flush("2", {"id": "a", "seq": 1, "body": "late"}, {"id": "b", "seq": 1, "body": "tie"})

    def read(*seq):
        return {r.id: r.body for r in streams.read_documents(spark, path, ["id"], seq).collect()}

    assert read("seq") == {"a": "y", "b": "tie"} and read() == {"a": "late", "b": "tie"}
    streams.compact_documents(spark, path, str(tmp_path / "compact"), ["id"], ["seq"])
    compact = streams.read_epochs(spark, str(tmp_path / "compact"))
    assert sorted((r.id, r.body) for r in compact.collect()) == [("a", "y"), ("b", "tie")]


def test_stream_upsert_equals_batch_over_any_triggers(spark, tmp_path):
    random.seed(5)
    rows = [(f"k{random.randint(0, 9)}", random.randint(0, 40), f"b{i}") for i in range(300)]
    schema = "id string, seq int, body string"
    target = spark.createDataFrame([], schema)
    for number in range(6):
        part = spark.createDataFrame(rows[number * 50 : number * 50 + 50], schema)
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        target = upsert_documents(target, part, ["id"], ["seq", "body"])
    path = str(tmp_path / "docs")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    streams.drain(streams.document_sink(stream, path, ["id"], ["seq", "body"]), str(tmp_path / "c"))
    read = streams.read_documents(spark, path, ["id"], ["seq", "body"]).select("id", "seq", "body")
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, target.collect()))


def test_batch_log_has_every_batch(spark, tmp_path):
    for _ in range(3):
        spark.range(4).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    log = []
    listener = streams.BatchLog(log.append)
    spark.streams.addListener(listener)
    try:
        stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        streams.drain(streams.fan_out(stream, {str(tmp_path / "out"): lambda b: b}), str(tmp_path / "c"))
        for _ in range(50):
            if sum(row["input_rows"] for row in log) == 12:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert [row["input_rows"] for row in log if row["input_rows"]] == [4, 4, 4]


def test_sinks_get_the_batch_once(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "in"))
    for count in (1, 2):
        paths = [str(tmp_path / f"out{count}{i}") for i in range(count)]
        stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
        streams.drain(streams.fan_out(stream, {p: lambda b: b for p in paths}), str(tmp_path / f"c{count}"))
        assert [streams.read_epochs(spark, p).count() for p in paths] == [5] * count


MESSAGES = "clone_path string, org string, name string, scanner_type string, scan_status string, completed_at timestamp"


def write_messages(spark, folder, rows):
    spark.createDataFrame(rows, MESSAGES).coalesce(1).write.mode("append").parquet(folder)


def test_barrier_stream_equals_batch_over_several_batches(spark, tmp_path):
    random.seed(11)
    source, table, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    rows = [
        (random.choice(["hot"] * 4 + ["p", "q", "r"]), f"o{i}", f"n{i}", random.choice([A, B, "other"]), f"s{i}",
         (START + timedelta(minutes=i)).to_pydatetime())
        for i in range(300)
    ]
    for part in (rows[:120], rows[120:130], rows[130:]):
        write_messages(spark, source, part)
        msgs = spark.readStream.schema(MESSAGES).parquet(source)
        done = completion_barrier_stream(msgs, timeout_minutes=None)
        streams.drain(streams.fan_out(done, {table: lambda b: b}), checkpoint)
    streamed = cleanup(streams.read_epochs(spark, table))
    batch = cleanup(completion_barrier(spark.read.parquet(source), slice_by="hour"))
    assert streamed == batch and len(batch) > 50


def test_event_clock_expires_idle_jobs(spark, tmp_path):
    source, table, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))

    def at(minute):
        return (START + timedelta(minutes=minute)).to_pydatetime()

    batches = [
        [("idle", "o", "n", A, "s", at(0)), ("done", "o", "n", A, "s", at(0)), ("done", "o", "n", B, "t", at(1))],
        [("young", "o", "n", B, "s", at(200))],
        [("tick", "o", "n", B, "s", at(201))],
    ]
    for rows in batches:
        write_messages(spark, source, rows)
        msgs = spark.readStream.schema(MESSAGES).parquet(source)
        done = completion_barrier_stream(msgs, timeout_minutes=60, clock="event")
        streams.drain(streams.fan_out(done, {table: lambda b: b}), checkpoint)
    got = {(r.clone_path, r.expired, r.secrets_status) for r in streams.read_epochs(spark, table).collect()}
    assert got == {("done", False, "s"), ("idle", True, "s")}


def test_event_clock_expires_between_messages_of_one_trigger(spark, tmp_path):
    random.seed(12)
    source, table, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    minute, rows = 0, []
    for i in range(300):
        minute += random.choice([1, 5, 40])
        path = random.choice(["hot", "p", "q"])
        rows.append((path, f"o{i}", f"n{i}", random.choice([A, B]), f"s{i}", (START + timedelta(minutes=minute)).to_pydatetime()))
    write_messages(spark, source, rows)
    done = completion_barrier_stream(spark.readStream.schema(MESSAGES).parquet(source), timeout_minutes=60, clock="event")
    streams.drain(streams.fan_out(done, {table: lambda b: b}), checkpoint)
    names = ["clone_path", "org", "started_at", "requested_at", "secrets_status", "vulnerabilities_status", "expired"]
    last = {r[0]: r[5] for r in rows}
    got = {tuple(r) for r in streams.read_epochs(spark, table).select(*names).collect()}
    batch = completion_barrier(spark.read.parquet(source), slice_by="hour", timeout_minutes=60)
    expected = {tuple(r) for r in batch.select(*names).collect()}
    # The stream also expires what is still open at the end, as far as the watermark has come.
    assert expected <= got and all(r[6] and r[3] == last[r[0]] for r in got - expected)
    assert sum(r[6] for r in expected) > 10


class State:
    """Stands in for the engine's group state."""

    def __init__(self, now=0):
        self.value, self.timeout, self.hasTimedOut, self.now = None, None, False, now

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def setTimeoutDuration(self, ms):
        self.timeout = ms

    def getCurrentProcessingTimeMs(self):
        return self.now


def test_processing_time_expiry_emits_one_cleanup_row():
    step, state = barrier_step(SCANNERS, 60, "processing"), State(now=1704070800000)
    msg = pd.DataFrame([("o", "n", A, "failed", START)], columns=["org", "name", "scanner_type", "scan_status", "completed_at"])
    assert list(step(("/p",), iter([msg]), state)) == []
    assert state.timeout == 60 * 60_000 and state.value[3:5] == ("failed", None)
    state.hasTimedOut = True
    (rows,) = step(("/p",), iter([]), state)
    row = rows.iloc[0]
    assert list(rows.columns) == [c.split(" ")[0] for c in OUTPUT.split(", ")]
    assert (row.clone_path, row.worker_id, row.expired, row.secrets_status) == ("/p", 0, True, "failed")
    assert row.requested_at == pd.Timestamp("2024-01-01 01:00:00") and not state.exists


def test_processing_clock_runs_in_the_engine(spark, tmp_path):
    source, table, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    write_messages(spark, source, [("/p", "o", "n", A, "s", START.to_pydatetime()), ("/p", "o", "n", B, "t", START.to_pydatetime())])
    done = completion_barrier_stream(spark.readStream.schema(MESSAGES).parquet(source))
    query = (
        streams.fan_out(done, {table: lambda b: b})
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime="1 second")
        .start()
    )
    try:
        for _ in range(60):
            time.sleep(1)
            if (tmp_path / "out").exists() and query.lastProgress:
                break
        assert streams.read_epochs(spark, table).count() == 1
    finally:
        query.stop()


def test_timeout_must_be_positive(spark, tmp_path):
    write_messages(spark, str(tmp_path / "in"), [("/p", "o", "n", A, "s", datetime(2024, 1, 1))])
    msgs = spark.readStream.schema(MESSAGES).parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError):
        completion_barrier_stream(msgs, timeout_minutes=0)


def test_messages_of_a_path_are_sorted_without_frames(monkeypatch):
    """As a stable sort of a frame would, nulls last; a frame for each path and trigger costs more than its messages."""
    r = random.Random(3)
    columns = ["org", "name", "scanner_type", "scan_status", "completed_at", "seq"]
    one = lambda: (r.choice("ab"), r.choice(["n", None]), r.choice([A, B]), r.choice(["x", "y", None]), START + timedelta(minutes=r.randint(0, 3)), r.randint(0, 2))
    frames = [pd.DataFrame([one() for _ in range(n)], columns=columns) for n in (30, 1, 9)]
    by = ["completed_at", "seq", "org", "name", "scanner_type", "scan_status"]
    want = [tuple(m)[:5] for m in pd.concat(frames).sort_values(by, kind="stable").itertuples(index=False)]
    for frame in ("sort_values", "itertuples"):
        monkeypatch.delattr(pd.DataFrame, frame)
    monkeypatch.delattr(pd, "concat")
    step, state = barrier_step(SCANNERS, None, None, ["completed_at", "seq"]), State()
    plain = lambda m: tuple(None if v is None or v != v else v for v in m)
    assert [plain(m) for m in barrier._in_order(frames, by)] == [plain(m) for m in want]
    (rows,) = step(("/p",), iter(frames), state)
    assert len(rows) > 3 and list(rows.columns) == [c.split(" ")[0] for c in OUTPUT.split(", ")]
