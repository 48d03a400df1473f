"""Queries that run a stream over a table to its end and return what it wrote."""

import time

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake import schemas
from scanlake.operators import coordination as ops
from scanlake.operators.documents import latest_documents
from scanlake.operators.search import per_day_stream
from scanlake.plans.coordination import ACTIVE_SQL, ORDER, REPLAY_SQL, REQUIRED, TIMEOUT, active_rows, expiry_sql, replay_sql, stamp
from scanlake.plans.query import Registry
from scanlake.plans.records import UPSERT_SQL
from scanlake.sources.records import decode_records
from scanlake.sources.tables import table
from scanlake.streaming import records as streams
from scanlake.streaming.barrier import completion_barrier_stream
from scanlake.streaming import merged
from scanlake.streaming.jobs import job_barrier_stream, jobs_in_state, state_in_rocksdb

STREAMS = Registry()


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    return streams.table_stream(spark, sf, "events", table(spark, sf, "events").schema)


@STREAMS.add(
    "record_stream",
    """SELECT event_id, event_type, user_id FROM events WHERE event_id % 10 <> 0""",
)
def decoded(spark: SparkSession, sf: str) -> DataFrame:
    source = streams.fresh_folder(spark, "record-source")
    broken = F.col("event_id") % 10 == 0
    record = F.to_json(F.struct("event_id", "event_type", "user_id"))
    lines = table(spark, sf, "events").select(F.when(broken, F.substring(record, 1, 9)).otherwise(record).alias("value"))
    lines.write.text(source)
    schema = schemas.record(event_id=schemas.LONG, event_type=schemas.STRING, user_id=schemas.LONG)
    path = streams.fresh_folder(spark, "record-table")
    writer = streams.fan_out(decode_records(streams.record_stream(spark, source), schema), {path: lambda b: b})
    streams.drain(writer, streams.fresh_folder(spark, "record-checkpoint"))
    return streams.read_epochs(spark, path).drop(streams.EPOCH)


@STREAMS.add(
    "fan_out",
    """SELECT 'secrets' AS sink, event_id FROM events
       UNION ALL SELECT 'vulnerabilities', event_id FROM events""",
)
def fanned(spark: SparkSession, sf: str) -> DataFrame:
    base = streams.fresh_folder(spark, "fan-out")
    names = ["secrets", "vulnerabilities"]
    sinks = {f"{base}/{name}": lambda batch: batch.select("event_id") for name in names}
    writer = streams.fan_out(event_stream(spark, sf), sinks)
    streams.drain(writer, streams.fresh_folder(spark, "fan-out-checkpoint"))
    first, second = [
        streams.read_epochs(spark, f"{base}/{name}").select(F.lit(name).alias("sink"), "event_id") for name in names
    ]
    return first.unionByName(second)


# Events by arrival: in four files, the latest days first.
CHUNK_SQL = "datediff('day', TIMESTAMP '2024-01-01', ts) // 8"


def falling_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events as a stream of four files in falling time order, one in each trigger."""
    folder = streams.fresh_folder(spark, "falling-events")
    events = table(spark, sf, "events")
    chunk = F.floor(F.datediff("ts", F.lit("2024-01-01")) / 8)
    for number in (3, 2, 1, 0):
        part = events.filter(chunk >= 3 if number == 3 else chunk <= 0 if number == 0 else chunk == number)
        part.coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)


@STREAMS.add("upsert_stream", UPSERT_SQL)
def upserted(spark: SparkSession, sf: str) -> DataFrame:
    """The upsert does not depend on triggers: older events arrive later and lose."""
    path = streams.fresh_folder(spark, "documents")
    rows = falling_stream(spark, sf).select("user_id", "event_id", "event_type", "ts")
    seq = ["ts", "event_id"]
    writer = streams.document_sink(rows, path, ["user_id"], seq)
    streams.drain(writer, streams.fresh_folder(spark, "documents-checkpoint"))
    latest = streams.read_documents(spark, path, ["user_id"], seq)
    at = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at")
    return latest.select("user_id", "event_id", "event_type", at)


@STREAMS.add("upsert_merged", UPSERT_SQL)
def upserted_in_place(spark: SparkSession, sf: str) -> DataFrame:
    """The same table with its buckets merged at each flush: a read opens one version of each."""
    path = streams.fresh_folder(spark, "merged-documents")
    rows = falling_stream(spark, sf).select("user_id", "event_id", "event_type", "ts")
    streams.drain(merged.merged_sink(rows, path, ["user_id"], ["ts", "event_id"]), streams.fresh_folder(spark, "merged-checkpoint"))
    at = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at")
    return merged.read_merged(spark, path, rows.schema).select("user_id", "event_id", "event_type", at)


@STREAMS.add(
    "delivery_after_failure",
    """SELECT 'secrets' AS sink, event_id, event_type FROM events
       UNION ALL SELECT 'vulnerabilities', event_id, event_type FROM events""",
)
def delivered(spark: SparkSession, sf: str) -> DataFrame:
    """The run stops in its third batch, between its two tables, and starts again from its checkpoint."""
    base, checkpoint = streams.fresh_folder(spark, "delivery"), streams.fresh_folder(spark, "delivery-checkpoint")
    rows = falling_stream(spark, sf).select("event_id", "event_type")
    batches = []

    def failing(batch: DataFrame) -> DataFrame:
        batches.append(1)
        if len(batches) == 3:
            raise RuntimeError("stopped between two tables")
        return batch

    names = ["secrets", "vulnerabilities"]
    stopped = False
    try:
        streams.drain(streams.fan_out(rows, {f"{base}/secrets": lambda b: b, f"{base}/vulnerabilities": failing}), checkpoint)
    except StreamingQueryException:
        stopped = True
    if not stopped:
        raise AssertionError("the first run was to stop")
    streams.drain(streams.fan_out(rows, {f"{base}/{name}": lambda b: b for name in names}), checkpoint)
    first, second = [
        streams.read_epochs(spark, f"{base}/{name}").select(F.lit(name).alias("sink"), "event_id", "event_type") for name in names
    ]
    return first.unionByName(second)


@STREAMS.add("dedup_stream", "SELECT DISTINCT user_id, event_type, strftime(ts, '%Y-%m-%d') AS day FROM events")
def deduplicated(spark: SparkSession, sf: str) -> DataFrame:
    """One message per user, type and day; six files, each of five days, and state of the last days only."""
    folder = streams.fresh_folder(spark, "dedup-events")
    events = table(spark, sf, "events")
    number = F.least(F.floor(F.datediff("ts", F.lit("2024-01-01")) / 5), F.lit(5))
    for n in range(6):
        part = events.filter(number <= 0 if n == 0 else number == n)
        part.repartition(2).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(folder)
    msgs = stream.select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), F.date_format("ts", "yyyy-MM-dd").alias("day"))
    first = streams.dedup_stream(msgs, ["user_id", "event_type", "day"], "ts", within_minutes=6 * 24 * 60).drop("ts")
    path = streams.fresh_folder(spark, "dedup-table")
    streams.drain(streams.fan_out(first, {path: lambda b: b}), streams.fresh_folder(spark, "dedup-checkpoint"))
    return streams.read_epochs(spark, path).drop(streams.EPOCH)


def messages(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").cast("string").alias("clone_path"),
        F.concat(F.lit("e"), "event_id").alias("org"),
        F.concat(F.lit("u"), "user_id").alias("name"),
        F.col("event_type").alias("scanner_type"),
        F.concat(F.lit("s"), "event_id").alias("scan_status"),
        F.col("ts").cast("timestamp").alias("completed_at"),
        "event_id",
    )


def cleanup_rows(spark: SparkSession, done: DataFrame) -> DataFrame:
    """What the barrier writes, run to the end of its source."""
    path = streams.fresh_folder(spark, "cleanup-jobs")
    writer = streams.fan_out(done, {path: lambda batch: batch})
    streams.drain(writer, streams.fresh_folder(spark, "barrier-checkpoint"))
    return streams.read_epochs(spark, path).select(
        "clone_path", "org", "name", stamp("started_at"), stamp("requested_at"), "worker_id",
        "secrets_status", "vulnerabilities_status", "expired",
    )


_CLEANUP_SQL = """
    SELECT clone_path, org, name, strftime(started, '%Y-%m-%d %H:%M:%S.%f') AS started_at,
           strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS requested_at, 0 AS worker_id,
           a AS secrets_status, b AS vulnerabilities_status
    FROM replay WHERE a IS NOT NULL AND b IS NOT NULL
"""


@STREAMS.add("completion_barrier_stream", REPLAY_SQL + _CLEANUP_SQL)
def barrier(spark: SparkSession, sf: str) -> DataFrame:
    done = completion_barrier_stream(messages(event_stream(spark, sf)), REQUIRED, timeout_minutes=None, order=ORDER)
    return cleanup_rows(spark, done).drop("expired")


@STREAMS.add("completion_barrier_stream_arrival", replay_sql(f"{CHUNK_SQL} DESC, ts, event_id") + _CLEANUP_SQL)
def barrier_by_arrival(spark: SparkSession, sf: str) -> DataFrame:
    """Messages count in the order of their triggers, here with the latest days first."""
    done = completion_barrier_stream(messages(falling_stream(spark, sf)), REQUIRED, timeout_minutes=None, order=ORDER)
    return cleanup_rows(spark, done).drop("expired")


@STREAMS.add(
    "completion_barrier_stream_expiry",
    expiry_sql(TIMEOUT, f"(SELECT max(ts) FROM m) - INTERVAL 5 MINUTE > ts + INTERVAL {TIMEOUT}"),
)
def barrier_with_expiry(spark: SparkSession, sf: str) -> DataFrame:
    """Event time: gaps expire jobs, and so does the watermark after the last message."""
    msgs = messages(event_stream(spark, sf))
    done = completion_barrier_stream(msgs, REQUIRED, timeout_minutes=12 * 60, clock="event", order=ORDER)
    return cleanup_rows(spark, done)


# Events in two files: a quarter of the first half of the month arrives with the second half, most of it behind the watermark.
FIRST_SQL = "(ts < TIMESTAMP '2024-01-16' AND event_id % 4 <> 0)"
LATE_SQL = f"""(NOT {FIRST_SQL} AND ts < (SELECT max(ts) FROM events WHERE event_type IN ('click', 'purchase') AND {FIRST_SQL}) - INTERVAL 5 MINUTE)"""


def delayed_stream(spark: SparkSession, sf: str) -> DataFrame:
    folder = streams.fresh_folder(spark, "delayed-events")
    events = table(spark, sf, "events")
    first = F.expr("ts < timestamp'2024-01-16' AND event_id % 4 <> 0")
    for part in (first, ~first):
        events.filter(part).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def barrier_rows(spark: SparkSession, found: DataFrame, checkpoint: str | None = None) -> DataFrame:
    """What the processor writes, run to the end of its source."""
    path = streams.fresh_folder(spark, "job-rows")
    with state_in_rocksdb(spark):
        streams.drain(streams.fan_out(found, {path: lambda batch: batch}), checkpoint or streams.fresh_folder(spark, "jobs-checkpoint"))
    return streams.read_epochs(spark, path).select(
        "clone_path", "kind", "org", "name", stamp("started_at"), stamp("requested_at"), "secrets_status", "vulnerabilities_status"
    )


_KINDS = """
    SELECT clone_path, {kind} AS kind, org, name, started_at, requested_at, secrets_status, vulnerabilities_status FROM ({rows})
"""


@STREAMS.add(
    "barrier_late",
    _KINDS.format(
        kind="CASE WHEN expired THEN 'expired' ELSE 'done' END",
        rows=expiry_sql(
            TIMEOUT,
            f"(SELECT max(ts) FROM events WHERE event_type IN ('click', 'purchase')) - INTERVAL 5 MINUTE > ts + INTERVAL {TIMEOUT}",
            f"NOT {FIRST_SQL}, ts, event_id",
            f"NOT {LATE_SQL}",
        ),
    )
    + f"""
    UNION ALL
    SELECT CAST(user_id AS VARCHAR), 'late', 'e' || event_id, 'u' || user_id, NULL, strftime(ts, '%Y-%m-%d %H:%M:%S.%f'),
           CASE WHEN event_type = 'click' THEN 's' || event_id END, CASE WHEN event_type = 'purchase' THEN 's' || event_id END
    FROM events WHERE event_type IN ('click', 'purchase') AND {LATE_SQL}
    """,
)
def barrier_with_late_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Every message counts or is given back as late; timers expire idle jobs."""
    msgs = messages(delayed_stream(spark, sf))
    return barrier_rows(spark, job_barrier_stream(msgs, REQUIRED, timeout_minutes=12 * 60, order=["event_id"]))


@STREAMS.add(
    "barrier_resumed",
    REPLAY_SQL + _KINDS.format(kind="'done'", rows=_CLEANUP_SQL + " AND ts >= TIMESTAMP '2024-01-16'"),
)
def barrier_from_saved_jobs(spark: SparkSession, sf: str) -> DataFrame:
    """The jobs that a batch replay of the first half leaves open, carried on by a stream of the second half."""
    middle = F.lit("2024-01-16").cast("timestamp")
    before = messages(table(spark, sf, "events").filter(F.col("ts") < middle))
    jobs = ops.open_jobs(before, order=ORDER, required=REQUIRED, slice_by="day")
    msgs = messages(event_stream(spark, sf).filter(F.col("ts") >= middle))
    return barrier_rows(spark, job_barrier_stream(msgs, REQUIRED, timeout_minutes=None, order=["event_id"], open_jobs=jobs))


@STREAMS.add("active_jobs_from_state", ACTIVE_SQL)
def active_from_state(spark: SparkSession, sf: str) -> DataFrame:
    """The active jobs of a stream, read from its state."""
    checkpoint = streams.fresh_folder(spark, "jobs-checkpoint")
    msgs = messages(event_stream(spark, sf))
    barrier_rows(spark, job_barrier_stream(msgs, REQUIRED, timeout_minutes=None, order=["event_id"]), checkpoint)
    return active_rows(jobs_in_state(spark, checkpoint))


# Three files: the first half of the month, the second half, and a quarter of all events that comes after both. Spark tells late events by the
# watermark of the trigger before, so those whose day the first file's watermark closes are not counted in the third trigger.
_COUNTED_SQL = f"""
    SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS count FROM events
    WHERE event_id % 4 <> 0 OR date_trunc('day', ts) + INTERVAL 1 DAY > (SELECT max(ts) FROM events WHERE {FIRST_SQL}) - INTERVAL 3 DAY
    GROUP BY 1, 2
"""


def day_counts(spark: SparkSession, sf: str, mode: str) -> DataFrame:
    folder = streams.fresh_folder(spark, "day-events")
    events = table(spark, sf, "events")
    late, first = F.col("event_id") % 4 == 0, F.expr("ts < timestamp'2024-01-16'")
    for part in (~late & first, ~late & ~first, late):
        events.filter(part).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    counts = per_day_stream(stream, "ts", ["event_type"], late_hours=72)
    path = streams.fresh_folder(spark, "day-counts")
    writer = streams.fan_out(counts, {path: lambda b: b}).outputMode(mode)
    streams.drain(writer, streams.fresh_folder(spark, "day-checkpoint"))
    return streams.read_epochs(spark, path)


@STREAMS.add(
    "scans_per_day_stream",
    f"SELECT * FROM ({_COUNTED_SQL}) WHERE CAST(day AS TIMESTAMP) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 3 DAY",
)
def closed_days(spark: SparkSession, sf: str) -> DataFrame:
    """Days as they are closed: each is written once."""
    return day_counts(spark, sf, "append").drop(streams.EPOCH)


@STREAMS.add("scans_per_day_live", _COUNTED_SQL)
def days_so_far(spark: SparkSession, sf: str) -> DataFrame:
    """The latest count of every day, from the rows of all triggers."""
    return latest_documents(day_counts(spark, sf, "update"), ["day", "event_type"], [streams.EPOCH]).drop(streams.EPOCH)


@STREAMS.add(
    "queue_length_log",
    f"""SELECT CAST(3 - least(greatest({CHUNK_SQL}, 0), 3) AS BIGINT) AS batch, count(*) AS input_rows FROM events GROUP BY 1""",
)
def logged(spark: SparkSession, sf: str) -> DataFrame:
    """What each trigger of a stream took in, as its listener was told."""
    rows, path = [], streams.fresh_folder(spark, "logged")
    log = streams.BatchLog(rows.append)
    spark.streams.addListener(log)
    try:
        query = streams.drain(
            streams.fan_out(falling_stream(spark, sf), {path: lambda b: b.select("event_id")}), streams.fresh_folder(spark, "logged-checkpoint")
        )
        # Listeners are told a little later.
        last, deadline = query.lastProgress["batchId"], time.monotonic() + 30
        while time.monotonic() < deadline and not any(r["query"] == str(query.runId) and r["batch"] == last for r in list(rows)):
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(log)
    told = [(r["batch"], r["input_rows"]) for r in rows if r["query"] == str(query.runId) and r["input_rows"]]
    return spark.createDataFrame(told, "batch long, input_rows long")
