"""Queries over the completion barrier, expiry and the cleanup plan."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake.operators import coordination as ops
from scanlake.plans.query import Registry
from scanlake.sources.tables import table

COORDINATION = Registry()

REQUIRED = ("click", "purchase")


def messages(spark: SparkSession, sf: str, key: Column | None = None) -> DataFrame:
    """Events as completion messages; by default a clone path per user."""
    user = F.col("user_id").cast("string")
    return table(spark, sf, "events").select(
        (user if key is None else key).alias("clone_path"),
        F.concat(F.lit("e"), "event_id").alias("org"),
        F.concat(F.lit("u"), user).alias("name"),
        F.col("event_type").alias("scanner_type"),
        F.col("ts").alias("completed_at"),
        (F.col("event_id") % 5).cast("int").alias("worker_id"),
        F.concat(F.lit("s"), "event_id").alias("scan_status"),
        F.lit(1_000_000_000).alias("scan_duration"),
        "event_id",
    )


def day_key() -> Column:
    return F.concat_ws("/", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd"))


ORDER = ["completed_at", "event_id"]

def replay_sql(arrival: str = "ts, event_id", timeout: str | None = None, where: str = "true") -> str:
    """The state of each path after each message, one message at a time.

    A gap over the timeout empties the state as a completion does.
    """
    done = "r.a IS NOT NULL AND r.b IS NOT NULL"
    if timeout:
        done = f"({done} OR m.ts - r.ts > INTERVAL {timeout})"
    return f"""
    WITH RECURSIVE m AS (
        SELECT CAST(user_id AS VARCHAR) AS clone_path, 'e' || event_id AS org, 'u' || user_id AS name, event_type AS kind,
               ts, 's' || event_id AS status, row_number() OVER (PARTITION BY user_id ORDER BY {arrival}) AS n
        FROM events WHERE event_type IN ('click', 'purchase') AND {where}),
    replay AS (
        SELECT clone_path, n, org, name, ts AS started, ts,
               CASE WHEN kind = 'click' THEN status END AS a, CASE WHEN kind = 'purchase' THEN status END AS b
        FROM m WHERE n = 1
        UNION ALL
        SELECT m.clone_path, m.n,
               CASE WHEN {done} THEN m.org ELSE r.org END, CASE WHEN {done} THEN m.name ELSE r.name END,
               CASE WHEN {done} THEN m.ts ELSE r.started END, m.ts,
               CASE WHEN m.kind = 'click' THEN m.status WHEN {done} THEN NULL ELSE r.a END,
               CASE WHEN m.kind = 'purchase' THEN m.status WHEN {done} THEN NULL ELSE r.b END
        FROM replay r JOIN m ON m.clone_path = r.clone_path AND m.n = r.n + 1)
"""


REPLAY_SQL = replay_sql()


def expiry_sql(timeout: str, idle_at_end: str = "false", arrival: str = "ts, event_id", where: str = "true") -> str:
    """Completed jobs, and jobs that the next message, or the end, finds idle for too long."""
    return (
        replay_sql(arrival, timeout, where)
        + f"""
    SELECT clone_path, org, name, strftime(started, '%Y-%m-%d %H:%M:%S.%f') AS started_at,
           strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS requested_at, 0 AS worker_id,
           a AS secrets_status, b AS vulnerabilities_status, NOT complete AS expired
    FROM (SELECT *, a IS NOT NULL AND b IS NOT NULL AS complete,
                 lead(ts) OVER (PARTITION BY clone_path ORDER BY n) AS next FROM replay)
    WHERE complete OR next - ts > INTERVAL {timeout} OR (next IS NULL AND {idle_at_end})
    """
    )


def stamp(name: str, as_name: str | None = None) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(as_name or name)


@COORDINATION.add(
    "completion_barrier",
    REPLAY_SQL
    + """
    SELECT clone_path, org, name, strftime(started, '%Y-%m-%d %H:%M:%S.%f') AS started_at,
           strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS requested_at, 0 AS worker_id,
           a AS secrets_status, b AS vulnerabilities_status
    FROM replay WHERE a IS NOT NULL AND b IS NOT NULL
    """,
)
def barrier(spark: SparkSession, sf: str) -> DataFrame:
    done = ops.completion_barrier(messages(spark, sf), order=ORDER, required=REQUIRED, slice_by="day")
    return done.select(
        "clone_path", "org", "name", stamp("started_at"), stamp("requested_at"), "worker_id",
        "secrets_status", "vulnerabilities_status",
    )


TIMEOUT = "12 HOUR"


@COORDINATION.add("completion_barrier_expiry", expiry_sql(TIMEOUT))
def barrier_with_expiry(spark: SparkSession, sf: str) -> DataFrame:
    done = ops.completion_barrier(
        messages(spark, sf), order=ORDER, required=REQUIRED, slice_by="day", timeout_minutes=12 * 60
    )
    return done.select(
        "clone_path", "org", "name", stamp("started_at"), stamp("requested_at"), "worker_id",
        "secrets_status", "vulnerabilities_status", "expired",
    )


ACTIVE_SQL = (
    REPLAY_SQL
    + """
    SELECT clone_path, org, name, strftime(started, '%Y-%m-%d %H:%M:%S.%f') AS started_at,
           strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS last_updated,
           a IS NOT NULL AS secrets_complete, b IS NOT NULL AS vulnerabilities_complete,
           coalesce(a, '') AS secrets_status, coalesce(b, '') AS vulnerabilities_status
    FROM (SELECT *, row_number() OVER (PARTITION BY clone_path ORDER BY n DESC) AS back FROM replay)
    WHERE back = 1 AND (a IS NULL OR b IS NULL) AND TIMESTAMP '2024-01-31' - ts <= INTERVAL 1 DAY
    """
)


def active_rows(state: DataFrame) -> DataFrame:
    now = F.lit("2024-01-31 00:00:00").cast("timestamp")
    return ops.active_jobs(state, now, timeout_minutes=24 * 60).select(
        "clone_path", "org", "name", stamp("started_at"), stamp("last_updated"), "secrets_complete",
        "vulnerabilities_complete", "secrets_status", "vulnerabilities_status",
    )


@COORDINATION.add("active_jobs", ACTIVE_SQL)
def active(spark: SparkSession, sf: str) -> DataFrame:
    state = ops.open_jobs(messages(spark, sf), order=ORDER, required=REQUIRED, slice_by="day")
    return active_rows(state)


PROGRESS_SQL = """
    SELECT user_id || '/' || strftime(ts, '%Y-%m-%d') AS clone_path, min(ts) AS started, max(ts) AS updated,
           bool_or(event_type = 'click') AS a, bool_or(event_type = 'purchase') AS b,
           coalesce(arg_max('s' || event_id, ts) FILTER (event_type = 'click'), '') AS a_status,
           coalesce(arg_max('s' || event_id, ts) FILTER (event_type = 'purchase'), '') AS b_status,
           arg_min('e' || event_id, ts) AS org
    FROM events WHERE event_type IN ('click', 'purchase') GROUP BY 1
"""


@COORDINATION.add(
    "completed_jobs",
    f"""SELECT clone_path, org, strftime(started, '%Y-%m-%d %H:%M:%S.%f') AS started_at,
               strftime(updated, '%Y-%m-%d %H:%M:%S.%f') AS requested_at, 0 AS worker_id,
               a_status AS secrets_status, b_status AS vulnerabilities_status
        FROM ({PROGRESS_SQL}) WHERE a AND b""",
)
def completed(spark: SparkSession, sf: str) -> DataFrame:
    progress = ops.job_progress(messages(spark, sf, day_key()), order=ORDER, required=REQUIRED)
    done = ops.completed_jobs(progress).withColumn("worker_id", F.lit(0))
    return done.select(
        "clone_path", "org", stamp("started_at"), stamp("last_updated", "requested_at"), "worker_id",
        "secrets_status", "vulnerabilities_status",
    )


@COORDINATION.add(
    "expired_jobs",
    f"""SELECT clone_path, org, strftime(TIMESTAMP '2024-01-20', '%Y-%m-%d %H:%M:%S.%f') AS requested_at, 0 AS worker_id
        FROM ({PROGRESS_SQL}) WHERE NOT (a AND b) AND TIMESTAMP '2024-01-20' - updated > INTERVAL 60 MINUTE""",
)
def expired(spark: SparkSession, sf: str) -> DataFrame:
    progress = ops.job_progress(messages(spark, sf, day_key()), order=ORDER, required=REQUIRED)
    now = F.lit("2024-01-20 00:00:00").cast("timestamp")
    rows = ops.cleanup_jobs(ops.expire_jobs(progress, now), now)
    return rows.select("clone_path", "org", stamp("requested_at"), "worker_id")


@COORDINATION.add(
    "unknown_scanner",
    "SELECT event_id, event_type AS scanner_type FROM events WHERE event_type NOT IN ('click', 'purchase')",
)
def unknown(spark: SparkSession, sf: str) -> DataFrame:
    return ops.unknown_scanner(messages(spark, sf), REQUIRED).select("event_id", "scanner_type")


@COORDINATION.add(
    "dedup_messages",
    """SELECT CAST(user_id AS VARCHAR) AS clone_path, event_type AS scanner_type, event_id
       FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events)
       WHERE rn = 1""",
)
def deduplicated(spark: SparkSession, sf: str) -> DataFrame:
    rows = ops.dedup_messages(messages(spark, sf), order=ORDER)
    return rows.select("clone_path", "scanner_type", "event_id")


@COORDINATION.add(
    "cleanup_plan",
    """
    SELECT page_id, CASE WHEN page_id % 5 = 0 THEN 'unsafe'
                         WHEN doc_id IS NULL THEN 'missing' ELSE 'remove' END AS action
    FROM pages LEFT JOIN (SELECT doc_id FROM documents WHERE doc_id % 2 = 0) ON page_id = doc_id
    """,
)
def plan(spark: SparkSession, sf: str) -> DataFrame:
    folder = F.when(F.col("page_id") % 5 == 0, "/shared/work/../").otherwise("/shared/work/./")
    jobs = table(spark, sf, "pages").select(
        "page_id", F.concat(folder, F.lit("doc_"), "page_id").alias("clone_path")
    )
    inventory = table(spark, sf, "documents").filter("doc_id % 2 = 0").select(
        F.concat(F.lit("/shared/work/doc_"), "doc_id").alias("path")
    )
    return ops.cleanup_plan(jobs, inventory, "/shared/work").select("page_id", "action")
