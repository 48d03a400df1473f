"""The completion barrier as a stateful processor: typed state, timers, a start from saved jobs, and late messages kept."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from scanlake.operators.coordination import JOB_TIMEOUT_MINUTES
from scanlake.schemas import SCANNERS

# What an output row is: both scanners reported, a job stayed idle, or a message came behind the watermark.
DONE, EXPIRED, LATE = "done", "expired", "late"

# Times are microseconds, so that no zone of a worker matters; a null status has not been reported yet.
JOB = "org string, name string, started long, secrets string, vulnerabilities string, updated long, timer long"
OUT = "clone_path string, kind string, org string, name string, started long, requested long, secrets string, vulnerabilities string"

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class JobBarrier(StatefulProcessor):
    """One clone path: its open job as a value state, and a timer while it is open."""

    def __init__(self, required: Sequence[str], timeout_minutes: int | None, order: Sequence[str]):
        self.required, self.timeout, self.order = list(required), timeout_minutes, list(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.job = handle.getValueState("job", JOB)

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
        saved = initialState
        self._store([saved.org, saved.name, saved.started, saved.secrets, saved.vulnerabilities, saved.updated, None])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        job = list(self.job.get()) if self.job.exists() else None
        timer = job[6] if job else None
        fields = [*self.order, "scanner_type", "scan_status", "org", "name"]
        for m in sorted(rows, key=lambda m: [(m[f] is not None, m[f] if m[f] is not None else 0) for f in fields]):
            if m.at is None or m.at < watermark:
                status = [m.scan_status if m.scanner_type == s else None for s in self.required]
                yield self._row(key, LATE, [m.org, m.name, None, *status], m.at)
                continue
            if job and self.timeout is not None and m.at - job[5] > self.timeout * 60_000_000:
                yield self._row(key, EXPIRED, job, job[5])
                job = None
            job = job or [m.org, m.name, m.at, None, None, None, None]
            job[3 + self.required.index(m.scanner_type)] = m.scan_status or ""
            job[5] = m.at
            if job[3] is not None and job[4] is not None:
                yield self._row(key, DONE, job, m.at)
                job = None
        if timer is not None:
            self.handle.deleteTimer(timer)
        if job:
            self._store(job)
        else:
            self.job.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        if self.job.exists():
            job = self.job.get()
            self.job.clear()
            yield self._row(key, EXPIRED, job, job[5])

    def close(self) -> None:
        pass

    def _store(self, job: list) -> None:
        if self.timeout is not None:
            job[6] = -(-job[5] // 1000) + self.timeout * 60_000
            self.handle.registerTimer(job[6])
        self.job.update(tuple(job))

    @staticmethod
    def _row(key, kind: str, job: Sequence, requested: int | None) -> Row:
        return Row(
            clone_path=key[0], kind=kind, org=job[0], name=job[1], started=job[2], requested=requested, secrets=job[3], vulnerabilities=job[4]
        )


def job_barrier_stream(
    msgs: DataFrame,
    required: Sequence[str] = SCANNERS,
    timeout_minutes: int | None = JOB_TIMEOUT_MINUTES,
    late_minutes: int = 5,
    order: Sequence[str] = (),
    open_jobs: DataFrame | None = None,
) -> DataFrame:
    """Rows of three kinds: ``done`` as both scanners have reported, ``expired`` when a job stays idle in event time, ``late`` for messages.

    No message is lost: one that comes behind the watermark, or without a time, is given back as ``late`` with its own time and status and
    changes no job. The others count trigger by trigger, inside one by time, then ``order``. A gap over the limit between two messages, or the watermark
    passing it, expires a job; ``timeout_minutes=None`` never does. ``open_jobs`` (a batch frame, as the operator of that name returns it) are
    the jobs to start from; they count only in a new checkpoint. State is one small row and one timer for each open path.

    Spark itself drops late rows where an operator sees the column of the watermark. Here the time goes in as a number: the watermark
    still advances by ``completed_at``, and the processor compares by itself.
    """
    if timeout_minutes is not None and timeout_minutes <= 0:
        raise ValueError("timeout_minutes must be greater than 0")
    known = msgs.filter(F.col("scanner_type").isin(*required)).withWatermark("completed_at", f"{late_minutes} minutes")
    numbered = known.select("clone_path", F.unix_micros("completed_at").alias("at"), "scanner_type", "scan_status", "org", "name", *order)
    saved = None
    if open_jobs is not None:
        status = [F.when(F.col(f"{s}_complete"), F.coalesce(F.col(f"{s}_status"), F.lit(""))).alias(s) for s in ("secrets", "vulnerabilities")]
        times = [F.unix_micros("started_at").alias("started"), *status, F.unix_micros("last_updated").alias("updated")]
        saved = open_jobs.select("clone_path", "org", "name", *times).groupBy("clone_path")
    found = numbered.groupBy("clone_path").transformWithState(
        JobBarrier(required, timeout_minutes, ("at", *order)), OUT, "append", "eventtime", initialState=saved
    )
    return found.select(
        "clone_path", "kind", "org", "name", F.timestamp_micros("started").alias("started_at"), F.timestamp_micros("requested").alias("requested_at"),
        F.col("secrets").alias("secrets_status"), F.col("vulnerabilities").alias("vulnerabilities_status"),
    )


def jobs_in_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The jobs that a ``job_barrier_stream`` holds open as of its last finished trigger, with the columns of ``open_jobs``.

    Read from the state store's files by the state data source, one task for each state partition; the stream may be running.
    """
    job = spark.read.format("statestore").option("stateVarName", "job").load(checkpoint).select("key.clone_path", "value.*")
    return job.select(
        "clone_path", "org", "name", F.timestamp_micros("started").alias("started_at"), F.timestamp_micros("updated").alias("last_updated"),
        F.col("secrets").isNotNull().alias("secrets_complete"), F.col("vulnerabilities").isNotNull().alias("vulnerabilities_complete"),
        F.coalesce("secrets", F.lit("")).alias("secrets_status"), F.coalesce("vulnerabilities", F.lit("")).alias("vulnerabilities_status"),
    )


@contextmanager
def state_in_rocksdb(spark: SparkSession) -> Iterator[None]:
    """The store that stateful processors need, for queries started inside; a query keeps it in its checkpoint."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)
