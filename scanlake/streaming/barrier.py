"""The completion barrier as a stream."""

from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from scanlake.operators.coordination import JOB_TIMEOUT_MINUTES
from scanlake.schemas import SCANNERS

OUTPUT = (
    "clone_path string, org string, name string, started_at timestamp, requested_at timestamp, "
    "worker_id int, secrets_status string, vulnerabilities_status string, expired boolean"
)
STATE = (
    "org string, name string, started_at timestamp, secrets_status string, "
    "vulnerabilities_status string, last_updated timestamp"
)

MESSAGE = ("org", "name", "scanner_type", "scan_status", "completed_at")

CLOCKS = {
    None: GroupStateTimeout.NoTimeout,
    "processing": GroupStateTimeout.ProcessingTimeTimeout,
    "event": GroupStateTimeout.EventTimeTimeout,
}


def completion_barrier_stream(
    msgs: DataFrame,
    required: Sequence[str] = SCANNERS,
    timeout_minutes: int | None = JOB_TIMEOUT_MINUTES,
    clock: str = "processing",
    late_minutes: int = 5,
    order: Sequence[str] = ("completed_at",),
) -> DataFrame:
    """Cleanup rows as both scanners report, or (expired) when a job stays idle too long.

    Messages count by arrival: triggers one after another, and inside a trigger by ``order``
    (then by all their fields, so that ties do not depend on the shuffle). A source in time
    order gives the result of the batch replay.

    ``clock`` is the time idleness is measured in: processing time, or event time for
    replays. With event time, a gap over the limit between two messages of a path expires the
    job between them, also inside a trigger, as ``completion_barrier`` does; messages may be
    ``late_minutes`` late, and Spark drops later ones, so choose it as long as the source can
    lag. ``timeout_minutes=None`` never expires a job. State is one small row per open clone path, kept in the state store and
    its checkpoint; a restart loses nothing. The messages of one path in one trigger meet in
    one task: bound the trigger at the source (files or offsets per trigger).
    """
    if timeout_minutes is None:
        clock = None
    elif timeout_minutes <= 0:
        raise ValueError("timeout_minutes must be greater than 0")
    if clock == "event":
        msgs = msgs.withWatermark("completed_at", f"{late_minutes} minutes")
    known = msgs.filter(F.col("scanner_type").isin(*required)).select(
        "clone_path", *MESSAGE, *[name for name in order if name not in MESSAGE]
    )
    return known.groupBy("clone_path").applyInPandasWithState(
        barrier_step(required, timeout_minutes, clock, order), OUTPUT, STATE, "append", CLOCKS[clock]
    )


def barrier_step(
    required: Sequence[str],
    timeout_minutes: int | None,
    clock: str | None,
    order: Sequence[str] = ("completed_at",),
) -> Callable[[tuple, Iterable[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """State function of one clone path; a status of None means not reported yet."""
    by = [*order, *[name for name in MESSAGE if name not in order]]
    limit = pd.Timedelta(minutes=timeout_minutes) if clock == "event" else None
    columns = [part.split(" ")[0] for part in OUTPUT.split(", ")]

    def step(key, batches, state):
        job = list(state.get) if state.exists else None
        done = []
        if state.hasTimedOut:
            done.append((*job[:3], _now(state, clock, job), 0, *job[3:5], True))
            job = None
        else:
            for m in _in_order(batches, by):
                if job is not None and limit is not None and m.completed_at - job[5] > limit:
                    done.append((*job[:3], job[5], 0, *job[3:5], True))
                    job = None
                if job is None:
                    job = [m.org, m.name, m.completed_at, None, None, None]
                job[3 + list(required).index(m.scanner_type)] = m.scan_status
                job[5] = m.completed_at
                if job[3] is not None and job[4] is not None:
                    done.append((*job[:3], m.completed_at, 0, *job[3:5], False))
                    job = None
        _store(state, job, timeout_minutes, clock)
        if done:
            yield pd.DataFrame(dict(zip(columns, zip(*[(*key, *row) for row in done], strict=True), strict=True)))

    return step


class _Message(NamedTuple):
    org: str
    name: str
    scanner_type: str
    scan_status: str
    completed_at: pd.Timestamp


def _in_order(batches: Iterable[pd.DataFrame], by: Sequence[str]) -> list[_Message]:
    """The messages of all batches, sorted; nulls come last.

    A path has a few messages a trigger: sorting a frame and walking over it would cost a hundred times what they do.
    """
    found = []
    for batch in batches:
        # A null is none, or a time or number that is not equal to itself.
        keys = zip(*([(v is None or v != v, v) for v in batch[name].tolist()] for name in by), strict=True)
        found += zip(keys, map(_Message, *(batch[name].tolist() for name in MESSAGE)), strict=True)
    found.sort(key=lambda pair: [(missing, None if missing else v) for missing, v in pair[0]])
    return [m for _, m in found]


def _now(state: GroupState, clock: str, job: list):
    """When an expired job asks for its cleanup."""
    if clock == "event":
        return job[5]
    return pd.Timestamp(state.getCurrentProcessingTimeMs(), unit="ms")


def _store(state: GroupState, job: list | None, timeout_minutes: int | None, clock: str | None) -> None:
    if job is None:
        if state.exists:
            state.remove()
        return
    state.update(tuple(job))
    if clock == "processing":
        state.setTimeoutDuration(timeout_minutes * 60_000)
    elif clock == "event":
        idle_until = int(pd.Timestamp(job[5]).timestamp() * 1000) + timeout_minutes * 60_000
        state.setTimeoutTimestamp(max(idle_until, state.getCurrentWatermarkMs() + 1))
