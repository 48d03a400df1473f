"""Completion barrier of the two scanners, expiry, and the cleanup plan."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanlake import schemas
from scanlake.functions.paths import absolute_path, path_is_within
from scanlake.operators.ordered import (
    SLICE,
    across_slices,
    group_names,
    join_slices,
    restored,
    slice_names,
    sliced,
    within_slice,
)
from scanlake.schemas import SCANNERS

# Fixed value: idle limit of a job.
JOB_TIMEOUT_MINUTES = 60


def unknown_scanner(msgs: DataFrame, required: Sequence[str] = SCANNERS) -> DataFrame:
    """Messages of other scanners: the quarantine kept out of the barrier."""
    return msgs.filter(~F.coalesce(F.col("scanner_type").isin(*required), F.lit(False)))


def dedup_messages(
    msgs: DataFrame,
    keys: Sequence[str] = ("clone_path", "scanner_type"),
    order: Sequence[str] = ("completed_at",),
) -> DataFrame:
    """The first message per clone path and scanner; a failed scan may report twice.

    A clone path is unique per scan. Not for replays where one path completes repeatedly.
    """
    body = [name for name in msgs.columns if name not in keys]
    first = F.min_by(F.struct(*body), F.struct(*order)).alias("_first")
    return msgs.groupBy(*keys).agg(first).select(*keys, "_first.*").select(*msgs.columns)


def job_progress(
    msgs: DataFrame,
    keys: Sequence[str] = ("clone_path",),
    order: Sequence[str] = ("completed_at",),
    required: Sequence[str] = SCANNERS,
) -> DataFrame:
    """State per clone path, for paths that are scanned once: who completed, with which status.

    One aggregate with map-side combine, so a hot key costs no more than any other.
    """
    a, b = required
    is_a, is_b = F.col("scanner_type") == a, F.col("scanner_type") == b
    at = F.struct(*order)

    def status(mine: Column) -> Column:
        return F.coalesce(F.max_by("scan_status", F.when(mine, at)), F.lit(""))

    return (
        msgs.filter(is_a | is_b)
        .groupBy(*keys)
        .agg(
            F.min_by(F.struct("org", "name"), at).alias("_repo"),
            F.min(order[0]).alias("started_at"),
            F.max(order[0]).alias("last_updated"),
            F.bool_or(is_a).alias("secrets_complete"),
            F.bool_or(is_b).alias("vulnerabilities_complete"),
            status(is_a).alias("secrets_status"),
            status(is_b).alias("vulnerabilities_status"),
        )
        .select(*keys, "_repo.*", "started_at", "last_updated", "secrets_complete",
                "vulnerabilities_complete", "secrets_status", "vulnerabilities_status")
    )


def completed_jobs(progress: DataFrame) -> DataFrame:
    """Jobs both scanners have reported."""
    return progress.filter("secrets_complete AND vulnerabilities_complete")


def cleanup_jobs(jobs: DataFrame, requested_at: Column | str = "requested_at") -> DataFrame:
    """Cleanup rows; worker_id is 0 because no worker asks for them."""
    at = F.col(requested_at) if isinstance(requested_at, str) else requested_at
    rows = jobs.withColumn("requested_at", at).withColumn("worker_id", F.lit(0))
    return rows.select(*schemas.CLEANUP_JOB.names)


def _replayed(
    msgs: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    required: Sequence[str],
    slice_by: Column | str,
    timeout_minutes: float | None,
) -> tuple[DataFrame, DataFrame]:
    """Rows with their local state, and one summary per (key, slice) with the carried state.

    The barrier of two scanners needs no fold. Call a message an anchor when it is the
    key's first, repeats the scanner of the message before, or comes longer than the timeout
    after it: after an anchor the state is exactly {its scanner}, whatever came earlier. From there scanners alternate until the
    next anchor, so the message p places after its anchor completes a cycle iff p is odd.
    Inside a slice only rows before its first repeat depend on earlier slices, through one
    bit: the parity of p at the slice's first row. Both cases are kept until it is known.
    """
    if timeout_minutes is not None and timeout_minutes <= 0:
        raise ValueError("timeout_minutes must be greater than 0")
    a, b = required
    local = within_slice(keys, order)
    upto = local.rowsBetween(Window.unboundedPreceding, 0)

    def gap(at: Column, before: Column) -> Column:
        """Whether a job would have expired between two messages."""
        if timeout_minutes is None:
            return F.lit(False)
        micros = F.unix_micros(at.cast("timestamp")) - F.unix_micros(before.cast("timestamp"))
        return F.coalesce(micros > F.lit(int(timeout_minutes * 60_000_000)), F.lit(False))

    start = F.struct("org", "name", F.col(order[0]).alias("started_at"))
    rows = (
        sliced(msgs.filter(F.col("scanner_type").isin(a, b)), keys, order, slice_by)
        .select(
            *slice_names(keys), *order, "scan_status",
            (F.col("scanner_type") == b).alias("is_b"), start.alias("start"),
        )
        .withColumn("i", F.row_number().over(local) - 1)
        .withColumn("before", F.lag(F.struct("is_b", "scan_status", F.col(order[0]).alias("at"))).over(local))
        .withColumn("gap", gap(F.col(order[0]), F.col("before.at")))
        .withColumn(
            "anchor",
            F.last(F.when((F.col("before.is_b") == F.col("is_b")) | F.col("gap"), F.col("i")), True).over(upto),
        )
        .withColumn("p", F.col("i") - F.col("anchor"))
        .withColumn("p_before", F.lag("p").over(local))
    )
    # A cycle starts after a completion or a gap. first0 / first1: the start of the cycle open at this
    # row if p at the slice's first row is even / odd; null while it began in an earlier slice.
    for bit in (0, 1):
        p_before = F.coalesce(F.col("p_before"), F.col("i") - 1 + bit)
        begins = (F.col("i") > 0) & ((p_before % 2 == 1) | F.col("gap"))
        rows = rows.withColumn(f"first{bit}", F.last(F.when(begins, F.col("start")), True).over(upto))
    if timeout_minutes is not None:
        for bit in (0, 1):
            rows = rows.withColumn(f"open{bit}", F.lag(f"first{bit}").over(local))

    here, at = F.col("i") == 0, F.col("i")
    slices = rows.groupBy(*slice_names(keys)).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.when(here, F.col("is_b"))).alias("head_is_b"),
        F.min(order[0]).alias("head_at"),
        F.max_by("start", F.when(here, at)).alias("head_start"),
        F.max_by(F.struct("is_b", "scan_status", F.col(order[0]).alias("at"), "p", "first0", "first1"), at)
        .alias("tail"),
    )
    path = across_slices(keys)
    so_far = path.rowsBetween(Window.unboundedPreceding, 0)
    earlier = path.rowsBetween(Window.unboundedPreceding, -1)
    slices = (
        slices.withColumn("prev", F.lag("tail").over(path))
        .withColumn("head_gap", gap(F.col("head_at"), F.col("prev.at")))
        .withColumn(
            "head_anchors",
            F.coalesce((F.col("prev.is_b") == F.col("head_is_b")) | F.col("head_gap"), F.lit(True)),
        )
        # p of the slice's last row where it is known, then counted on through the others.
        .withColumn("known", F.coalesce("tail.p", F.when(F.col("head_anchors"), F.col("n") - 1)))
        .withColumn("total", F.sum("n").over(so_far))
        .withColumn("p_last", F.last(F.col("known") - F.col("total"), True).over(so_far) + F.col("total"))
        .withColumn("p_prev", F.lag("p_last").over(path))
        .withColumn("bit", F.when(F.col("head_anchors"), 0).otherwise((F.col("p_prev") + 1) % 2))
        .withColumn("head_begins", F.coalesce((F.col("p_prev") % 2 == 1) | F.col("head_gap"), F.lit(True)))
        .withColumn(
            "opened",
            F.coalesce(
                F.when(F.col("bit") == 0, F.col("tail.first0")).otherwise(F.col("tail.first1")),
                F.when(F.col("head_begins"), F.col("head_start")),
            ),
        )
        .withColumn("opened_before", F.last("opened", True).over(earlier))
        .withColumn("opened", F.last("opened", True).over(so_far))
    )
    return rows, slices


def completion_barrier(
    msgs: DataFrame,
    keys: Sequence[str] = ("clone_path",),
    order: Sequence[str] = ("completed_at",),
    required: Sequence[str] = SCANNERS,
    slice_by: Column | str = "hour",
    timeout_minutes: float | None = None,
) -> DataFrame:
    """Cleanup rows of a replay in arrival order, for paths that may complete repeatedly.

    One row whenever both scanners have reported since the last one; then the state is
    empty again. Repeats are idempotent and a later status replaces the earlier. ``order``
    must be unique per key; org, name and started_at are those of the cycle's first message.

    With ``timeout_minutes``, a job that waits longer than that for the next message expires:
    it gives a row with ``expired`` true, requested when its last message came, and the
    next message opens a new job. Jobs that are open at the end are ``open_jobs``.
    """
    rows, slices = _replayed(msgs, keys, order, required, slice_by, timeout_minutes)
    carried = slices.select(
        *slice_names(keys), "bit", "head_begins", "head_start", "opened_before",
        F.col("prev.scan_status").alias("status_before"), F.col("prev.is_b").alias("was_b"),
        F.col("prev.at").alias("at_before"), (F.col("head_gap") & (F.col("p_prev") % 2 == 0)).alias("head_expires"),
    )
    joined = join_slices(rows, carried, keys)
    done = _completed(joined, keys, order)
    if timeout_minutes is None:
        return done
    return done.withColumn("expired", F.lit(False)).unionByName(_expired(joined, keys))


def _expired(joined: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The job that was open before each gap, from the first message after it."""
    first = F.col("i") == 0
    p_before = F.coalesce(F.col("p_before"), F.col("i") - 1 + F.col("bit"))
    # Inside the slice: the cycle open at the row before, from this slice or an earlier one.
    opened = F.when(first, F.col("opened_before")).otherwise(
        F.coalesce(
            F.when(F.col("bit") == 0, F.col("open0")).otherwise(F.col("open1")),
            F.when(F.col("head_begins"), F.col("head_start")),
            F.col("opened_before"),
        )
    )
    is_b = F.when(first, F.col("was_b")).otherwise(F.col("before.is_b"))
    status = F.when(first, F.col("status_before")).otherwise(F.col("before.scan_status"))
    expires = F.when(first, F.col("head_expires")).otherwise(F.col("gap") & (p_before % 2 == 0))
    return (
        joined.filter(F.coalesce(expires, F.lit(False)))
        .withColumn("opened", opened)
        .select(
            *restored(keys),
            "opened.org",
            "opened.name",
            "opened.started_at",
            F.when(first, F.col("at_before")).otherwise(F.col("before.at")).alias("requested_at"),
            F.lit(0).alias("worker_id"),
            F.when(~is_b, status).alias("secrets_status"),
            F.when(is_b, status).alias("vulnerabilities_status"),
            F.lit(True).alias("expired"),
        )
    )


def _completed(joined: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    opened = F.coalesce(
        F.when(F.col("bit") == 0, F.col("first0")).otherwise(F.col("first1")),
        F.when(F.col("head_begins"), F.col("head_start")),
        F.col("opened_before"),
    )
    other = F.coalesce(F.col("before.scan_status"), F.col("status_before"))
    return (
        joined.filter(F.coalesce(F.col("p"), F.col("i") + F.col("bit")) % 2 == 1)
        .withColumn("opened", opened)
        .select(
            *restored(keys),
            "opened.org",
            "opened.name",
            "opened.started_at",
            F.col(order[0]).alias("requested_at"),
            F.lit(0).alias("worker_id"),
            F.when(F.col("is_b"), other).otherwise(F.col("scan_status")).alias("secrets_status"),
            F.when(F.col("is_b"), F.col("scan_status")).otherwise(other).alias("vulnerabilities_status"),
        )
    )


def open_jobs(
    msgs: DataFrame,
    keys: Sequence[str] = ("clone_path",),
    order: Sequence[str] = ("completed_at",),
    required: Sequence[str] = SCANNERS,
    slice_by: Column | str = "hour",
    timeout_minutes: float | None = None,
) -> DataFrame:
    """Jobs a replay leaves open: one scanner has reported since the last completion.

    With ``timeout_minutes`` also since the last gap over that limit.
    """
    _, slices = _replayed(msgs, keys, order, required, slice_by, timeout_minutes)
    last = F.max_by(F.struct("p_last", "tail", "opened"), SLICE).alias("s")
    ends = slices.groupBy(*group_names(keys)).agg(last).filter("s.p_last % 2 = 0")
    is_b, status = F.col("s.tail.is_b"), F.col("s.tail.scan_status")
    return ends.select(
        *restored(keys),
        "s.opened.org",
        "s.opened.name",
        "s.opened.started_at",
        F.col("s.tail.at").alias("last_updated"),
        (~is_b).alias("secrets_complete"),
        is_b.alias("vulnerabilities_complete"),
        F.when(is_b, "").otherwise(status).alias("secrets_status"),
        F.when(is_b, status).otherwise("").alias("vulnerabilities_status"),
    )


def idle_seconds(now: Column) -> Column:
    """Time since a job's last message, with its fraction."""
    micros = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("last_updated").cast("timestamp"))
    return micros / 1_000_000


def expire_jobs(
    state: DataFrame, now: Column, timeout_minutes: int = JOB_TIMEOUT_MINUTES
) -> DataFrame:
    """Jobs idle strictly longer than the limit; each also gets a cleanup row.

    A job both scanners have reported is no longer waiting and does not expire.
    """
    if timeout_minutes <= 0:
        raise ValueError("timeout_minutes must be greater than 0")
    waiting = state.filter("NOT (secrets_complete AND vulnerabilities_complete)")
    return waiting.filter(idle_seconds(now) > timeout_minutes * 60)


def active_jobs(
    state: DataFrame, now: Column, timeout_minutes: int = JOB_TIMEOUT_MINUTES
) -> DataFrame:
    """Jobs started, not complete and not expired, with their flags and statuses."""
    waiting = state.filter("NOT (secrets_complete AND vulnerabilities_complete)")
    return waiting.filter(idle_seconds(now) <= timeout_minutes * 60)


def completion_messages(scans: DataFrame, scanner_type: str) -> DataFrame:
    """The message each finished scan sends; scans carry clone_path beside the scan record."""
    return scans.select(
        "clone_path", "org", "name",
        F.lit(scanner_type).alias("scanner_type"),
        F.col("scanned_at").alias("completed_at"),
        "worker_id", "scan_status", "scan_duration",
    )


def cleanup_plan(
    jobs: DataFrame,
    inventory: DataFrame,
    root: str,
    cwd: str = "/",
    prefix_only: bool = False,
) -> DataFrame:
    """Add action to each cleanup job: unsafe, missing or remove.

    ``inventory`` lists existing folders in ``path``. Only safe paths look there.
    """
    known = inventory.select(absolute_path(F.col("path"), cwd).alias("_known")).distinct()
    checked = jobs.withColumn("_safe", path_is_within(F.col("clone_path"), root, cwd, prefix_only))
    # Unsafe paths keep a key of their own that no folder has: as nulls they would all meet
    # in one task.
    path = F.when(F.col("_safe"), absolute_path(F.col("clone_path"), cwd))
    checked = checked.withColumn("_path", path.otherwise(F.concat(F.lit("unsafe:"), "clone_path")))
    action = (
        F.when(~F.coalesce(F.col("_safe"), F.lit(False)), "unsafe")
        .when(F.col("_known").isNull(), "missing")
        .otherwise("remove")
    )
    joined = checked.join(known, F.col("_path") == F.col("_known"), "left")
    return joined.withColumn("action", action).drop("_safe", "_path", "_known")
