"""Backlog and storage reports over sample tables."""

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanlake.functions.labels import item_label
from scanlake.functions.paths import absolute_path
from scanlake.operators.ordered import (
    SLICE,
    across_slices,
    join_slices,
    restored,
    slice_names,
    sliced,
    within_slice,
)

MIB = 1024 * 1024


def glob_regex(pattern: str) -> str:
    """Regex of a key glob: ``*``, ``?``, ``[abc]``, ``[^a]``, ``[a-z]`` and ``\\`` escapes."""
    out, i = [], 0
    while i < len(pattern):
        c = pattern[i]
        close = pattern.find("]", i + 1)
        if c == "*":
            out.append("(?s:.*)")
        elif c == "?":
            out.append("(?s:.)")
        elif c == "[" and close > 0:
            body = pattern[i + 1 : close]
            negated = body.startswith("^")
            members = re.sub(r"([\\\[\]^&])", r"\\\1", body[negated:])
            out.append(f"[{'^' if negated else ''}{members}]")
            i = close
        elif c == "\\" and i + 1 < len(pattern):
            i += 1
            out.append(re.escape(pattern[i]))
        else:
            out.append(re.escape(c))
        i += 1
    return f"^{''.join(out)}$"


def discover_queues(samples: DataFrame, pattern: str = "*_queue") -> DataFrame:
    """Sorted names of the lists whose name matches the glob."""
    lists = samples.filter((F.col("key_type") == "list") & F.rlike("queue", F.lit(glob_regex(pattern))))
    return lists.select("queue").distinct().orderBy("queue")


def _minutes(later: Column, earlier: Column) -> Column:
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return micros / 60_000_000


def _delta_rate(row: Column, prev: Column) -> Column:
    """Rate since the previous sample; 0 on a fresh history; null = keep the rate before."""
    fresh = prev.isNull() | F.coalesce(prev["ts"] < row["since"], F.lit(False))
    minutes = _minutes(row["ts"], prev["ts"])
    delta = (row["size"] - prev["size"]).cast("double") / minutes
    return F.when(fresh, 0.0).when((prev["size"] > 0) & (minutes > 0), delta)


def _sticky_rates(rows: DataFrame, keys: Sequence[str], slice_by: Column | str) -> DataFrame:
    """Add rate (units per minute) to rows of keys, ts, size and since.

    A null size is a failed look: rate 0, and the previous good sample stays in place.
    Rows are sorted only inside (key, slice). What one slice cannot know is the sample
    before its first good row and the rate kept at its start; the summary carries both.
    """
    local = within_slice(keys, ["ts"])
    upto = local.rowsBetween(Window.unboundedPreceding, 0)
    earlier_rows = local.rowsBetween(Window.unboundedPreceding, -1)
    good = F.col("size").isNotNull()
    sample = F.struct("ts", "size", "since")
    cut = sliced(rows, keys, ["ts"], slice_by).withColumn("_row", F.when(good, sample))
    cut = cut.withColumn("_prev", F.last("_row", True).over(earlier_rows))
    # Known inside the slice: failed looks, and good rows after another good row.
    known = F.when(~good, 0.0).when(F.col("_prev").isNotNull(), _delta_rate(F.col("_row"), F.col("_prev")))
    cut = cut.withColumn("_new", known).withColumn(
        "_kept", F.last(F.when(F.col("_new").isNotNull(), F.struct("ts", F.col("_new").alias("rate"))), True).over(upto)
    )
    path = across_slices(keys)
    earlier = path.rowsBetween(Window.unboundedPreceding, -1)
    slices = (
        cut.groupBy(*slice_names(keys))
        .agg(
            F.min_by("_row", F.when(good, F.col("ts"))).alias("head"),
            F.max_by("_row", F.when(good, F.col("ts"))).alias("tail"),
            F.max_by("_kept", "ts").alias("kept"),
        )
        .withColumn("before", F.last("tail", True).over(earlier))
        .withColumn("head_rate", F.when(F.col("head").isNotNull(), _delta_rate(F.col("head"), F.col("before"))))
        .withColumn("leaves", _kept_rate(F.col("kept"), F.col("head.ts"), F.col("head_rate")))
        .withColumn("rate_before", F.last("leaves", True).over(earlier))
        .select(*slice_names(keys), F.col("head.ts").alias("head_ts"), "head_rate", "rate_before")
    )
    joined = join_slices(cut, slices, keys)
    head_rate = F.when(F.col("ts") >= F.col("head_ts"), F.col("head_rate"))
    rate = F.coalesce(
        _kept_rate(F.col("_kept"), F.col("head_ts"), head_rate), F.col("rate_before"), F.lit(0.0)
    )
    rest = [name for name in rows.columns if name not in keys]
    return joined.select(*restored(keys), *rest, rate.alias("rate"))


def _kept_rate(kept: Column, head_ts: Column, head_rate: Column) -> Column:
    """The later of the last rate known inside the slice and the rate of its first good row."""
    return F.when(head_rate.isNotNull() & (kept.isNull() | (kept["ts"] < head_ts)), head_rate).otherwise(
        kept["rate"]
    )


def _previous_tick(samples: DataFrame, slice_by: Column | str) -> DataFrame:
    """Each sampling time with the one before it, over all queues."""
    ticks = sliced(samples.select("ts").distinct(), [], ["ts"], slice_by)
    # One row per slice of time, however many samples there are.
    before = Window.orderBy(SLICE)
    slices = ticks.groupBy(SLICE).agg(F.max("ts").alias("_end"))
    slices = slices.select(SLICE, F.lag("_end").over(before).alias("_end"))
    ticks = ticks.withColumn("_before", F.lag("ts").over(within_slice([], ["ts"])))
    linked = join_slices(ticks, slices, [])
    return linked.select("ts", F.coalesce("_before", "_end").alias("since"))


def queue_rates(
    samples: DataFrame,
    keys: Sequence[str] = ("queue",),
    max_gap_seconds: float | None = None,
    slice_by: Column | str = "day",
) -> DataFrame:
    """Add rate, items per minute since the previous sample, to (queue, ts, length) samples.

    The rate is computed when the previous length was above 0, else the rate before is
    kept. A queue missing from one sampling time loses its history and starts again at 0.
    Sampling times are those of the whole table; with ``max_gap_seconds`` a longer pause
    marks a vanished queue instead, which saves finding the sampling times.
    """
    rows = samples.withColumnRenamed("length", "size")
    if max_gap_seconds is None:
        rows = rows.join(_previous_tick(samples, slice_by), "ts", "left")
    else:
        rows = rows.withColumn("since", F.col("ts") - F.make_dt_interval(secs=F.lit(max_gap_seconds)))
    rated = _sticky_rates(rows, keys, slice_by).withColumnRenamed("size", "length")
    return rated.select(*samples.columns, "rate")


def growth_rates(
    samples: DataFrame, keys: Sequence[str] = (), slice_by: Column | str = "day"
) -> DataFrame:
    """Add growth, MiB per minute since the last sample of an existing folder.

    size is null when the folder is missing: growth 0 there, and the sample before stays
    the one to compare with. Computed when that size was above 0, else kept.
    """
    rows = samples.withColumn("since", F.lit(None).cast(samples.schema["ts"].dataType))
    rated = _sticky_rates(rows, keys, slice_by).withColumn("growth", F.col("rate") / MIB)
    return rated.select(*samples.columns, "growth")


def recent_items(
    items: DataFrame,
    order: Sequence[str],
    k: int = 3,
    keys: Sequence[str] = ("queue",),
    item: str = "item",
) -> DataFrame:
    """The k newest items per queue as (keys..., rank, label).

    The rank limit also runs before the shuffle, so a hot queue sends k rows per task.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.desc(name) for name in order])
    top = items.withColumn("rank", F.row_number().over(newest)).filter(F.col("rank") <= k)
    return top.select(*keys, "rank", item_label(F.col(item)).alias("label"))


def queue_lengths(items: DataFrame, keys: Sequence[str] = ("queue",)) -> DataFrame:
    """Items per queue."""
    return items.groupBy(*keys).agg(F.count(F.lit(1)).alias("length"))


def pipeline_summary(samples: DataFrame) -> DataFrame:
    """Queues, active queues (length above 0) and total items at the last sampling time."""
    per_time = samples.groupBy("ts").agg(
        F.count(F.lit(1)).alias("queues"),
        F.count_if(F.col("length") > 0).alias("active_queues"),
        F.sum("length").alias("total_items"),
    )
    last = per_time.agg(F.max_by(F.struct("queues", "active_queues", "total_items"), "ts").alias("s"))
    return last.select(
        F.coalesce("s.queues", F.lit(0)).alias("queues"),
        F.coalesce("s.active_queues", F.lit(0)).alias("active_queues"),
        F.coalesce("s.total_items", F.lit(0)).alias("total_items"),
    )


def folder_stats(
    inventory: DataFrame, root: str, by: Sequence[str] = (), cwd: str = "/"
) -> DataFrame:
    """Bytes, files and repositories (folders directly below the root) of a listing.

    The listing may hold files alone: a folder then counts by the files below it. Without
    ``by``, a missing root gives one row of zeros.
    """
    base = absolute_path(F.lit(root), cwd)
    prefix = F.when(base == "/", base).otherwise(F.concat(base, F.lit("/")))
    below = inventory.withColumn("_path", absolute_path(F.col("path"), cwd)).filter(
        F.startswith("_path", prefix)
    )
    parts = F.split(F.substr(F.col("_path"), F.length(prefix) + 1), "/")
    is_repo = F.col("is_dir") | (F.size(parts) > 1)
    grouped = below.select(
        *by, "size", "is_dir", F.when(is_repo, F.get(parts, F.lit(0))).alias("_repo")
    )
    # Per folder first: the hot folder or source is summed map-side, and counting distinct
    # folders becomes a plain count.
    per_repo = grouped.groupBy(*by, "_repo").agg(
        F.sum(F.when(~F.col("is_dir"), F.col("size"))).alias("_bytes"),
        F.count_if(~F.col("is_dir")).alias("_files"),
    )
    return per_repo.groupBy(*by).agg(
        F.coalesce(F.sum("_bytes"), F.lit(0)).alias("total_bytes"),
        F.coalesce(F.sum("_files"), F.lit(0)).alias("files"),
        F.count("_repo").alias("repositories"),
    )


def branch_counts(refs: DataFrame, keys: Sequence[str] = ("org", "name"), ref: str = "ref") -> DataFrame:
    """Branches per repository: refs below refs/heads/; 0 for a repository with none."""
    return refs.groupBy(*keys).agg(
        F.count_if(F.startswith(ref, F.lit("refs/heads/"))).alias("branches")
    )
