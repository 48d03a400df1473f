"""Ordered scans of keyed rows that never put a whole key into one task.

A window over a key alone sorts all rows of that key in one task. Here every key is cut
into slices of its order (an hour, a day, ...): windows run inside (key, slice), one small
summary row per (key, slice) carries values across slices, and the summary joins back on
the columns the rows are already partitioned by, so the rows are shuffled once.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

SLICE = "_slice"


def group_names(keys: Sequence[str]) -> list[str]:
    """The columns ``sliced`` adds for the keys."""
    return [name for i in range(len(keys)) for name in (f"_key{i}", f"_no_key{i}")]


def sliced(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], slice_by: Column | str
) -> DataFrame:
    """Add the slice and replace the keys by null-free columns; ``restored`` undoes it.

    The slice is a column that never falls along the order, or a time unit for it. Plain
    equality on null-free columns keeps one partitioning for windows and joins; a null-safe
    join condition would shuffle the rows again. Keys are not carried twice, so rows and
    summary can share one exchange.
    """
    cut = F.date_trunc(slice_by, F.col(order[0])) if isinstance(slice_by, str) else slice_by
    df = df.withColumn(SLICE, cut)
    added = {SLICE: _present(F.col(SLICE), df.schema[SLICE].dataType)}
    for i, key in enumerate(keys):
        added[f"_key{i}"] = _present(F.col(key), df.schema[key].dataType)
        added[f"_no_key{i}"] = F.col(key).isNull()
    return df.withColumns(added).drop(*keys)


def restored(keys: Sequence[str]) -> list[Column]:
    """The keys of sliced rows."""
    return [
        F.when(~F.col(f"_no_key{i}"), F.col(f"_key{i}")).alias(key) for i, key in enumerate(keys)
    ]


def _present(col: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.NumericType):
        zero = F.lit(0)
    elif isinstance(kind, T.BooleanType):
        zero = F.lit(False)
    elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        zero = F.lit("1970-01-01")
    else:
        zero = F.lit("")
    return F.coalesce(col, zero.cast(kind))


def slice_names(keys: Sequence[str]) -> list[str]:
    """What identifies one slice of one key."""
    return [*group_names(keys), SLICE]


def within_slice(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    """Window over one slice of one key."""
    return Window.partitionBy(*slice_names(keys)).orderBy(*order)


def across_slices(keys: Sequence[str]) -> WindowSpec:
    """Window over the slice summaries of one key."""
    return Window.partitionBy(*group_names(keys)).orderBy(SLICE)


def join_slices(rows: DataFrame, slices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bring each slice's carried values to its rows."""
    return rows.join(slices, slice_names(keys))


def running_rank(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], slice_by: Column | str, out: str
) -> DataFrame:
    """Exact 1-based row number per key along a unique order."""
    names = slice_names(keys)
    cut = sliced(df, keys, order, slice_by)
    before = across_slices(keys).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*names)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*names, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    local = cut.withColumn("_local", F.row_number().over(within_slice(keys, order)))
    rest = [name for name in df.columns if name not in keys]
    rank = (F.col("_local") + F.col("_offset")).alias(out)
    ranked = join_slices(local, offsets, keys).select(*restored(keys), *rest, rank)
    return ranked.select(*df.columns, out)
