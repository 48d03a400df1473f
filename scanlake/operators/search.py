"""Reads the document schemas exist for: terms, words, nested conditions, dates."""

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanlake.functions.binding import bound

_NO_WORD = r"[^\p{L}\p{N}_]"


def terms_count(df: DataFrame, field: str, top: int = 10, where: Column | None = None) -> DataFrame:
    """The most frequent values of a keyword field, ties in value order."""
    rows = df if where is None else df.filter(where)
    counts = rows.groupBy(field).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), F.asc(field)).limit(top)


def text_match(text: Column, query: str, operator: str = "or") -> Column:
    """Whether any (or every) word of the query is a word of the text, ignoring case.

    Words are runs of letters, digits and underscores of any script. A literal search
    comes first, so the pattern runs only on texts that hold the letters at all.
    """
    wanted = sorted({w for w in re.split(r"\W+", query.lower()) if w})
    if operator not in ("or", "and") or not wanted:
        raise ValueError("operator is 'or' or 'and', and the query needs a word")
    combine = (lambda a, b: a | b) if operator == "or" else (lambda a, b: a & b)
    return bound(F.lower(text), lambda t: reduce(combine, [_has_word(t, w) for w in wanted]))


def _has_word(text: Column, word: str) -> Column:
    alone = rf"(?:^|{_NO_WORD}){word}(?:$|{_NO_WORD})"
    return F.contains(text, F.lit(word)) & F.rlike(text, F.lit(alone))


def nested_match(df: DataFrame, array: str, condition: Callable[[Column], Column]) -> DataFrame:
    """Rows where one and the same array element meets the condition."""
    return df.filter(F.coalesce(F.exists(array, condition), F.lit(False)))


def per_day(df: DataFrame, ts: str, keys: Sequence[str] = ()) -> DataFrame:
    """Documents per day, and per key if any."""
    day = F.date_format(ts, "yyyy-MM-dd").alias("day")
    return df.groupBy(day, *keys).agg(F.count(F.lit(1)).alias("count"))


def per_day_stream(df: DataFrame, ts: str, keys: Sequence[str] = (), late_hours: float = 24) -> DataFrame:
    """``per_day`` of a stream: a day counts until the watermark, ``late_hours`` behind the latest time, has passed its end.

    In append mode a day is written once, when it is closed; in update mode each trigger writes the days it changed, with their counts so
    far. Documents that come in a later trigger than the one that closed their day are not
    counted, nor are those without a time. State is one row for each open day and key.
    """
    day = F.window(ts, "1 day")
    counts = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, f"{int(late_hours * 3600)} seconds").groupBy(day, *keys).agg(F.count(F.lit(1)).alias("count"))
    return counts.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), *keys, "count")


def latest_scan(df: DataFrame, keys: Sequence[str], seq: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """The fields of each repository's latest scan."""
    last = F.max_by(F.struct(*fields), F.struct(*seq)).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, "_last.*")
