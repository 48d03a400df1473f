"""Evaluate an expensive expression once and use it several times."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value evaluated once per row.

    The optimizer copies an expression to each place that uses it, and a filter then parses
    the same JSON once per condition. A lambda variable is evaluated once.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
