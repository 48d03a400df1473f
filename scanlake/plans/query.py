"""A registered query: a Spark plan over a folder of tables, and the same result in SQL."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


class Registry(dict):
    """Queries by name; ``add`` is a decorator."""

    def add(self, name: str, sql: str | None = None):
        def register(run):
            self[name] = Query(run, sql)
            return run

        return register
