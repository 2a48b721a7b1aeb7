"""Registry of queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(covers: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a function ``(spark, sf_dir) -> DataFrame`` under its own name.

    ``covers`` lists inventory ids. ``sql`` gives the same rows from the same tables.
    """

    def register(run: Run) -> Run:
        QUERIES[run.__name__] = Query(run.__name__, tuple(covers.split()), run, sql)
        return run

    return register
