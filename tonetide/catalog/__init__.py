"""Runnable queries over the test tables, each with the SQL it must agree with."""

from tonetide.catalog import (  # noqa: F401  (importing registers the queries)
    files,
    filters,
    joins,
    models,
    reports,
    samples,
    series,
    terms,
    texts,
)
from tonetide.catalog.registry import QUERIES

__all__ = ["QUERIES"]
