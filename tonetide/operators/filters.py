"""Projections and filters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, columns: Mapping[str, str | Column]) -> DataFrame:
    """Select and rename: ``{new_name: column}``."""
    return df.select(
        *[(F.col(c) if isinstance(c, str) else c).alias(new) for new, c in columns.items()]
    )


def derive(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Keep every column and add derived ones."""
    return df.withColumns(dict(columns))


def not_containing(df: DataFrame, c: str, text: str, strict: bool = False) -> DataFrame:
    """Drop rows whose text contains ``text`` anywhere; null text is dropped.

    ``strict=True`` only drops free-standing marks, not one inside a longer run such as a URL.
    """
    if strict:
        return df.filter(~F.col(c).rlike(rf"(?<!\S)\Q{text}\E(?!\S)"))
    return df.filter(~F.col(c).contains(text))


def not_starting_with(df: DataFrame, c: str, text: str) -> DataFrame:
    """Drop rows whose text starts with ``text``; null text is dropped."""
    return df.filter(~F.col(c).startswith(text))


def in_set(df: DataFrame, c: str, values: Iterable[str] | DataFrame) -> DataFrame:
    """Keep rows whose value is allowed; case-sensitive, null is dropped.

    A list becomes an ``IN`` that reaches the scan; a one-column table becomes a left-semi join.
    """
    if isinstance(values, DataFrame):
        allowed = values.select(F.col(values.columns[0]).alias("__allowed"))
        return df.join(allowed, F.col(c) == F.col("__allowed"), "left_semi")
    return df.filter(F.col(c).isin(*values))


def drop_values(df: DataFrame, c: str, values: Iterable[str]) -> DataFrame:
    """Drop rows with a listed value; null is dropped too, as in SQL."""
    values = list(values)
    return df.filter(~F.col(c).isin(*values)) if values else df
