"""Day series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def series_range(df: DataFrame, day: str) -> DataFrame:
    """One row with the first and the last day."""
    return df.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def densify_daily(df: DataFrame, day: str) -> DataFrame:
    """One row per calendar day from the first to the last; days without data hold nulls.

    ``df`` is a stored rollup, one row per day: it is read for its range and once more for its
    values. The calendar is as long as the series, no more.
    """
    calendar = series_range(df, day).select(
        F.explode(F.sequence("first_day", "last_day")).alias(day)
    )
    return calendar.join(df, day, "left")
