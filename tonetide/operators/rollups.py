"""Percent rollups, ordering, top-k."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonetide.functions.values import percent

FLAGS = {"Positive": "pos", "Negative": "neg"}


def percent_rollup(
    df: DataFrame,
    keys: Sequence[str] = (),
    flags: Mapping[str, str] = FLAGS,
    count: str | None = None,
) -> DataFrame:
    """Percent of rows with each 0/1 flag set, overall or per key; null keys form a group.

    Averages combine before the shuffle, so a key that holds most rows sends one row per task.
    ``count`` adds the group size under that name.
    """
    measures = [percent(c).alias(name) for name, c in flags.items()]
    if count is not None:
        measures.append(F.count(F.lit(1)).alias(count))
    return df.groupBy(*keys).agg(*measures)


def ordered(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.orderBy(*keys)


def top_k(
    df: DataFrame,
    measure: str,
    k: int,
    tie_break: Sequence[str],
    min_group: int = 1,
    size: str | None = None,
) -> DataFrame:
    """The ``k`` rows with the largest ``measure``; ties go by the ``tie_break`` columns.

    With ``min_group`` above 1, ``size`` names the group-size column to hold against it.
    """
    if min_group > 1:
        if size is None:
            raise ValueError("min_group needs the name of the group-size column")
        df = df.filter(F.col(size) >= min_group)
    return df.orderBy(F.desc(measure), *tie_break).limit(k)
