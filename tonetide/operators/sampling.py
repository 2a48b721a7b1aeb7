"""Sampling and splitting. Every random form needs a seed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Bernoulli sample without replacement; repeats only on the same file layout."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def key_position(key: str, salt: str = "") -> Column:
    """A key's fixed pseudo-random position in [0, 1), the same on any engine and layout.

    A null key has the position of an empty one, so that no sample or split loses it.
    """
    digest = F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(salt)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(2.0**32)


def hash_sample(df: DataFrame, key: str, fraction: float, salt: str = "") -> DataFrame:
    """Sample by key. An ordinary filter: other filters move past it down to the scan."""
    return df.filter(key_position(key, salt) < fraction)


def split(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Random split into disjoint parts that together are the whole."""
    return df.randomSplit(list(weights), seed)


def hash_split(
    df: DataFrame, key: str, weights: Sequence[float], salt: str = ""
) -> list[DataFrame]:
    """The same by key: a row's part depends on its key alone."""
    total = float(sum(weights))
    edges = [0.0]
    for w in weights:
        edges.append(edges[-1] + w / total)
    edges[-1] = 1.0
    position = key_position(key, salt)
    return [
        df.filter((position >= low) & (position < high))
        for low, high in zip(edges, edges[1:])
    ]
