"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonetide.llm.shared import stored


def components(edges: DataFrame) -> DataFrame:
    """``node root`` for every node of ``a b``; ``root`` is the least node of its component.

    Large stars hang a node's greater neighbours on its least one, small stars its smaller ones.
    Least neighbours are found by a pre-aggregated minimum and joined back, where Spark splits the
    partitions of hubs; each round is written, so nothing is recomputed from the start.
    """
    tree = stored(_ordered(edges))
    while True:
        both = tree.unionByName(tree.select(F.col("b").alias("a"), F.col("a").alias("b")))
        larger = _stars(both, F.col("b") > F.col("a"), with_self=False)
        after = stored(_stars(larger, F.lit(True), with_self=True))
        if _print(after) == _print(tree):
            return after.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                after.select(F.col("b").alias("node"), F.col("b").alias("root"))
            ).distinct()
        tree = after


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, the greater node in ``a``."""
    return (
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _stars(edges: DataFrame, moved, with_self: bool) -> DataFrame:
    """Hang the neighbours ``b`` of each ``a`` (those that ``moved`` names) on the least node."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select(F.col("a").alias("__a"), F.least("a", "least").alias("least"))
    hung = edges.join(least, F.col("a") == F.col("__a")).where(moved)
    hung = hung.select(F.col("b").alias("a"), F.col("least").alias("b"))
    if with_self:
        hung = hung.unionByName(least.select(F.col("__a").alias("a"), F.col("least").alias("b")))
    return _ordered(hung)


def _print(tree: DataFrame) -> tuple:
    row = tree.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)
