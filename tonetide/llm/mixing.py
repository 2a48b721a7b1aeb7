"""Mixing sources to target weights.

Words are summed per source, targets follow from the sources' weights, and each document is emitted
floor(rate) times plus once more with probability rate - floor(rate), where rate is its source's
target over its source's size. The draw is a hash of seed, id, text and the number of the row among
rows equal in these: it depends neither on the file layout nor on the run.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonetide.llm.shared import stored

WORD = r"[^\x20\x09-\x0D]+"
MOST_EQUAL = 1 << 16


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_sizes(sized: DataFrame) -> DataFrame:
    """``source``, ``source_size`` and ``place``, the source's rank by code point, null last.

    The rank is found in ranges of sources, of which the driver sees the counts only.
    """
    order = [F.col("source").isNull(), F.col("source")]
    ranged = stored(
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .repartitionByRange(*order)
        .withColumn("__range", F.spark_partition_id())
    )
    counts = {r["__range"]: r["count"] for r in ranged.groupBy("__range").count().collect()}
    before, skipped = 0, {}
    for part in sorted(counts):
        skipped[part] = before
        before += counts[part]
    within = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    if not skipped:
        return ranged.select("source", "source_size", F.lit(0).cast("long").alias("place"))
    start = F.create_map(*[F.lit(x).cast("long") for kv in skipped.items() for x in kv])
    place = F.element_at(start, F.col("__range").cast("long")) + within - 1
    return ranged.select("source", "source_size", place.cast("long").alias("place"))


def targets(
    sources: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: int = 2
) -> DataFrame:
    """Add ``target``: ``share`` times all words, split by weight.

    ``weights`` repeat in order of ``place``. No target is above ``most`` times its source's size;
    the excess is shared by weight among the others until none is above. Each round of sharing is
    one sum over the sources.
    """
    weight = F.element_at(
        F.array(*[F.lit(int(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")
    )
    table = stored(
        sources.withColumn("__weight", weight).withColumn("__most", F.col("source_size") * most)
    )
    total = share * (table.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, -1
    while True:
        capped = F.col("__most") <= F.col("__weight") * F.lit(level)
        row = table.agg(
            F.count_if(capped).alias("full"),
            F.coalesce(F.sum(F.when(capped, F.col("__most"))), F.lit(0)).alias("words"),
            F.coalesce(F.sum(F.when(~capped, F.col("__weight"))), F.lit(0)).alias("weight"),
        ).first()
        if row["full"] == full or not row["weight"]:
            break
        full, level = row["full"], (total - row["words"]) / row["weight"]
    capped = F.col("__most") <= F.col("__weight") * F.lit(level)
    target = F.when(capped, F.col("__most").cast("double")).otherwise(
        F.col("__weight") * F.lit(level)
    )
    return table.select("source", "source_size", target.alias("target"))


def _sized(docs: DataFrame) -> DataFrame:
    return stored(
        docs.select("doc_id", "source", word_count("text").alias("size"), _text().alias("__text"))
    )


def _text() -> Column:
    return F.md5(F.coalesce(F.col("text"), F.lit("")))


def _numbered(rows: DataFrame, sized: DataFrame) -> DataFrame:
    """Add ``__number``, from 1 among rows equal in id, source and text.

    Only rows that have equals are sorted. More than ``MOST_EQUAL`` equals, which would fill a task,
    are numbered by their place in the table instead: such rows take turns by file layout.
    """
    key = ["doc_id", "source", "__text"]
    equal = sized.groupBy(*key).agg(F.count(F.lit(1)).alias("__equal")).where(F.col("__equal") > 1)
    equal = stored(equal.toDF("__id", "__from", "__hash", "__equal"))
    one = F.lit(1).cast("long")
    if equal.isEmpty():
        return rows.withColumn("__number", one)
    same = (
        (F.col("__text") == F.col("__hash"))
        & F.col("doc_id").eqNullSafe(F.col("__id"))
        & F.col("source").eqNullSafe(F.col("__from"))
    )
    placed = rows.withColumn("__place", F.monotonically_increasing_id() + 1)
    marked = placed.join(equal, same, "left")
    within = F.row_number().over(Window.partitionBy(*key).orderBy("__place")).cast("long")
    few = F.col("__equal") <= MOST_EQUAL
    every = (
        marked.where(F.col("__equal").isNull()).withColumn("__number", one),
        marked.where(few).withColumn("__number", within),
        marked.where(~few).withColumn("__number", F.col("__place")),
    )
    return reduce(DataFrame.unionByName, every).drop("__place", *equal.columns)


def _uniform(seed: str) -> Column:
    """A number in [0, 1) from the first 52 bits of an md5."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    text = F.concat_ws(":", F.lit(seed), doc_id, "__text", "__number")
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def copies(rate: Column, draw: Column) -> Column:
    whole = F.floor(rate)
    return F.coalesce(whole + F.when(draw < rate - whole, 1).otherwise(0), F.lit(0)).cast("int")


def plan(docs: DataFrame, seed: str = "mix", **options) -> DataFrame:
    """Per document: ``doc_id size source_size target copies taken``.

    A null text has no words; a null source is a source of its own. A source without words has
    target 0. Repeated rows, rows that share an id and null ids draw each for themselves. An empty
    table gives an empty result.
    """
    sized = _sized(docs)
    rates = stored(targets(source_sizes(sized), **options)).withColumnRenamed("source", "__source")
    rate = F.col("target") / F.when(F.col("source_size") > 0, F.col("source_size"))
    return (
        _numbered(sized, sized)
        .join(rates, F.col("source").eqNullSafe(F.col("__source")))
        .withColumn("copies", copies(rate, _uniform(seed)))
        .select(
            "doc_id",
            "size",
            "source_size",
            "target",
            "copies",
            (F.col("size") * F.col("copies")).alias("taken"),
        )
    )


def mix(docs: DataFrame, seed: str = "mix", **options) -> DataFrame:
    """The mixed documents: every column of ``docs``, a row per copy, numbered from 1 in ``copy``.

    Texts are not shuffled as long as the table of sources is small enough for Spark to broadcast;
    of rows equal in id, source and text, at most ``MOST_EQUAL`` go to one task.
    """
    sized = _sized(docs)
    rates = targets(source_sizes(sized), **options)
    rate = F.col("target") / F.when(F.col("source_size") > 0, F.col("source_size"))
    rates = stored(rates.select(F.col("source").alias("__source"), rate.alias("__rate")))
    number = copies(F.col("__rate"), _uniform(seed))
    return (
        _numbered(docs.withColumn("__text", _text()), sized)
        .join(rates, F.col("source").eqNullSafe(F.col("__source")))
        .withColumn("__copies", number)
        .where(F.col("__copies") > 0)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
        .select(*[F.col(f"`{c}`") for c in docs.columns if c != "copy"], "copy")
    )
