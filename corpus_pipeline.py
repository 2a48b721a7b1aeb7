"""A corpus for training, from the raw documents to the mix.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and
read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tonetide.llm import contamination, jaccard, language, mixing, repeats
from tonetide.llm.shared import stored


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those with a null text or without any letter go.

    Null and unusual labels lose nothing: only whether a text has a letter decides.
    """
    new = {"language": "__language", "score": "__score", "letters": "__letters"}
    found = language.identify(docs, language.fit(docs), **new)
    return found.where("__letters").drop(*new.values())


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts."""
    return jaccard.one_of_each(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of earlier documents; texts of which nothing is left go."""
    return repeats.remove_repeats(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no stretch of a benchmark item."""
    return contamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in target proportions, a row per copy."""
    return mixing.mix(docs)


STAGES = [
    ("language", known_language),
    ("near_copies", one_of_near_copies),
    ("repeated_passages", without_repeated_passages),
    ("benchmark", without_benchmark),
    ("mix", mixed),
]

# Not expressible in SQL; tests/llm compares the result with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
