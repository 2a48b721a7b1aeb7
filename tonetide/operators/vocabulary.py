"""Term statistics and the vocabulary built from them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonetide.constants import MIN_DOCUMENT_FREQUENCY, VOCABULARY_SIZE
from tonetide.sources.stages import shared_dir, stage

# Tokens that a task counts at a time, and terms that it hands on at a time.
PIECE_TOKENS = 4_000_000
_ROWS_OUT = 1 << 17


def _pieces(size: int):
    """A function that counts the terms of token lists, ``size`` tokens at a time or somewhat more.

    Made here, so that it travels with its code and needs no package on the executors.
    """

    def counts(lists: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        column = pa.concat_arrays(lists)
        # A missing term counts as a term, as in ``groupBy``.
        found = pc.list_flatten(column).dictionary_encode(null_encoding="encode")
        terms, codes = found.dictionary, found.indices.to_numpy().astype(np.int64)
        pairs = pc.list_parent_indices(column).to_numpy().astype(np.int64) * len(terms) + codes
        pairs.sort()
        first = np.ones(len(pairs), bool)
        first[1:] = pairs[1:] != pairs[:-1]
        rows = np.bincount(pairs[first] % max(len(terms), 1), minlength=len(terms))
        times = np.bincount(codes, minlength=len(terms))
        for at in range(0, len(terms), _ROWS_OUT):
            part = slice(at, at + _ROWS_OUT)
            yield pa.RecordBatch.from_arrays(
                [terms[part], pa.array(rows[part]), pa.array(times[part])], ["term", "df", "tf"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tokens = [], 0
        for batch in batches:
            held.append(batch.column(0))
            tokens += len(pc.list_flatten(held[-1]))
            if tokens >= size:
                yield from counts(held)
                held, tokens = [], 0
        if held:
            yield from counts(held)

    return run


def document_frequency(df: DataFrame, tokens: str, min_df: int = 1) -> DataFrame:
    """Per term: ``df``, the rows it occurs in, and ``tf``, its occurrences.

    Tasks count pieces of their rows in Arrow: each distinct term of a piece leaves it as one row
    with both counts. Spark adds these up in a single shuffle, combined on the map side first,
    however frequent a term is.
    """
    lists = df.select(F.col(tokens).alias("terms"))
    term = lists.schema["terms"].dataType.elementType
    schema = T.StructType().add("term", term).add("df", "long").add("tf", "long")
    return (
        lists.mapInArrow(_pieces(PIECE_TOKENS), schema)
        .groupBy("term")
        .agg(F.sum("df").alias("df"), F.sum("tf").alias("tf"))
        .filter(F.col("df") >= min_df)
    )


def vocabulary_model(terms: Sequence[str], tokens: str, out: str) -> CountVectorizerModel:
    """A model of given terms, handed to the JVM as one text instead of term by term."""
    end = "\0"
    if any(end in t for t in terms):
        return CountVectorizerModel.from_vocabulary(list(terms), inputCol=tokens, outputCol=out)
    jvm = SparkSession.active()._jvm
    array = jvm.java.util.regex.Pattern.compile(end).split(end.join(terms), -1)
    model = CountVectorizerModel._create_from_java_class(
        "org.apache.spark.ml.feature.CountVectorizerModel", array
    )
    model._set(vocabSize=len(terms))
    return model.setInputCol(tokens).setOutputCol(out)


def fit_vocabulary(
    df: DataFrame,
    tokens: str,
    out: str = "features",
    min_df: int = MIN_DOCUMENT_FREQUENCY,
    size: int = VOCABULARY_SIZE,
    binary: bool = True,
) -> CountVectorizerModel:
    """The ``size`` most frequent terms found in at least ``min_df`` rows.

    Ties go by the term itself, so the feature numbering repeats on any cluster. The counts are
    written once. How many terms have each frequency gives the lowest one that still fits; terms
    above it, fewer than ``size``, are collected, and those at it are read in order until ``size``
    is reached, one sorted partition at a time. No partition sends its own list of ``size`` terms.
    """
    spark = df.sparkSession
    counts = stage(spark, f"{shared_dir(spark)}/terms", lambda: document_frequency(df, tokens, min_df))
    left, cut = size, None
    frequencies = counts.groupBy("tf").count().sort(F.desc("tf"))
    for row in frequencies.toLocalIterator() if counts.count() > size else ():
        if row["count"] > left:
            cut = row["tf"]
            break
        left -= row["count"]
    above = counts if cut is None else counts.where(F.col("tf") > cut)
    found = sorted((-row.tf, row.term.encode(), row.term) for row in above.collect())
    terms = [term for _, _, term in found]
    if cut is not None and left:
        ties = counts.where(F.col("tf") == cut).select("term").sort("term").toLocalIterator()
        terms += [row.term for row in islice(ties, left)]
    if not terms:
        raise ValueError(f"no term occurs in {min_df} rows or more; lower min_df")
    return vocabulary_model(terms, tokens, out).setBinary(binary)


def vectorize(model: CountVectorizerModel, df: DataFrame) -> DataFrame:
    """Add the sparse vector; terms outside the vocabulary are ignored."""
    return model.transform(df)
