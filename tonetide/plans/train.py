"""Training job: labels + comments to a vocabulary and two classifiers."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from tonetide.constants import (
    FOLDS,
    MIN_DOCUMENT_FREQUENCY,
    REG_PARAMS,
    TRAIN_WEIGHTS,
    VOCABULARY_SIZE,
)
from tonetide.functions.values import binary_label
from tonetide.operators.joins import join_labels
from tonetide.operators.models import (
    FEATURES,
    Models,
    evaluate,
    held,
    stage_classifier,
    stage_vocabulary,
    train_one,
)
from tonetide.operators.ngrams import with_ngram_bag
from tonetide.operators.sampling import hash_split
from tonetide.operators.vocabulary import fit_vocabulary, vectorize
from tonetide.sources.fingerprints import of_table
from tonetide.sources.stages import made_with, stage

GRAMS = "grams"


def labeled_ngrams(labels: DataFrame, comments: DataFrame) -> DataFrame:
    """Each label row with the n-grams of its comment."""
    joined = join_labels(labels, comments, "Input_id", "id")
    return with_ngram_bag(joined, "body", GRAMS).drop("body")


def with_labels(df: DataFrame, label: str = "labeldjt") -> DataFrame:
    """Add ``pos_label`` (label is 1) and ``neg_label`` (label is -1)."""
    return df.withColumns(
        {"pos_label": binary_label(label, 1), "neg_label": binary_label(label, -1)}
    )


def train(
    spark: SparkSession,
    labels: DataFrame,
    comments: DataFrame,
    workdir: str,
    seed: int,
    min_df: int = MIN_DOCUMENT_FREQUENCY,
    vocabulary_size: int = VOCABULARY_SIZE,
    reg_params: Sequence[float] = REG_PARAMS,
    folds: int = FOLDS,
    weights: Sequence[float] = TRAIN_WEIGHTS,
    parallelism: int | None = None,
    inputs: str | None = None,
) -> tuple[Models, DataFrame]:
    """Train, or reuse what an earlier run finished under ``workdir``.

    A stage made with other parameters, or from other inputs, is not reused but an error. ``inputs``
    names labels and comments; by default it is a fingerprint of their plans and files (see
    ``sources.fingerprints``). A finished run can be loaded with None for both tables.

    Returns the models and the held-out part with ``features`` and both labels. The labeled
    n-grams and vectors are written tables: every pass of the optimizer re-reads them instead
    of repeating the join and the text cleaning, also after losing an executor.
    """
    if inputs is None:
        known = [of_table(labels), of_table(comments)]
        inputs = None if None in known else " ".join(known)
    base = {"inputs": inputs}
    terms = base | {"min_df": min_df, "vocabulary_size": vocabulary_size}
    fit = terms | {
        "reg_params": list(reg_params), "folds": folds, "weights": list(weights), "seed": seed
    }
    grams = stage(
        spark, f"{workdir}/ngrams", lambda: labeled_ngrams(labels, comments), made_with(**base)
    )
    vocabulary = stage_vocabulary(
        spark,
        f"{workdir}/vocabulary",
        lambda: fit_vocabulary(grams, GRAMS, FEATURES, min_df, vocabulary_size),
        made_with(**terms),
    )
    data = stage(
        spark,
        f"{workdir}/sentiment",
        lambda: with_labels(vectorize(vocabulary, grams).drop(GRAMS)),
        made_with(**terms),
    )
    training, held_out = hash_split(data, "Input_id", weights, salt=f":split:{seed}")

    # The two classifiers are independent; their jobs share the cluster and the decoded rows.
    names = ("pos_label", "neg_label")
    with held(training, "Input_id", FEATURES, *names) as rows, ThreadPoolExecutor(2) as pool:

        def classifier(label: str):
            return stage_classifier(
                spark,
                f"{workdir}/{label}",
                lambda: train_one(rows, "Input_id", label, reg_params, folds, seed, parallelism),
                made_with(**fit),
            )

        positive, negative = pool.map(classifier, names)
    return Models(vocabulary, positive, negative), held_out


def held_out_auc(models: Models, held_out: DataFrame) -> tuple[float, float]:
    """Area under ROC of both classifiers on the part no training has seen."""
    return evaluate(models, held_out, "pos_label", "neg_label")
