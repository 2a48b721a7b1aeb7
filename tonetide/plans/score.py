"""Scoring job: every comment with its thread, flagged positive / negative."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tonetide.constants import NEGATIVE_THRESHOLD, POSITIVE_THRESHOLD
from tonetide.operators.joins import (
    attach_threads,
    comments_with_key,
    fits_broadcast,
    thread_key,
)
from tonetide.operators.models import Models
from tonetide.operators.models import score as add_scores
from tonetide.operators.ngrams import with_ngram_bag
from tonetide.operators.sampling import hash_sample, key_position


def score(
    models: Models,
    comments: DataFrame,
    threads: DataFrame,
    fraction: float = 1.0,
    positive_threshold: float = POSITIVE_THRESHOLD,
    negative_threshold: float = NEGATIVE_THRESHOLD,
    float32: bool = False,
    link_col: str = "link_id",
    strip: str = "prefix",
    broadcast_limit: int | None = None,
    **skew,
) -> DataFrame:
    """Filter, clean, vectorize and run both models in one pass, and attach the threads.

    If the threads can be broadcast, comments without a thread drop out before the text work.
    If not, the join shuffles, and then it comes last: a scored comment is a few dozen bytes,
    its text and n-grams are many times that.

    ``fraction`` below 1 samples comments and threads by key, each on its own. A comment whose
    thread is not in the sample is recognized by the key alone, before any join.
    """
    keys = comments
    if fraction < 1.0:
        comments = hash_sample(comments, "id", fraction)
        threads = hash_sample(threads, "id", fraction)
    keyed = comments_with_key(comments, link_col, strip)
    if fraction < 1.0:
        keyed = keyed.filter(key_position("__thread") < fraction)

    def scored(df: DataFrame) -> DataFrame:
        grams = with_ngram_bag(df, "body", models.vocabulary.getInputCol()).drop("body")
        return add_scores(models, grams, positive_threshold, negative_threshold, float32).drop(
            "pos_probability", "neg_probability"
        )

    def attached(df: DataFrame) -> DataFrame:
        counted = keys.select(thread_key(link_col, strip).alias("__thread"))
        return attach_threads(
            df, threads, keys_of=counted, broadcast_limit=broadcast_limit, **skew
        )

    if fits_broadcast(threads, broadcast_limit):
        result = scored(attached(keyed))
    else:
        result = attached(scored(keyed))
    return result.select(
        "comment_id",
        "submission_id",
        "timestamp",
        "state",
        "title",
        "pos",
        "neg",
        "comment_score",
        "submission_score",
    )
