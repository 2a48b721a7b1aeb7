"""The whole run: ingest, train, score, report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tonetide.plans.reports import write_reports
from tonetide.plans.score import score
from tonetide.plans.train import train
from tonetide.sources.fingerprints import of_files
from tonetide.sources.ingest import ingest
from tonetide.sources.stages import made_with, stage


def run(
    spark: SparkSession,
    comments: str,
    threads: str,
    labels: str,
    workdir: str,
    seed: int,
    fraction: float = 1.0,
    scoring: dict | None = None,
    min_group: int = 1,
    **training,
) -> DataFrame:
    """Raw files to seven report files under ``workdir/reports``; returns the scored table.

    Every finished stage under ``workdir`` (a shared folder) is reused by the next run with the same
    inputs and parameters; with others, also under the same names, it is an error. Finished stages
    do not need the raw files any more. ``scoring`` goes to ``plans.score.score``
    (thresholds, ``float32``, ``strip``), ``min_group`` to the top lists.
    """
    scoring = scoring or {}
    paths = (comments, threads, labels)
    inputs = made_with(comments=comments, threads=threads, labels=labels)
    files = None if any(of_files(spark, [p]) is None for p in paths) else of_files(spark, paths)

    def scored() -> DataFrame:
        texts, parents, labeled = ingest(spark, comments, threads, labels, workdir)
        models, _ = train(spark, labeled, texts, workdir, seed, inputs=inputs, **training)
        return score(models, texts, parents, fraction, **scoring)

    parameters = made_with(
        inputs=inputs, files=files, seed=seed, fraction=fraction, scoring=scoring, training=training
    )
    result = stage(spark, f"{workdir}/full_sentiment", scored, parameters)
    write_reports(result, f"{workdir}/reports", min_group)
    return result
