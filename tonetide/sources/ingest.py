"""Ingest jobs: raw files to parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonetide.operators.ngrams import with_sanitized
from tonetide.sources import readers, schemas
from tonetide.sources.fingerprints import of_files
from tonetide.sources.stages import made_with, stage

_LINE = "_corrupt_record"
_BAD = "malformed"


def _made_from(spark: SparkSession, path: str, **more) -> str:
    return made_with(input=path, files=of_files(spark, [path]), **more)


def _parsed(spark: SparkSession, path: str, schema: str, out: str, malformed: str) -> DataFrame:
    """JSON lines as a stage. Malformed lines lie beside the others, as a part of their own.

    Raw files are parsed once: well-formed rows and malformed lines are written by the same job.
    ``malformed="fail"`` makes a malformed line an error instead.
    """
    if malformed == "fail":
        return stage(
            spark, out, lambda: readers.read_json(spark, path, schema), _made_from(spark, path)
        )
    if malformed != "quarantine":
        raise ValueError(f"malformed must be 'quarantine' or 'fail', not {malformed!r}")

    def build() -> DataFrame:
        lines = readers.read_json(spark, path, f"{schema}, {_LINE} string", "PERMISSIVE")
        return lines.withColumn(_BAD, F.col(_LINE).isNotNull())

    made = _made_from(spark, path, malformed=malformed)
    whole = f"{schema}, {_LINE} string, {_BAD} boolean"
    rows = stage(spark, out, build, made, partition_by=[_BAD], schema=whole)
    return rows.where(~F.col(_BAD)).drop(_LINE, _BAD)


def quarantined(spark: SparkSession, out: str) -> DataFrame:
    """``line`` of each malformed line of the stage at ``out``; only those lines are read."""
    schema = f"{_LINE} string, {_BAD} boolean"
    lines = spark.read.schema(schema).parquet(out).where(F.col(_BAD))
    return lines.select(F.col(_LINE).alias("line"))


def ingest(
    spark: SparkSession,
    comments: str,
    threads: str,
    labels: str,
    out: str,
    malformed: str = "quarantine",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three raw inputs to ``comments``, ``threads`` and ``labels`` tables under ``out``.

    A JSON line that is malformed, or has a field of another type, goes to the quarantine of its
    table, see ``quarantine_report``; ``malformed="fail"`` makes it an error.
    """
    made = _made_from(spark, labels)
    return (
        _parsed(spark, comments, schemas.COMMENTS, f"{out}/comments", malformed),
        _parsed(spark, threads, schemas.THREADS, f"{out}/threads", malformed),
        stage(spark, f"{out}/labels", lambda: readers.read_labels(spark, labels), made),
    )


def quarantine_report(spark: SparkSession, out: str) -> DataFrame:
    """``name`` and ``lines``: how many lines each table of ``ingest`` has in quarantine."""
    counts = [
        quarantined(spark, f"{out}/{name}")
        .agg(F.count(F.lit(1)).alias("lines"))
        .select(F.lit(name).alias("name"), "lines")
        for name in ("comments", "threads")
    ]
    return counts[0].unionByName(counts[1])


def clean_file(spark: SparkSession, path: str, out: str, malformed: str = "fail") -> DataFrame:
    """Clean the ``body`` of every line of a JSON-lines file into a four-column table.

    With ``malformed="quarantine"`` malformed lines are set apart under ``<out>.lines``.
    """

    def build() -> DataFrame:
        if malformed == "fail":
            bodies = readers.read_json(spark, path, "body string")
        else:
            bodies = _parsed(spark, path, "body string", f"{out}.lines", malformed)
        cleaned = with_sanitized(bodies, "body", "sanitized")
        return cleaned.select(F.col("sanitized.*"))

    return stage(spark, out, build, _made_from(spark, path))
