"""The seven reports over the scored table.

Each function reads two to four columns of it. Give them a written stage, so that the columnar file
serves each report its own columns. ``write_reports`` makes all of them from one scan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonetide.constants import REGIONS, TOP_THREADS
from tonetide.functions.values import epoch_to_day, percent
from tonetide.operators.filters import in_set
from tonetide.operators.rollups import FLAGS, ordered, percent_rollup, top_k
from tonetide.sources import schemas
from tonetide.sources.stages import shared_dir, stage
from tonetide.sources.writers import write_report


def overall(scored: DataFrame) -> DataFrame:
    return percent_rollup(scored)


def by_day(scored: DataFrame) -> DataFrame:
    days = scored.withColumn("date", epoch_to_day("timestamp"))
    return ordered(percent_rollup(days, ["date"]), ["date"])


def by_region(scored: DataFrame, regions: Iterable[str] = REGIONS) -> DataFrame:
    return percent_rollup(in_set(scored, "state", regions), ["state"])


def by_thread_score(scored: DataFrame) -> DataFrame:
    return percent_rollup(scored, ["submission_score"])


def by_comment_score(scored: DataFrame) -> DataFrame:
    return percent_rollup(scored, ["comment_score"])


def by_thread(scored: DataFrame) -> DataFrame:
    """Per thread, with its number of comments as ``__comments``; what the top lists rank."""
    return percent_rollup(scored, ["submission_id", "submission_score"], count="__comments")


def best_threads(
    threads: DataFrame, measure: str, k: int = TOP_THREADS, min_group: int = 1
) -> DataFrame:
    """The ``k`` threads with the largest ``measure``; ties go by thread score, then id."""
    best = top_k(
        threads, measure, k, ["submission_score", "submission_id"], min_group, "__comments"
    )
    return best.drop("__comments")


def top_threads(
    scored: DataFrame, measure: str, k: int = TOP_THREADS, min_group: int = 1
) -> DataFrame:
    return best_threads(by_thread(scored), measure, k, min_group)


# --- fixed values: report name, columns, order of its rows --------------------
REPORTS = {
    "raw_percentages": (overall, schemas.OVERALL, []),
    "time_data": (by_day, schemas.BY_DAY, ["date"]),
    "state_data": (by_region, schemas.BY_REGION, ["state"]),
    "submission_score": (by_thread_score, schemas.BY_THREAD_SCORE, ["submission_score"]),
    "comment_score": (by_comment_score, schemas.BY_COMMENT_SCORE, ["comment_score"]),
}


# --- fixed values: report name, columns it is grouped by -----------------------
GROUPINGS = {
    "raw_percentages": [],
    "time_data": ["date"],
    "state_data": ["state"],
    "submission_score": ["submission_score"],
    "comment_score": ["comment_score"],
    "threads": ["submission_id", "submission_score"],
}
_KEYS = {
    "date": "string",
    "state": "string",
    "submission_id": "string",
    "submission_score": "bigint",
    "comment_score": "bigint",
}
_ROLLUPS = ", ".join(f"{k} {t}" for k, t in _KEYS.items()) + (
    ", Positive double, Negative double, __comments bigint, report string"
)


def all_rollups(scored: DataFrame) -> DataFrame:
    """Every grouping of the reports from one scan of the scored table.

    A row per group, its grouping named by ``report``; columns that it is not grouped by are null.
    Each row is counted in all groupings by the task that reads it, before anything is shuffled.
    """

    def number(keys: list[str]) -> int:
        return sum(1 << i for i, k in enumerate(reversed(_KEYS)) if k not in keys)

    rows = scored.select(
        epoch_to_day("timestamp").alias("date"),
        *[F.col(k).cast(kind).alias(k) for k, kind in _KEYS.items() if k != "date"],
        "pos",
        "neg",
    )
    sets = [[F.col(k) for k in keys] for keys in GROUPINGS.values()]
    grouped = rows.groupingSets(sets, *_KEYS).agg(
        *[percent(c).alias(name) for name, c in FLAGS.items()],
        F.count(F.lit(1)).alias("__comments"),
        F.grouping_id().alias("__number"),
    )
    names = F.create_map(*[F.lit(x) for n, keys in GROUPINGS.items() for x in (number(keys), n)])
    return grouped.withColumn("report", names[F.col("__number").cast("int")]).drop("__number")


def from_rollups(rollups: DataFrame, name: str, regions: Iterable[str] = REGIONS) -> DataFrame:
    """One report (or ``threads``, what the top lists rank) out of ``all_rollups``."""
    rows = rollups.where(F.col("report") == name)
    if name == "raw_percentages":  # has a row, of nulls, also where there is nothing to rate
        return rows.agg(*[F.max(c).alias(c) for c in FLAGS])
    if name == "state_data":
        rows = in_set(rows, "state", regions)
    count = ["__comments"] if name == "threads" else []
    return rows.select(*GROUPINGS[name], *FLAGS, *count)


def write_reports(scored: DataFrame, out: str, min_group: int = 1) -> None:
    """Write all seven reports as ``<out>/<name>.csv``. The scored table is read once.

    The groups are written first, those of each report in a folder of its own, so that the small
    reports do not read the many groups by thread.
    """
    spark = scored.sparkSession
    rollups = stage(
        spark,
        f"{shared_dir(spark)}/rollups",
        lambda: all_rollups(scored),
        partition_by=["report"],
        schema=_ROLLUPS,
    )
    for name, (_, _, order) in REPORTS.items():
        write_report(from_rollups(rollups, name), f"{out}/{name}.csv", order)
    threads = from_rollups(rollups, "threads")
    for name, measure in (("top_pos_submissions", "Positive"), ("top_neg_submissions", "Negative")):
        best = best_threads(threads, measure, min_group=min_group)
        rank = [best[measure].desc(), best["submission_score"], best["submission_id"]]
        write_report(best, f"{out}/{name}.csv", rank)
