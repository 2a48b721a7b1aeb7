"""Tables behind the charts, made from the report files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tonetide.constants import UNMAPPED_REGIONS
from tonetide.functions.values import difference, intensity, parse_day
from tonetide.operators.filters import drop_values
from tonetide.operators.joins import attach_to_dimension
from tonetide.operators.series import densify_daily
from tonetide.plans.reports import REPORTS
from tonetide.sources.readers import read_report


def load_report(spark: SparkSession, out: str, name: str) -> DataFrame:
    """Read a keyed or overall report back, typed."""
    return read_report(spark, f"{out}/{name}.csv", REPORTS[name][1])


def daily_series(by_day: DataFrame, bad_days: Iterable[str] = ()) -> DataFrame:
    """Every calendar day of the series; gaps hold nulls.

    ``bad_days`` removes known bad keys first. A series made with a week-year day pattern has
    ``constants.BAD_DAY``; the reports here have no bad day, so none is removed by default.
    """
    days = drop_values(by_day, "date", bad_days).withColumn("date", parse_day("date"))
    return densify_daily(days, "date").orderBy("date")


def region_map(
    by_region: DataFrame,
    dim: DataFrame,
    key: str = "state",
    vmin: float = 0.0,
    vmax: float = 100.0,
    lower: bool = True,
    strict: bool = False,
    unmapped: Iterable[str] = UNMAPPED_REGIONS,
) -> DataFrame:
    """Every mapped row of a region table with its measures, their difference and shades."""
    mapped = drop_values(dim, key, unmapped)
    attached = attach_to_dimension(by_region, mapped, key, lower, strict)
    return attached.withColumns(
        {
            "Difference": difference("Positive", "Negative"),
            "PositiveShade": intensity("Positive", vmin, vmax),
            "NegativeShade": intensity("Negative", vmin, vmax),
        }
    )
