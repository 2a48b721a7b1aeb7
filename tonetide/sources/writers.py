"""Writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPORT_ROWS = 10_000_000


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def write_report(
    df: DataFrame, path: str, order_by: Sequence[str] = (), most: int = REPORT_ROWS
) -> None:
    """One CSV file with a header, replacing an earlier one, in the order asked for.

    For report tables, which are small by nature: their rows are days, regions, scores or a
    top k. The aggregation stays parallel; only its result moves to the writing task, where it
    is sorted last, since a shuffle keeps no order. A result of more than ``most`` rows is an error:
    the task stops at the first row beyond, and what belongs into one task stays bounded.
    """
    one = df.repartition(1)
    # The rows of a single partition are numbered from 0.
    within = F.monotonically_increasing_id() < most
    one = one.where(F.assert_true(within, f"a report of more than {most} rows").isNull())
    if order_by:
        one = one.sortWithinPartitions(*order_by)
    one.write.mode("overwrite").option("header", True).csv(path)
