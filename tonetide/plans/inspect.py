"""Views and plan inspection."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def register_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def register_global_view(df: DataFrame, name: str) -> None:
    """Visible to every session of the application as ``global_temp.<name>``; fails if taken."""
    df.createGlobalTempView(name)


def plan_text(df: DataFrame, mode: str = "FORMATTED") -> str:
    """The physical plan as text; nothing is run."""
    spark = df.sparkSession
    view = f"plan_{uuid.uuid4().hex}"
    df.createTempView(view)
    try:
        return spark.sql(f"EXPLAIN {mode} SELECT * FROM {view}").first()[0]
    finally:
        spark.catalog.dropTempView(view)


def schema_table(df: DataFrame) -> DataFrame:
    """Column names and types of a table, as a table."""
    view = f"schema_{uuid.uuid4().hex}"
    df.createTempView(view)
    try:
        return df.sparkSession.sql(f"DESCRIBE {view}")
    finally:
        df.sparkSession.catalog.dropTempView(view)
