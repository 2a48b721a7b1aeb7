"""Typed readers."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonetide.sources import schemas


def read_json(spark: SparkSession, path: str, schema: str, mode: str = "FAILFAST") -> DataFrame:
    """JSON lines of a declared schema. A malformed line is an error.

    With ``mode="PERMISSIVE"`` it is kept instead: as a row of nulls with its text in
    ``_corrupt_record``, if the schema has that column.
    """
    return spark.read.schema(schema).option("mode", mode).json(path)


def read_comments(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """JSON lines, compressed or not; bz2 is splittable, so one large file still fans out."""
    return read_json(spark, path, schemas.COMMENTS, mode)


def read_threads(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    return read_json(spark, path, schemas.THREADS, mode)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; every column stays text, labels are cast where they are used."""
    return _csv_by_name(spark, path, schemas.LABELS)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A report file written by ``write_report``. A value that is not of its type is an error."""
    text = _csv_by_name(spark, path, schema, texts=True)
    return text.select(*[_strict(f) for f in T.StructType.fromDDL(schema).fields])


def _strict(field: T.StructField) -> Column:
    text = F.col(f"`{field.name}`")
    value = text.try_cast(field.dataType)
    wrong = F.concat(F.lit(f"{field.name} is no {field.dataType.simpleString()}: "), text)
    malformed = text.isNotNull() & value.isNull()
    return F.when(malformed, F.raise_error(wrong)).otherwise(value).alias(field.name)


def headers(spark: SparkSession, path: str) -> list[tuple[str, list[str]]]:
    """The first lines that the CSV files of ``path`` have, each with the files that have it.

    The first line of a file is that of least number among the lines read from its beginning: one
    job, combined on the map side to a line per file. File names are as many as Spark lists itself.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("number"),
        "value",
    )
    first = lines.where(F.col("start") == 0).groupBy("file").agg(F.min_by("value", "number").alias("header"))
    found: dict[str, list[str]] = {}
    for row in first.sort("file").toLocalIterator():
        found.setdefault(row["header"], []).append(unquote(row["file"]))
    return list(found.items())


def _csv_by_name(spark: SparkSession, path: str, schema: str, texts: bool = False) -> DataFrame:
    """Columns by the names in each file's header, in whatever order it has them, others left out.

    Files of one header are read together. A column that a header lacks is an error. ``texts``
    keeps values as text. Without any file that has a line there are no rows.
    """
    wanted = T.StructType.fromDDL(schema).fields
    kinds = headers(spark, path)
    parts = []
    for _, files in kinds:
        text = spark.read.option("header", True).csv(path if len(kinds) == 1 else files)
        missing = [f.name for f in wanted if f.name not in text.columns]
        if missing:
            raise ValueError(f"{files[0]} has no column {', '.join(missing)}")
        columns = [F.col(f"`{f.name}`") for f in wanted]
        if not texts:
            columns = [c.try_cast(f.dataType).alias(f.name) for c, f in zip(columns, wanted)]
        parts.append(text.select(*columns))
    if not parts:
        names = ", ".join(f"`{f.name}` {'string' if texts else f.dataType.simpleString()}" for f in wanted)
        return spark.createDataFrame([], names)
    return reduce(DataFrame.unionByName, parts)


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own estimate of a table's size: file sizes for a scan, no job is run."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
