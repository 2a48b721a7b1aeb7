"""What tables are made of, as short texts that are equal for equal inputs."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MANY_FIELDS = "spark.sql.debug.maxToStringFields"


def _digest(parts: Iterable[str]) -> str:
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


def of_files(spark: SparkSession, paths: Iterable[str]) -> str | None:
    """Digest of names, lengths and times of all files at or below ``paths``; none if there are none.

    Reads listings, no file. Names that begin with ``_`` or ``.`` do not count, as in Spark's reads.
    """
    hadoop, found = spark._jvm.org.apache.hadoop.fs, []
    for path in paths:
        file = hadoop.Path(path)
        fs = file.getFileSystem(spark._jsc.hadoopConfiguration())
        matches = fs.globStatus(file) or []
        waiting = list(matches)
        while waiting:
            status = waiting.pop()
            if status.isDirectory():
                below = fs.listStatus(status.getPath())
                waiting += [s for s in below if s.getPath().getName()[0] not in "_."]
            else:
                found.append(
                    f"{status.getPath()} {status.getLen()} {status.getModificationTime()}"
                )
    return _digest(sorted(found)) if found else None


def of_table(df: DataFrame) -> str | None:
    """Digest of a table's plan and of the files below it; none for what is not a DataFrame.

    The plan is the analyzed one with its numbering normalized, so the same steps over the same files
    agree, also in another session. If some rows come from elsewhere than files (local data, an
    RDD), the rows themselves are digested instead, in any order: one pass over them.
    """
    if not isinstance(df, DataFrame):
        return None
    plan = df._jdf.queryExecution().analyzed()
    leaves = plan.collectLeaves()
    kinds = {leaves.apply(i).getClass().getSimpleName() for i in range(leaves.size())}
    files = df.inputFiles() if kinds <= {"LogicalRelation"} else []
    if files:
        spark = df.sparkSession
        before = spark.conf.get(_MANY_FIELDS)
        spark.conf.set(_MANY_FIELDS, str(2**31 - 1))
        try:
            steps = plan.canonicalized().toString()
        finally:
            spark.conf.set(_MANY_FIELDS, before)
        steps = re.sub(r"(RepartitionByExpression .*\], |Repartition )\d+", r"\1", steps)
        return _digest([steps, ",".join(df.columns), of_files(spark, files) or ""])
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]) if df.columns else F.lit(0)
    total = df.select(row.alias("__row")).agg(
        F.count(F.lit(1)), F.bit_xor("__row"), F.sum(F.col("__row") % 1_000_003)
    )
    return _digest([df.schema.simpleString(), *map(str, total.first())])
