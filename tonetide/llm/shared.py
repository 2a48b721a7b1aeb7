"""Tables that a later job reads again, and bounded samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonetide.sources.stages import shared_dir


def stored(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` to a new folder under ``spark.checkpoint.dir`` and read it back.

    What is read back has no lineage, so a lost executor costs one re-read, and its size is known,
    so Spark broadcasts it only below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    path = f"{shared_dir(df.sparkSession)}/table"
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """True if crc32 of the id as text is divisible by 5; false for a null id."""
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(crc % 5 == 0, F.lit(False))


def bounded_sample(df: DataFrame, key: str, stratum: Column, per_stratum: int) -> DataFrame:
    """At most about ``per_stratum`` rows of each stratum, chosen by a hash of ``key``.

    Each stratum has ``per_stratum`` buckets, and each bucket keeps its row of least hash. Only
    keys and strata are aggregated, combined on the map side; rows are fetched by a broadcast of at
    most strata x ``per_stratum`` keys, so the caller's strata must be bounded. Null keys are never
    chosen; a repeated key brings all its rows.
    """
    bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(per_stratum))
    chosen = (
        df.where(F.col(key).isNotNull())
        .select(F.col(key).alias("__key"), stratum.alias("__stratum"), bucket.alias("__bucket"))
        .groupBy("__stratum", "__bucket")
        .agg(F.min(F.struct(F.xxhash64(F.lit("sample"), F.col("__key")), "__key")).alias("__first"))
        .select(F.col("__first.__key").alias("__key"))
        .distinct()
    )
    return df.join(F.broadcast(chosen), F.col(key) == F.col("__key"), "left_semi")
