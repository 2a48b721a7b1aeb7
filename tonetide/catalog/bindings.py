"""The test tables in the shapes the jobs expect, in Spark and in SQL.

Comments are ``documents``, threads are their sources, labels are ``labels``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonetide.constants import REGIONS
from tonetide.functions.values import epoch_to_day, strip_prefix
from tonetide.operators.joins import attach_threads
from tonetide.sources.readers import read_table

# Values no region filter may keep, next to those it keeps.
REGION_VALUES = [*REGIONS, "ohio", "Puerto Rico", None]
FIRST_SECOND = 1514246400  # 2017-12-26 UTC; the year from there crosses a week-year boundary


def sql_list(values) -> str:
    return ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """``doc_id`` and the given columns.

    The test file is one row group and would be one task; it is dealt over the session's cores.
    """
    df = table(spark, sf_dir, "documents").select("doc_id", *columns)
    cores = spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, "doc_id")


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "text", "lang", "source", "n_chars")
    body = (
        F.when(F.col("lang") == "de", F.concat(F.lit("&gt; "), "text"))
        .when(F.col("lang") == "es", F.concat("text", F.lit(" /s")))
        .otherwise(F.col("text"))
    )
    regions = F.array(*[F.lit(r).cast("string") for r in REGION_VALUES])
    return docs.select(
        F.col("doc_id").cast("string").alias("id"),
        body.alias("body"),
        (F.lit(FIRST_SECOND) + F.col("doc_id") % 8760 * 3600).alias("created_utc"),
        F.element_at(
            regions, (F.col("doc_id") % len(REGION_VALUES) + 1).cast("int")
        ).alias("author_flair_text"),
        F.concat(F.lit("t3_"), "source").alias("link_id"),
        F.col("n_chars").alias("score"),
    )


COMMENTS = f"""
    SELECT CAST(doc_id AS VARCHAR) AS id,
           CASE lang WHEN 'de' THEN '&gt; ' || text
                     WHEN 'es' THEN text || ' /s' ELSE text END AS body,
           CAST({FIRST_SECOND} + doc_id % 8760 * 3600 AS BIGINT) AS created_utc,
           [{sql_list(REGION_VALUES)}][doc_id % {len(REGION_VALUES)} + 1] AS author_flair_text,
           't3_' || source AS link_id,
           n_chars AS score
    FROM documents
"""


def threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "documents")
        .groupBy(F.col("source").alias("id"))
        .agg(F.count_if(F.col("lang") == "en").alias("score"))
        .select("id", F.concat(F.lit("about "), "id").alias("title"), "score")
    )


THREADS = """
    SELECT source AS id, 'about ' || source AS title, CAST(count_if(lang = 'en') AS BIGINT) AS score
    FROM documents GROUP BY source
"""


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("Input_id"),
        F.col("quality").cast("string").alias("labeldem"),
        F.col("toxic").cast("string").alias("labelgop"),
        F.when(F.col("toxic") == 1, "-1")
        .when(F.col("quality") == 1, "1")
        .otherwise("0")
        .alias("labeldjt"),
    )


LABELS = """
    SELECT CAST(doc_id AS VARCHAR) AS Input_id, CAST(quality AS VARCHAR) AS labeldem,
           CAST(toxic AS VARCHAR) AS labelgop,
           CASE WHEN toxic = 1 THEN '-1' WHEN quality = 1 THEN '1' ELSE '0' END AS labeldjt
    FROM labels
"""


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scored table's columns with the given labels as flags instead of a model's."""
    flags = table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("comment_id"),
        F.col("quality").alias("pos"),
        F.col("toxic").alias("neg"),
    )
    texts = comments(spark, sf_dir).select(
        F.col("id").alias("comment_id"),
        F.col("created_utc").alias("timestamp"),
        F.col("author_flair_text").alias("state"),
        strip_prefix("link_id", "t3_").alias("__thread"),
        F.col("score").alias("comment_score"),
    )
    return attach_threads(texts.join(flags, "comment_id"), threads(spark, sf_dir))


FLAGGED = f"""
    SELECT c.id AS comment_id, t.id AS submission_id, c.created_utc AS timestamp,
           c.author_flair_text AS state, t.title AS title, l.quality AS pos, l.toxic AS neg,
           c.score AS comment_score, t.score AS submission_score
    FROM ({COMMENTS}) c
    JOIN labels l ON CAST(l.doc_id AS VARCHAR) = c.id
    JOIN ({THREADS}) t ON t.id = substr(c.link_id, 4)
"""


def event_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        epoch_to_day(F.unix_timestamp("ts")).alias("date"),
        (F.col("event_type") == "purchase").cast("int").alias("pos"),
        (F.col("event_type") == "error").cast("int").alias("neg"),
    )


EVENT_FLAGS = """
    SELECT strftime(ts, '%Y-%m-%d') AS date,
           CAST(event_type = 'purchase' AS INTEGER) AS pos,
           CAST(event_type = 'error' AS INTEGER) AS neg
    FROM events
"""


def nation_rollup_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        "c_nationkey",
        (F.col("c_acctbal") > 5000).cast("int").alias("pos"),
        (F.col("c_acctbal") < 0).cast("int").alias("neg"),
    )
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.lower("n_name").alias("n_name"), "pos", "neg"
    )


NATION_INPUT = """
    SELECT lower(n_name) AS n_name, CAST(c_acctbal > 5000 AS INTEGER) AS pos,
           CAST(c_acctbal < 0 AS INTEGER) AS neg
    FROM customer JOIN nation ON c_nationkey = n_nationkey
"""

PERCENT = "avg(pos) * CAST(100 AS DOUBLE) AS Positive, avg(neg) * CAST(100 AS DOUBLE) AS Negative"
