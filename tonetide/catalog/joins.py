"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tonetide.catalog import bindings as B
from tonetide.catalog.registry import query
from tonetide.functions.values import ltrim_chars, strip_prefix
from tonetide.operators.joins import join_labels, join_threads, merge_scores, skewed_join


@query(
    "J1 P1",
    f"""SELECT l.*, md5(c.body) AS body_md5
        FROM ({B.LABELS}) l JOIN ({B.COMMENTS}) c ON l.Input_id = c.id""",
)
def labeled_comments(spark, sf_dir):
    joined = join_labels(
        B.labels(spark, sf_dir), B.comments(spark, sf_dir), "Input_id", "id"
    )
    return joined.withColumn("body_md5", F.md5("body")).drop("body")


_THREADED = f"""
    SELECT c.id AS comment_id, t.id AS submission_id, md5(c.body) AS body_md5,
           c.created_utc AS timestamp, c.author_flair_text AS state, t.title AS title,
           c.score AS comment_score, t.score AS submission_score
    FROM ({B.COMMENTS}) c JOIN ({B.THREADS}) t ON substr(c.link_id, 4) = t.id
    WHERE NOT contains(c.body, '/s') AND NOT starts_with(c.body, '&gt')
"""


def _digest(joined):
    return joined.withColumn("body", F.md5("body")).withColumnRenamed("body", "body_md5")


@query("J2 P4 P5 F1b", _THREADED)
def comments_with_threads(spark, sf_dir):
    return _digest(join_threads(B.comments(spark, sf_dir), B.threads(spark, sf_dir)))


@query("J2 P4 P5 F1b", _THREADED)
def comments_with_threads_split(spark, sf_dir):
    """The form for threads too many to broadcast, with large threads split over tasks."""
    joined = join_threads(
        B.comments(spark, sf_dir),
        B.threads(spark, sf_dir),
        hot_rows=20,
        broadcast_limit=-1,
    )
    return _digest(joined)


def _orders_with_customers(spark, sf_dir, key):
    orders = B.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(F.lit("t3_"), F.col("o_custkey").cast("string")).alias("link")
    )
    customers = B.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("custkey"), "c_name"
    )
    keyed = orders.withColumn("order_key", key)
    return skewed_join(keyed, customers, "order_key", "custkey", spread_by="o_orderkey").select(
        "o_orderkey", "order_key", "c_name"
    )


def _orders_sql(key: str) -> str:
    return f"""
        SELECT o_orderkey, {key} AS order_key, c_name
        FROM (SELECT o_orderkey, 't3_' || CAST(o_custkey AS VARCHAR) AS link FROM orders)
        JOIN customer ON {key} = CAST(c_custkey AS VARCHAR)"""


@query("J2 F1b", _orders_sql("regexp_replace(link, '^t3_', '')"))
def orders_by_prefix_key(spark, sf_dir):
    return _orders_with_customers(spark, sf_dir, strip_prefix("link", "t3_"))


@query("J2 F1", _orders_sql("ltrim(link, 't3_')"))
def orders_by_charset_key(spark, sf_dir):
    return _orders_with_customers(spark, sf_dir, ltrim_chars("link", "t3_"))


@query(
    "F1 F1b",
    """SELECT o_orderkey, ltrim('t3_' || CAST(o_custkey AS VARCHAR), 't3_') AS by_charset,
              CAST(o_custkey AS VARCHAR) AS by_prefix
       FROM orders""",
)
def order_keys_stripped(spark, sf_dir):
    link = F.concat(F.lit("t3_"), F.col("o_custkey").cast("string"))
    return B.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        ltrim_chars(link, "t3_").alias("by_charset"),
        strip_prefix(link, "t3_").alias("by_prefix"),
    )


@query(
    "J3",
    """SELECT a.doc_id, a.quality, b.toxic FROM labels a JOIN labels b ON a.doc_id = b.doc_id""",
)
def merged_scores(spark, sf_dir):
    labels = B.table(spark, sf_dir, "labels")
    return merge_scores(
        labels.select("doc_id", "quality"), labels.select("doc_id", "toxic"), "doc_id"
    )


@query(
    "J3",
    """SELECT conv_id, a.role AS left_role, b.role AS right_role, count(*) AS pairs
       FROM conversations a JOIN conversations b USING (conv_id)
       GROUP BY conv_id, a.role, b.role""",
)
def merged_scores_with_repeated_keys(spark, sf_dir):
    """Repeated keys multiply. Counting each side per key first gives the size of the product
    without forming it."""
    turns = B.table(spark, sf_dir, "conversations").groupBy("conv_id", "role").agg(
        F.count(F.lit(1)).alias("n")
    )
    left = turns.select("conv_id", F.col("role").alias("left_role"), F.col("n").alias("left_n"))
    right = turns.select("conv_id", F.col("role").alias("right_role"), F.col("n").alias("right_n"))
    return merge_scores(left, right, "conv_id").select(
        "conv_id", "left_role", "right_role", (F.col("left_n") * F.col("right_n")).alias("pairs")
    )
