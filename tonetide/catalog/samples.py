"""Samples and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tonetide.catalog import bindings as B
from tonetide.catalog.registry import query
from tonetide.constants import SAMPLE_FRACTION, TRAIN_WEIGHTS
from tonetide.operators.sampling import hash_sample, hash_split, sample, split


def _position(key: str, salt: str = "") -> str:
    return (
        f"CAST(CAST('0x' || substr(md5(coalesce(CAST({key} AS VARCHAR), '') || '{salt}'), 1, 8)"
        " AS BIGINT)"
        " AS DOUBLE) / 4294967296"
    )


@query(
    "K3",
    f"""SELECT o_orderkey, o_totalprice FROM orders
        WHERE {_position('o_orderkey')} < CAST({SAMPLE_FRACTION} AS DOUBLE)""",
)
def orders_hash_sampled(spark, sf_dir):
    return hash_sample(B.table(spark, sf_dir, "orders"), "o_orderkey", SAMPLE_FRACTION).select(
        "o_orderkey", "o_totalprice"
    )


@query("K3")
def orders_sampled(spark, sf_dir):
    return sample(B.table(spark, sf_dir, "orders"), SAMPLE_FRACTION, seed=7)


@query(
    "K3",
    """SELECT 'outside the table' AS what, CAST(0 AS BIGINT) AS n
       UNION ALL SELECT 'drawn twice', 0 UNION ALL SELECT 'differs when repeated', 0""",
)
def orders_sample_is_sound(spark, sf_dir):
    """A sample is part of its table, without repeats, and its seed brings it back."""
    orders = B.table(spark, sf_dir, "orders").select("o_orderkey")
    drawn = sample(orders, SAMPLE_FRACTION, seed=7)
    again = sample(orders, SAMPLE_FRACTION, seed=7)
    twice = drawn.groupBy("o_orderkey").count().filter("count > 1")
    parts = {
        "outside the table": drawn.join(orders, "o_orderkey", "left_anti"),
        "drawn twice": twice,
        "differs when repeated": drawn.join(again, "o_orderkey", "left_anti"),
    }
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(what).alias("what"), "n")
        for what, df in parts.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query(
    "K4",
    f"""SELECT o_orderkey, CAST({_position('o_orderkey', ':s')} >= 0.5 AS INTEGER) AS part
        FROM orders""",
)
def orders_hash_split(spark, sf_dir):
    orders = B.table(spark, sf_dir, "orders").select("o_orderkey")
    first, second = hash_split(orders, "o_orderkey", TRAIN_WEIGHTS, salt=":s")
    return first.withColumn("part", F.lit(0)).unionByName(second.withColumn("part", F.lit(1)))


@query("K4", "SELECT o_orderkey, CAST(1 AS BIGINT) AS parts FROM orders")
def orders_randomly_split(spark, sf_dir):
    """Each row must be in exactly one part."""
    orders = B.table(spark, sf_dir, "orders").select("o_orderkey")
    first, second = split(orders, TRAIN_WEIGHTS, seed=7)
    return first.unionByName(second).groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("parts"))


def _with_nulls(spark, sf_dir):
    """Orders; every third key is missing."""
    orders = B.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    key = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey"))
    return orders.select(key.alias("key"), "o_custkey")


_NULLS = "SELECT CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey END AS key, o_custkey FROM orders"


@query(
    "K3 K4",
    f"""SELECT key, o_custkey, CAST({_position('key', ':n')} >= 0.5 AS INTEGER) AS part
        FROM ({_NULLS})""",
)
def orders_with_null_keys_split(spark, sf_dir):
    """Rows without a key stay: all in the part of an empty key."""
    first, second = hash_split(_with_nulls(spark, sf_dir), "key", TRAIN_WEIGHTS, salt=":n")
    return first.withColumn("part", F.lit(0)).unionByName(second.withColumn("part", F.lit(1)))


@query(
    "K3",
    f"SELECT key, o_custkey FROM ({_NULLS}) WHERE {_position('key', ':n')} < CAST(0.6 AS DOUBLE)",
)
def orders_with_null_keys_sampled(spark, sf_dir):
    return hash_sample(_with_nulls(spark, sf_dir), "key", 0.6, salt=":n")
