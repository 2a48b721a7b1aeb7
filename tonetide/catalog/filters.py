"""Projections, filters and 0/1 columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tonetide.catalog import bindings as B
from tonetide.catalog.registry import query
from tonetide.constants import (
    NEGATIVE_THRESHOLD,
    POSITIVE_THRESHOLD,
    QUOTE_MARK,
    REGIONS,
    SARCASM_MARK,
)
from tonetide.functions.values import flag
from tonetide.operators.filters import (
    derive,
    drop_values,
    in_set,
    not_containing,
    not_starting_with,
    project,
)
from tonetide.plans.train import with_labels


@query(
    "P1 P2 P3 F4",
    f"""SELECT Input_id AS id, labeldjt AS label,
               CAST(labeldjt = '1' AS INTEGER) AS pos_label,
               CAST(labeldjt = '-1' AS INTEGER) AS neg_label
        FROM ({B.LABELS})""",
)
def binary_labels(spark, sf_dir):
    labels = project(B.labels(spark, sf_dir), {"id": "Input_id", "label": "labeldjt"})
    return with_labels(labels, "label")


@query(
    "P2 F5 F6",
    """SELECT page_id, url, lower(url) AS lower_url, contains(url, '/s') AS has_mark,
              starts_with(url, 'https') AS secure
       FROM pages""",
)
def derived_page_columns(spark, sf_dir):
    pages = B.table(spark, sf_dir, "pages").select("page_id", "url")
    return derive(
        pages,
        {
            "lower_url": F.lower("url"),
            "has_mark": F.contains("url", F.lit(SARCASM_MARK)),
            "secure": F.startswith("url", F.lit("https")),
        },
    )


@query("P4 F5", "SELECT page_id, url FROM pages WHERE url NOT LIKE '%/s%'")
def pages_without_mark(spark, sf_dir):
    return not_containing(B.table(spark, sf_dir, "pages"), "url", SARCASM_MARK).select(
        "page_id", "url"
    )


@query(
    "P4",
    f"""SELECT id, md5(body) AS body_md5 FROM ({B.COMMENTS})
        WHERE NOT regexp_matches(body, '(^|[ \\t\\n\\r\\x0b\\f])/s($|[ \\t\\n\\r\\x0b\\f])')""",
)
def comments_without_free_standing_mark(spark, sf_dir):
    kept = not_containing(B.comments(spark, sf_dir), "body", SARCASM_MARK, strict=True)
    return kept.select("id", F.md5("body").alias("body_md5"))


@query(
    "P5 F5",
    f"SELECT id, md5(body) AS body_md5 FROM ({B.COMMENTS}) WHERE body NOT LIKE '&gt%'",
)
def comments_without_leading_quote(spark, sf_dir):
    return not_starting_with(B.comments(spark, sf_dir), "body", QUOTE_MARK).select(
        "id", F.md5("body").alias("body_md5")
    )


@query(
    "P6 U3",
    f"""SELECT id, author_flair_text AS state FROM ({B.COMMENTS})
        WHERE author_flair_text IN ({B.sql_list(REGIONS)})""",
)
def comments_from_valid_regions(spark, sf_dir):
    kept = in_set(B.comments(spark, sf_dir), "author_flair_text", REGIONS)
    return kept.select("id", F.col("author_flair_text").alias("state"))


@query(
    "P6",
    """SELECT doc_id, source FROM documents WHERE source IN
         (SELECT source FROM documents GROUP BY source HAVING avg(n_chars) > 2300)""",
)
def documents_from_listed_sources(spark, sf_dir):
    """The allowed values as a table."""
    docs = B.table(spark, sf_dir, "documents")
    allowed = docs.groupBy("source").agg(F.avg("n_chars").alias("mean")).filter("mean > 2300")
    return in_set(docs, "source", allowed.select("source")).select("doc_id", "source")


@query(
    "P7 F4",
    f"""SELECT event_id,
               CAST(value / CAST(100 AS DOUBLE) > {POSITIVE_THRESHOLD} AS INTEGER) AS pos,
               CAST(value / CAST(100 AS DOUBLE) > {NEGATIVE_THRESHOLD} AS INTEGER) AS neg,
               CAST(CAST(CAST(value / CAST(100 AS DOUBLE) AS FLOAT) AS DOUBLE)
                    > CAST({POSITIVE_THRESHOLD} AS DOUBLE) AS INTEGER) AS pos32
        FROM events""",
)
def flags_from_probability(spark, sf_dir):
    p = F.col("value") / 100.0
    return B.table(spark, sf_dir, "events").select(
        "event_id",
        flag(p, POSITIVE_THRESHOLD).alias("pos"),
        flag(p, NEGATIVE_THRESHOLD).alias("neg"),
        flag(p, POSITIVE_THRESHOLD, float32=True).alias("pos32"),
    )


@query(
    "P9",
    "SELECT n_nationkey, n_name FROM nation WHERE n_name NOT IN ('CANADA', 'JAPAN')",
)
def nations_not_listed(spark, sf_dir):
    kept = drop_values(B.table(spark, sf_dir, "nation"), "n_name", ["CANADA", "JAPAN"])
    return kept.select("n_nationkey", "n_name")
