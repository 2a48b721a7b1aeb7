"""The seven reports, and the same rollup over other tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tonetide.catalog import bindings as B
from tonetide.catalog.registry import query
from tonetide.constants import REGIONS
from tonetide.operators.filters import in_set
from tonetide.operators.rollups import ordered, percent_rollup
from tonetide.plans import reports as R
from tonetide.plans.inspect import register_global_view, register_view
from tonetide.functions.sql_surface import register_functions


@query("A1 F9", f"SELECT {B.PERCENT} FROM ({B.FLAGGED})")
def percent_overall(spark, sf_dir):
    return R.overall(B.flagged(spark, sf_dir))


@query(
    "A2 O1 F2",
    f"""SELECT strftime(make_timestamp(timestamp * 1000000), '%Y-%m-%d') AS date, {B.PERCENT}
        FROM ({B.FLAGGED}) GROUP BY 1 ORDER BY 1""",
)
def percent_by_day(spark, sf_dir):
    return R.by_day(B.flagged(spark, sf_dir))


@query(
    "A3 P6 U3",
    f"""SELECT state, {B.PERCENT} FROM ({B.FLAGGED})
        WHERE state IN ({B.sql_list(REGIONS)}) GROUP BY state""",
)
def percent_by_region(spark, sf_dir):
    return R.by_region(B.flagged(spark, sf_dir))


@query(
    "A4", f"SELECT submission_score, {B.PERCENT} FROM ({B.FLAGGED}) GROUP BY submission_score"
)
def percent_by_thread_score(spark, sf_dir):
    return R.by_thread_score(B.flagged(spark, sf_dir))


@query("A5", f"SELECT comment_score, {B.PERCENT} FROM ({B.FLAGGED}) GROUP BY comment_score")
def percent_by_comment_score(spark, sf_dir):
    return R.by_comment_score(B.flagged(spark, sf_dir))


@query(
    "A6",
    f"""SELECT submission_id, submission_score, {B.PERCENT} FROM ({B.FLAGGED})
        GROUP BY submission_score, submission_id""",
)
def percent_by_thread(spark, sf_dir):
    return percent_rollup(B.flagged(spark, sf_dir), ["submission_id", "submission_score"])


@query(
    "A1 A2 A3 A4 A5 A6",
    f"""SELECT date, state, submission_id, submission_score, comment_score, {B.PERCENT},
               count(*) AS "__comments",
               CASE grouping_id(date, state, submission_id, submission_score, comment_score)
                 WHEN 31 THEN 'raw_percentages' WHEN 15 THEN 'time_data' WHEN 23 THEN 'state_data'
                 WHEN 29 THEN 'submission_score' WHEN 30 THEN 'comment_score' ELSE 'threads'
               END AS report
        FROM (SELECT *, strftime(make_timestamp(timestamp * 1000000), '%Y-%m-%d') AS date
              FROM ({B.FLAGGED}))
        GROUP BY GROUPING SETS
          ((), (date), (state), (submission_score), (comment_score), (submission_id, submission_score))
    """,
)
def percents_of_all_reports(spark, sf_dir):
    """Every grouping of the reports from one scan."""
    return R.all_rollups(B.flagged(spark, sf_dir))


def _top(measure: str) -> str:
    return f"""
        SELECT submission_id, submission_score, {B.PERCENT} FROM ({B.FLAGGED})
        GROUP BY submission_score, submission_id
        ORDER BY {measure} DESC, submission_score, submission_id LIMIT 10"""


@query("O2", _top("Positive"))
def top_positive_threads(spark, sf_dir):
    return R.top_threads(B.flagged(spark, sf_dir), "Positive")


@query("O3", _top("Negative"))
def top_negative_threads(spark, sf_dir):
    return R.top_threads(B.flagged(spark, sf_dir), "Negative")


@query(
    "A3 J1 P1 P6",
    """SELECT d.lang AS lang, avg(l.quality) * CAST(100 AS DOUBLE) AS Positive,
              avg(l.toxic) * CAST(100 AS DOUBLE) AS Negative
       FROM documents d JOIN labels l ON d.doc_id = l.doc_id
       WHERE d.lang IN ('en', 'fr') GROUP BY d.lang""",
)
def percent_by_language(spark, sf_dir):
    docs = in_set(B.table(spark, sf_dir, "documents"), "lang", ["en", "fr"])
    joined = docs.select("doc_id", "lang").join(B.table(spark, sf_dir, "labels"), "doc_id")
    return percent_rollup(joined, ["lang"], {"Positive": "quality", "Negative": "toxic"})


@query(
    "A6",
    """SELECT d.source AS source, d.lang AS lang,
              avg(l.quality) * CAST(100 AS DOUBLE) AS Positive,
              avg(l.toxic) * CAST(100 AS DOUBLE) AS Negative
       FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.source, d.lang""",
)
def percent_by_source_and_language(spark, sf_dir):
    docs = B.table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    joined = docs.join(B.table(spark, sf_dir, "labels"), "doc_id")
    return percent_rollup(
        joined, ["source", "lang"], {"Positive": "quality", "Negative": "toxic"}
    )


@query(
    "A4",
    """SELECT o_orderpriority,
              avg(CAST(o_orderstatus = 'F' AS INTEGER)) * CAST(100 AS DOUBLE) AS Positive,
              avg(CAST(o_orderstatus = 'O' AS INTEGER)) * CAST(100 AS DOUBLE) AS Negative
       FROM orders GROUP BY o_orderpriority""",
)
def percent_by_order_priority(spark, sf_dir):
    orders = B.table(spark, sf_dir, "orders").select(
        "o_orderpriority",
        (F.col("o_orderstatus") == "F").cast("int").alias("pos"),
        (F.col("o_orderstatus") == "O").cast("int").alias("neg"),
    )
    return percent_rollup(orders, ["o_orderpriority"])


@query("A2 O1 F2", f"SELECT date, {B.PERCENT} FROM ({B.EVENT_FLAGS}) GROUP BY date ORDER BY date")
def percent_of_events_by_day(spark, sf_dir):
    return ordered(percent_rollup(B.event_flags(spark, sf_dir), ["date"]), ["date"])


@query(
    "K5 P7 U2 U3",
    f"""SELECT state, count(*) AS comments, sum(CAST(pos > 0 AS INTEGER))::BIGINT AS positives
        FROM ({B.FLAGGED}) WHERE state IN ({B.sql_list(REGIONS)}) GROUP BY state""",
)
def regions_in_sql_text(spark, sf_dir):
    """SQL text over a view, calling the registered SQL functions."""
    register_functions(spark)
    scored = B.flagged(spark, sf_dir).withColumn(
        "probability", F.array(1.0 - F.col("pos"), F.col("pos").cast("double"))
    )
    register_view(scored, "flagged_comments")
    return spark.sql(
        """
        FROM flagged_comments
        |> WHERE valid_state(state)
        |> AGGREGATE count(*) AS comments,
                     count_if(first_element(probability) > 0.2) AS positives
           GROUP BY state
        """
    )


@query("K6", f"SELECT title, {B.PERCENT} FROM ({B.FLAGGED}) GROUP BY title")
def titles_from_global_view(spark, sf_dir):
    name = "tonetide_flagged"
    spark.catalog.dropGlobalTempView(name)
    register_global_view(B.flagged(spark, sf_dir), name)
    return percent_rollup(spark.table(f"global_temp.{name}"), ["title"])
