"""Day series and region tables: the steps after the reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tonetide.catalog import bindings as B
from tonetide.catalog.registry import query
from tonetide.functions.values import difference, epoch_to_day, intensity, parse_day
from tonetide.operators.filters import drop_values
from tonetide.operators.joins import attach_to_dimension
from tonetide.operators.rollups import percent_rollup
from tonetide.operators.series import densify_daily, series_range
from tonetide.plans.postprocess import daily_series, load_report, region_map
from tonetide.sources.stages import shared_dir, stage
from tonetide.sources.writers import write_report

BAD = "2024-01-15"
LEFT_OUT = ("ALGERIA", "BRAZIL")


@query(
    "A7",
    f"SELECT min(date) AS first_day, max(date) AS last_day FROM ({B.EVENT_FLAGS})",
)
def event_day_range(spark, sf_dir):
    return series_range(B.event_flags(spark, sf_dir), "date")


@query(
    "F11 F3 P8 S6 S7",
    f"""WITH days AS (SELECT date, {B.PERCENT} FROM ({B.EVENT_FLAGS})
                      WHERE date <> '{BAD}' GROUP BY date),
             calendar AS (SELECT unnest(generate_series(min(CAST(date AS DATE)),
                                 max(CAST(date AS DATE)), INTERVAL 1 DAY)) AS day FROM days)
        SELECT strftime(day, '%Y-%m-%d') AS date, Positive, Negative
        FROM calendar LEFT JOIN days ON strftime(day, '%Y-%m-%d') = days.date""",
)
def event_days_without_gaps(spark, sf_dir):
    out = shared_dir(spark)
    rollup = percent_rollup(B.event_flags(spark, sf_dir), ["date"])
    write_report(rollup, f"{out}/time_data.csv", ["date"])
    dense = daily_series(load_report(spark, out, "time_data"), bad_days=[BAD])
    return dense.withColumn("date", F.col("date").cast("string"))


@query(
    "F11",
    """WITH days AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders
                     FROM orders GROUP BY 1),
            calendar AS (SELECT CAST(unnest(generate_series(min(day), max(day),
                                INTERVAL 1 DAY)) AS DATE) AS day FROM days)
       SELECT strftime(calendar.day, '%Y-%m-%d') AS day, orders
       FROM calendar LEFT JOIN days ON calendar.day = days.day""",
)
def order_days_without_gaps(spark, sf_dir):
    orders = B.table(spark, sf_dir, "orders")
    rollup = orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    days = stage(spark, f"{shared_dir(spark)}/days", lambda: rollup)
    return densify_daily(days, "day").withColumn("day", F.col("day").cast("string"))


@query(
    "P8",
    f"SELECT date, count(*) AS events FROM ({B.EVENT_FLAGS}) WHERE date <> '{BAD}' GROUP BY date",
)
def events_without_bad_day(spark, sf_dir):
    kept = drop_values(B.event_flags(spark, sf_dir), "date", [BAD])
    return kept.groupBy("date").agg(F.count(F.lit(1)).alias("events"))


@query(
    "F2 F3",
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day,
              CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS day_number
       FROM events""",
)
def event_days(spark, sf_dir):
    day = epoch_to_day(F.unix_timestamp("ts"))
    return (
        B.table(spark, sf_dir, "events")
        .select("event_id", day.alias("day"))
        .withColumn("day_number", F.date_diff(parse_day("day"), F.lit("2024-01-01").cast("date")))
    )


_KEPT = f"SELECT * FROM nation WHERE n_name NOT IN ({B.sql_list(LEFT_OUT)})"
_ROLLUP = f"""SELECT n_name, {B.PERCENT} FROM ({B.NATION_INPUT})
              WHERE n_name NOT IN ('canada', 'egypt') GROUP BY n_name"""


@query(
    "J4 F6 F7 P9",
    f"""SELECT n.n_nationkey, n.n_name, n.n_regionkey, Positive, Negative,
               Positive - Negative AS Difference
        FROM ({_ROLLUP}) r RIGHT JOIN ({_KEPT}) n ON r.n_name = lower(n.n_name)""",
)
def nations_with_rollup(spark, sf_dir):
    """Two nations have no data and stay with nulls; two others are left out by name."""
    data = drop_values(B.nation_rollup_input(spark, sf_dir), "n_name", ["canada", "egypt"])
    dim = drop_values(B.table(spark, sf_dir, "nation"), "n_name", LEFT_OUT)
    attached = attach_to_dimension(percent_rollup(data, ["n_name"]), dim, "n_name")
    return attached.withColumn("Difference", difference("Positive", "Negative"))


@query(
    "J5 F8",
    f"""SELECT n.n_nationkey, n.n_name, n.n_regionkey, Positive, Negative,
               Positive - Negative AS Difference,
               1 - sqrt((Positive - 0) / CAST(100 AS DOUBLE)) AS PositiveShade,
               1 - sqrt((Negative - 0) / CAST(100 AS DOUBLE)) AS NegativeShade
        FROM (SELECT n_name, {B.PERCENT} FROM ({B.NATION_INPUT}) GROUP BY n_name) r
        JOIN ({_KEPT}) n ON r.n_name = lower(n.n_name)""",
)
def nation_map(spark, sf_dir):
    """Every mapped nation must have data."""
    rollup = stage(
        spark,
        f"{shared_dir(spark)}/rollup",
        lambda: percent_rollup(B.nation_rollup_input(spark, sf_dir), ["n_name"]),
    )
    return region_map(
        rollup, B.table(spark, sf_dir, "nation"), "n_name", strict=True, unmapped=LEFT_OUT
    )


@query(
    "F7 F8",
    """SELECT lang, Positive - Negative AS Difference,
              1 - sqrt((Positive - 0) / CAST(100 AS DOUBLE)) AS Shade
       FROM (SELECT d.lang, avg(l.quality) * CAST(100 AS DOUBLE) AS Positive,
                    avg(l.toxic) * CAST(100 AS DOUBLE) AS Negative
             FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.lang)""",
)
def language_shades(spark, sf_dir):
    docs = B.table(spark, sf_dir, "documents").select("doc_id", "lang")
    rollup = percent_rollup(
        docs.join(B.table(spark, sf_dir, "labels"), "doc_id"),
        ["lang"],
        {"Positive": "quality", "Negative": "toxic"},
    )
    return rollup.select(
        "lang",
        difference("Positive", "Negative").alias("Difference"),
        intensity("Positive", 0.0, 100.0).alias("Shade"),
    )
