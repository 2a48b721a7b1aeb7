"""Jobs as the command line starts them."""

import sys

from tonetide import __main__ as command
from tonetide.plans import reports
from tonetide.sources.stages import shared_dir


def test_postprocess_reads_the_reports(spark, monkeypatch):
    out = shared_dir(spark)
    rows = [("c1", "t1", 1514700000, "Ohio", 1, 0, 3, 10), ("c2", "t1", 1514900000, "Utah", 0, 1, 3, 10)]
    scored = spark.createDataFrame(
        rows,
        "comment_id string, submission_id string, timestamp long, state string,"
        " pos int, neg int, comment_score long, submission_score long",
    )
    reports.write_reports(scored, f"{out}/reports")
    spark.createDataFrame([("ohio",), ("guam",)], "state string").write.parquet(f"{out}/regions")
    monkeypatch.setattr(
        sys,
        "argv",
        ["tonetide", "postprocess", "--reports", f"{out}/reports", "--regions", f"{out}/regions",
         "--drop-day", "2018-01-01", "--out", f"{out}/post"],
    )
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    command.main()
    days = spark.read.option("header", True).csv(f"{out}/post/days.csv").collect()
    assert [r.date for r in days] == ["2017-12-31", "2018-01-01", "2018-01-02"]
    regions = spark.read.option("header", True).csv(f"{out}/post/regions.csv").collect()
    assert [r.state for r in regions] == ["guam", "ohio"]
