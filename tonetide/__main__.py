"""Command line: ``spark-submit`` or ``python -m tonetide <job> …``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tonetide.constants import MIN_DOCUMENT_FREQUENCY, NEGATIVE_THRESHOLD, POSITIVE_THRESHOLD
from tonetide.plans import postprocess
from tonetide.plans.full_run import run
from tonetide.plans.reports import write_reports
from tonetide.sources.ingest import clean_file, ingest
from tonetide.sources.readers import read_table
from tonetide.sources.writers import write_report


def _raw_inputs(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--comments", required=True, help="JSON lines, plain or bz2")
    parser.add_argument("--threads", required=True, help="JSON lines, plain or bz2")
    parser.add_argument("--labels", required=True, help="CSV with a header")


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tonetide", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("run", help="ingest, train, score and report")
    _raw_inputs(job)
    job.add_argument("--workdir", required=True, help="shared folder for stages and reports")
    job.add_argument("--seed", type=int, required=True)
    job.add_argument("--fraction", type=float, default=1.0, help="share of rows to score")
    job.add_argument("--min-df", type=int, default=MIN_DOCUMENT_FREQUENCY)
    job.add_argument("--positive-threshold", type=float, default=POSITIVE_THRESHOLD)
    job.add_argument("--negative-threshold", type=float, default=NEGATIVE_THRESHOLD)
    job.add_argument("--float32", action="store_true", help="round probabilities to 32 bits first")
    job.add_argument("--strip", choices=("prefix", "charset"), default="prefix")
    job.add_argument("--min-group", type=int, default=1, help="comments a top thread needs")

    job = jobs.add_parser("ingest", help="raw files to parquet tables")
    _raw_inputs(job)
    job.add_argument("--out", required=True)

    job = jobs.add_parser("report", help="the seven reports of a scored table")
    job.add_argument("--scored", required=True)
    job.add_argument("--out", required=True)

    job = jobs.add_parser("postprocess", help="daily series and region map from the reports")
    job.add_argument("--reports", required=True, help="folder of the report files")
    job.add_argument("--regions", required=True, help="parquet table with a column state")
    job.add_argument("--drop-day", action="append", default=[], help="day to leave out")
    job.add_argument("--out", required=True)

    job = jobs.add_parser("clean", help="clean the body of every JSON line")
    job.add_argument("--input", required=True)
    job.add_argument("--out", required=True)
    return parser.parse_args()


def main() -> None:
    args = _arguments()
    spark = SparkSession.builder.appName(f"tonetide {args.job}").getOrCreate()
    if args.job == "run":
        run(
            spark,
            args.comments,
            args.threads,
            args.labels,
            args.workdir,
            args.seed,
            args.fraction,
            scoring={
                "positive_threshold": args.positive_threshold,
                "negative_threshold": args.negative_threshold,
                "float32": args.float32,
                "strip": args.strip,
            },
            min_group=args.min_group,
            min_df=args.min_df,
        )
    elif args.job == "ingest":
        ingest(spark, args.comments, args.threads, args.labels, args.out)
    elif args.job == "report":
        write_reports(read_table(spark, args.scored), args.out)
    elif args.job == "postprocess":
        days = postprocess.load_report(spark, args.reports, "time_data")
        write_report(postprocess.daily_series(days, args.drop_day), f"{args.out}/days.csv", ["date"])
        states = postprocess.load_report(spark, args.reports, "state_data")
        mapped = postprocess.region_map(states, read_table(spark, args.regions))
        write_report(mapped, f"{args.out}/regions.csv", ["state"])
    else:
        clean_file(spark, args.input, args.out)
    spark.stop()


if __name__ == "__main__":
    main()
