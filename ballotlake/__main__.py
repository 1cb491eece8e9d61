"""``python -m ballotlake voters FOLDER DATABASE`` or ``python -m ballotlake calendars OUT``."""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from .plans import pipeline
from .session import SQL_SETTINGS


def main() -> None:
    parser = argparse.ArgumentParser(prog="ballotlake")
    parser.add_argument("--as-of", type=datetime.fromisoformat, default=None, help="run time, UTC")
    jobs = parser.add_subparsers(dest="job", required=True)
    voters = jobs.add_parser("voters", help="load new voter files and rebuild the tables")
    voters.add_argument("folder")
    voters.add_argument("database")
    voters.add_argument("--truncate", action="store_true", help="replace the raw table")
    voters.add_argument("--buckets", type=int, default=None)
    calendar = jobs.add_parser("calendars", help="write the election seeds and load them")
    calendar.add_argument("out")
    calendar.add_argument("--results", default=None, help="results file (TSV)")
    calendar.add_argument("--civic", default=None, help="civic listings (JSON)")
    args = parser.parse_args()
    as_of = args.as_of or datetime.now(timezone.utc).replace(tzinfo=None)

    # Runs build on the tables of earlier runs, so the catalog has to outlive the process.
    builder = SparkSession.builder.appName("ballotlake").enableHiveSupport()
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if args.job == "voters":
        run = pipeline.load_voters(spark, args.folder, args.database, as_of, args.truncate)
        print(f"{run.files} files, {run.new_records} new records, {run.voter_count} voters in {run.state_count} states")
        if spark.catalog.tableExists(f"{args.database}.vote_records"):
            tables = pipeline.build_models(spark, args.database, as_of, args.buckets)
            report = pipeline.check_report(spark, args.database, list(tables), as_of)
            report.where("NOT passed").show(200, truncate=False)
    else:
        seeds = pipeline.build_calendars(spark, args.out, as_of, args.results, args.civic)
        pipeline.load_seeds(spark, args.out, seeds)
        print("seeds written and loaded: " + ", ".join(seeds))


if __name__ == "__main__":
    main()
