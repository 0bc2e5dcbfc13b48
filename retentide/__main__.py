"""Command line of the daily batch: ``python -m retentide <job> <YYYYMMDD> ...``."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from retentide.functions.calendar import parse_day
from retentide.plans import jobs
from retentide.sources import published


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="retentide", description=__doc__)
    commands = top.add_subparsers(dest="job", required=True)

    def command(name: str, about: str, *days: str, raw: bool = False) -> None:
        sub = commands.add_parser(name, help=about)
        for day in days:
            sub.add_argument(day, type=parse_day, metavar="YYYYMMDD")
        if raw:
            sub.add_argument("--raw", required=True, help="path of the raw event log; {day} in it stands for the day, as YYYY-MM-DD")

    create = commands.add_parser("create", help="create the tables")
    create.add_argument("--bitmap-buckets", type=int, help="split each day of bitmaps by device")
    command("bronze", "load one day of raw events", "day", raw=True)
    command("bitmaps", "clean a day, build its login bitmaps and those of the days after", "day")
    command("activity", "build one day of user activity", "day")
    command("states", "rebuild the user state ranges", "day")
    command("metrics", "rebuild the balance and serving tables", "day")
    for name, about, *days in (("run-day", "load a day and everything that follows from it", "day"), ("backfill", "load many days at once", "first", "last")):
        command(name, about, *days, raw=True)
        commands.choices[name].add_argument("--blocks-only", action="store_true", help="keep login histories in blocks; don't store the bitmaps of each day")
    command("publish", "show readers all tables as they are now, at once")
    command("vacuum", "delete published versions")
    commands.choices["vacuum"].add_argument("--keep", type=int, default=2, help="versions that stay")
    command("check", "report the data-quality checks of a day", "day", raw=True)
    command("reconcile", "compare days of bronze with the raw log by content", "first", "last", raw=True)
    return top


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    """The exit code: 1 if a check found something or stopped a load."""
    jobs.create_tables(spark, bitmap_buckets=getattr(args, "bitmap_buckets", None))
    try:
        if args.job == "bronze":
            print(jobs.load_bronze(spark, args.raw, args.day))
        elif args.job == "bitmaps":
            print(jobs.bitmaps_and_later(spark, args.day))
        elif args.job == "activity":
            print(jobs.step_activity(spark, args.day))
        elif args.job == "states":
            jobs.rebuild_states(spark, args.day)
        elif args.job == "metrics":
            jobs.rebuild_metrics(spark, args.day)
        elif args.job == "run-day":
            print(jobs.run_day(spark, args.raw, args.day, stored=not args.blocks_only))
        elif args.job == "backfill":
            jobs.backfill(spark, args.raw, args.first, args.last, stored=not args.blocks_only)
        elif args.job == "publish":
            print(jobs.publish(spark).number)
        elif args.job == "vacuum":
            print(published.vacuum(spark, jobs.published_root(spark), args.keep))
        elif args.job == "check":
            checks = jobs.check_bronze(spark, args.raw, args.day)
            found = checks.unionByName(jobs.check_bitmaps(spark, args.day)).collect()
            for row in found:
                print(f"{row['check']}: {row['n_bad']}")
            return int(any(row["n_bad"] for row in found))
        elif args.job == "reconcile":
            found = jobs.reconcile_bronze(spark, args.raw, args.first, args.last).orderBy("event_date").collect()
            for row in found:
                print(f"{row['event_date']}: {row['source_rows']} in the log, {row['table_rows']} loaded, {row['missing']} missing, {row['extra']} too many")
            return int(any(row["missing"] or row["extra"] for row in found))
    except jobs.FailedChecks as failed:
        print(f"stopped by checks: {failed}")
        return 1
    return 0


if __name__ == "__main__":
    arguments = parser().parse_args()
    # Tables are found again by their folders below the warehouse, so any catalog will do.
    session = SparkSession.builder.appName("retentide").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    code = run(session, arguments)
    session.stop()
    sys.exit(code)
