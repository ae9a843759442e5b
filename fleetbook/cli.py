"""Command line for the maintenance jobs and reports.

    spark-submit fleetbook/cli.py settle --src DIR --dst DIR
    spark-submit fleetbook/cli.py settle-in-place --src DIR --reservation-part COL --car-part COL
    spark-submit fleetbook/cli.py append --src FILE --dst DIR --table payment --load 2024-05-01
    spark-submit fleetbook/cli.py raise-rates --src DIR --dst DIR --percent 10
    spark-submit fleetbook/cli.py integrity --src DIR --dst DIR
    spark-submit fleetbook/cli.py cascade-delete --src DIR --dst DIR --table car_type \\
        --where "car_type = 'SUV'"
    spark-submit fleetbook/cli.py overdue-report --src DIR --dst DIR [--as-of 2016-01-01]
    spark-submit fleetbook/cli.py promo-report --src DIR --dst DIR

``DIR`` holds one ``<table>.parquet`` folder per rental table. Reports are
written as text (one line per row) to ``<dst>/<report>``. The session comes
from ``spark-submit``; nothing here overrides the cluster's settings.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from fleetbook import jobs  # noqa: E402
from fleetbook.operators import reports  # noqa: E402
from fleetbook.sources.tables import read_table  # noqa: E402


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="fleetbook")
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("settle-in-place")
    s.add_argument("--src", required=True)
    s.add_argument("--reservation-part", required=True, help="partition column of the reservation table")
    s.add_argument("--car-part", required=True, help="partition column of the car table")
    for name in ("settle", "append", "raise-rates", "integrity", "cascade-delete", "overdue-report",
                 "promo-report"):
        s = sub.add_parser(name)
        s.add_argument("--src", required=True)
        s.add_argument("--dst", required=True)
        if name == "append":
            s.add_argument("--table", required=True)
            s.add_argument("--load", required=True, help="name of the load; the same name replaces it")
        if name == "raise-rates":
            s.add_argument("--percent", required=True, type=Decimal)
        if name == "cascade-delete":
            s.add_argument("--table", required=True)
            s.add_argument("--where", required=True, help="SQL condition on that table")
        if name == "overdue-report":
            s.add_argument("--as-of", type=dt.date.fromisoformat, default=None)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"fleetbook-{args.cmd}").getOrCreate()
    if args.cmd == "settle":
        jobs.settle_job(spark, args.src, args.dst)
    elif args.cmd == "settle-in-place":
        jobs.settle_in_place(spark, args.src, {"reservation": args.reservation_part, "car": args.car_part})
    elif args.cmd == "append":
        jobs.append_job(spark, args.src, args.dst, args.table, args.load)
    elif args.cmd == "raise-rates":
        jobs.raise_rates_job(spark, args.src, args.dst, args.percent)
    elif args.cmd == "integrity":
        jobs.integrity_job(spark, args.src, args.dst)
    elif args.cmd == "cascade-delete":
        doomed = read_table(spark, args.src, args.table).where(args.where)
        jobs.cascade_delete_job(spark, args.src, args.dst, {args.table: doomed})
    elif args.cmd == "overdue-report":
        lines = reports.overdue_report(read_table(spark, args.src, "reservation"),
                                       read_table(spark, args.src, "car_user"),
                                       as_of=args.as_of)
        reports.write_report(lines, os.path.join(args.dst, "overdue_report"))
    elif args.cmd == "promo-report":
        lines = reports.promo_usage_report(read_table(spark, args.src, "offer_details"),
                                           read_table(spark, args.src, "reservation"))
        reports.write_report(lines, os.path.join(args.dst, "promo_usage_report"))


if __name__ == "__main__":
    main()
