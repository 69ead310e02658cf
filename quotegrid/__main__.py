"""Daily run from the command line, for spark-submit."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from quotegrid.operators.history import latest_as_of
from quotegrid.plans.reports import best_value_report, index_report
from quotegrid.plans.run import Paths, run
from quotegrid.reference_data import PERF_WEIGHTS
from quotegrid.sources.tables import read

FOLDERS = ["products", "terms", "pages", "landing", "checkpoint"]
TABLES = ["bronze", "silver", "gold"]


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="quotegrid", description=__doc__)
    for name in FOLDERS:
        parser.add_argument(f"--{name}", required=True, help="folder on shared storage")
    for name in TABLES:
        parser.add_argument(f"--{name}", required=True, help="folder or table name")
    parser.add_argument("--latest", help="table of latest rows, beside Silver by default")
    parser.add_argument("--full", action="store_true", help="dedupe the whole of Bronze")
    parser.add_argument("--archive", help="folder to which loaded landing files move")
    parser.add_argument("--currency", help="leave out quotes stated in another currency")
    parser.add_argument("--performance", action="store_true", help="adjusted prices in Silver")
    parser.add_argument("--region-a", default=Paths.region_a, help="region of catalogue A")
    parser.add_argument("--regions-b", nargs="+", default=Paths.regions_b, help="of catalogue B")
    parser.add_argument("--as-of", help="instant of the snapshot, now by default")
    parser.add_argument("--mode", choices=["append", "replace_date"], default="append")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("quotegrid").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    names = [*FOLDERS, *TABLES, "latest", "region_a", "regions_b", "archive"]
    paths = Paths(**{name: getattr(args, name) for name in names}, incremental=not args.full)
    weights = PERF_WEIGHTS if args.performance else None
    checks = run(spark, paths, args.as_of, args.mode, args.currency, weights)
    for name, rows in checks.items():
        print(f"{name}:")
        rows.orderBy(*rows.columns[:2]).show(truncate=False)

    gold = read(spark, paths.gold, merge=True)
    if args.as_of:
        gold = latest_as_of(gold, args.as_of)
    index_report(gold).show(truncate=False)
    best_value_report(gold).show(truncate=False)


if __name__ == "__main__":
    main()
