"""Command line: ``python -m strataroll history|facts|run ... --as-of YYYY-MM-DD``."""

import argparse
from collections.abc import Sequence
from datetime import date

from pyspark.sql import SparkSession

from strataroll.plans import jobs


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    usual = jobs.Settings()
    parser = argparse.ArgumentParser(prog="strataroll")
    parser.add_argument("job", choices=["history", "facts", "run"])
    parser.add_argument("--raw", help="raw JSON files (history, run)")
    parser.add_argument("--history", required=True, help="root folder of the history tables")
    parser.add_argument("--facts", help="root folder of the fact tables (facts, run)")
    parser.add_argument("--as-of", required=True, type=date.fromisoformat)
    parser.add_argument("--columns", help="JSON file with allowed_columns, in any store that Spark reads")
    parser.add_argument("--layout", choices=["document", "lines", "rows"], default=usual.layout)
    parser.add_argument("--key", default=usual.key, help="business key")
    parser.add_argument("--change-columns", nargs="+", default=usual.change_columns)
    parser.add_argument("--critical", nargs="*", default=usual.critical, help="columns that may not be null")
    parser.add_argument("--unique", nargs="*", default=usual.unique, help="columns that identify rows")
    parser.add_argument(
        "--range", nargs=3, action="append", metavar=("COLUMN", "LOW", "HIGH"), help="bounds to check; repeatable"
    )
    parser.add_argument("--small-source", action="store_true", help="snapshots are small beside the history")
    parser.add_argument("--sketched", action="store_true", help="keep sketches of the unique columns")
    parser.add_argument("--buckets", type=int, default=usual.buckets, help="cut current rows by key, write only touched buckets")
    parser.add_argument("--compact-after", type=int, default=usual.compact_after, help="fold so many folders of closed rows")
    parser.add_argument("--attempts", type=int, default=usual.attempts, help="runs, where another writer commits first")
    parser.add_argument("--on-new-columns", choices=["warn", "fail"], default=usual.on_new_columns)
    parser.add_argument("--on-failed-checks", choices=["warn", "fail"], default=usual.on_failed_checks)
    parser.add_argument("--fact-keys", nargs="+", default=usual.fact_keys, help="normalised grouping columns")
    parser.add_argument("--fact-year", default=usual.fact_year)
    parser.add_argument("--fact-range", default=usual.fact_range)
    parser.add_argument("--fact-price", default=usual.fact_price)
    args = parser.parse_args(argv)
    if args.job != "facts" and not args.raw:
        parser.error("--raw is required")
    if args.job != "history" and not args.facts:
        parser.error("--facts is required")
    return args


def settings(args: argparse.Namespace, spark: SparkSession | None = None) -> jobs.Settings:
    """The arguments as the settings of a run."""
    usual = jobs.Settings()
    return jobs.Settings(
        columns=jobs.load_allowed_columns(args.columns, spark) if args.columns else usual.columns,
        key=args.key,
        change_columns=tuple(args.change_columns),
        critical=tuple(args.critical),
        ranges={c: (float(low), float(high)) for c, low, high in args.range} if args.range else usual.ranges,
        unique=tuple(args.unique),
        on_new_columns=args.on_new_columns,
        on_failed_checks=args.on_failed_checks,
        layout=args.layout,
        small_source=args.small_source,
        sketched=args.sketched,
        buckets=args.buckets,
        compact_after=args.compact_after,
        attempts=args.attempts,
        fact_keys=tuple(args.fact_keys),
        fact_year=args.fact_year,
        fact_range=args.fact_range,
        fact_price=args.fact_price,
    )


def main() -> None:
    args = arguments()
    spark = SparkSession.builder.appName("strataroll").getOrCreate()
    chosen = settings(args, spark)
    if args.job == "run":
        jobs.run(spark, args.raw, args.history, args.facts, args.as_of, chosen)
    elif args.job == "history":
        jobs.refresh_history(spark, args.raw, args.history, args.as_of, chosen)
    else:
        jobs.refresh_facts(
            spark,
            args.history,
            args.facts,
            args.as_of,
            chosen.fact_keys,
            year=chosen.fact_year,
            electric_range=chosen.fact_range,
            price=chosen.fact_price,
        )


if __name__ == "__main__":
    main()
