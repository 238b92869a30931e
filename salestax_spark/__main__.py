"""Command line: ``spark-submit`` or ``python -m salestax_spark``."""

from __future__ import annotations

import argparse

from salestax_spark.operators.checks import check_totals
from salestax_spark.plans.job import CHECKS, Inputs, run
from salestax_spark.session import build_session
from salestax_spark.sources.readers import FAIL, FORMATS, SKIP


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="salestax_spark", description="Rebuild all tables and the report.")
    for source in ("charges", "orders", "refunds"):
        parser.add_argument(f"--{source}", required=True, help=f"path of the {source} documents")
    parser.add_argument("--thresholds", help="threshold CSV (default: built-in table)")
    parser.add_argument("--merchants", help="merchant JSON lines (default: built-in table)")
    parser.add_argument("--format", choices=FORMATS, default="json_lines", help="format of the documents; a json_array file is read by one task")
    parser.add_argument("--out", required=True, help="shared folder for tables and report")
    parser.add_argument("--as-of", help="last day of the trailing window, YYYY-MM-DD (default: today, UTC)")
    parser.add_argument("--months", type=int, default=12)
    parser.add_argument("--null-link", choices=("collapse", "keep"), default="collapse")
    parser.add_argument("--on-bad", choices=(FAIL, SKIP), default=FAIL, help="records that cannot be parsed: stop, or go on and list them")
    parser.add_argument("--month-folders", action="store_true", help="keep unified transactions in a folder per month")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = build_session()
    formats = dict.fromkeys(("charges", "orders", "refunds"), args.format)
    inputs = Inputs(args.charges, args.orders, args.refunds, args.thresholds, args.merchants, formats, args.on_bad)
    tables = run(spark, inputs, args.out, args.as_of, args.months, args.null_link, month_folders=args.month_folders)
    totals = check_totals(tables[CHECKS]).first()
    print(f"checks: {totals.passed} passed, {totals.failed} failed")


if __name__ == "__main__":
    main()
