"""Run one report over CSV files and print it.

    python -m bazaarlens scorecard --pricing pricing.csv --platform platform.csv
    python -m bazaarlens flag --pricing p.csv --platform q.csv --rename sku=item_id
    python -m bazaarlens flag --pricing folder/ --platform q.csv --rejects out/ --table flags

A folder may hold files whose headers differ. Values that do not parse are null, and with
--rejects the lines that hold them are left out and told in CSV files.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from bazaarlens import StatusLabels, sources
from bazaarlens import operators as ops

_REJECTED = "__rejected"
FLAG_VIEW = "local_price_competitive_by_sku"


def arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="bazaarlens", description=__doc__.splitlines()[0])
    parser.add_argument("report", choices=["scorecard", "priority", "top-items", "flag"])
    parser.add_argument("--pricing", required=True, help="CSV of priced models")
    parser.add_argument("--platform", help="CSV of platform orders per region")
    parser.add_argument(
        "--rename",
        action="append",
        default=[],
        metavar="OLD=NEW",
        help="a column to rename to region, item_id, model_id, units, status or platform_order",
    )
    labels = StatusLabels()
    parser.add_argument("--cheaper", default=labels.cheaper, help="status label")
    parser.add_argument("--equal", default=labels.equal, help="status label")
    parser.add_argument("--dearer", default=labels.dearer, help="status label")
    parser.add_argument(
        "--text-threshold",
        action="store_true",
        help="compare with the threshold's text, which fails to parse from 1,000 up",
    )
    parser.add_argument("--rejects", help="folder for the pricing lines that do not parse, which must not exist")
    parser.add_argument("--table", help="table that keeps the flags, in buckets by model; it is replaced")
    parser.add_argument("--buckets", type=int, default=64, help="buckets of that table")
    parser.add_argument("--rows", type=int, default=20, help="rows to print")
    parsed = parser.parse_args(argv)
    if parsed.platform is None and parsed.report in ("scorecard", "flag"):
        parser.error(f"{parsed.report} needs --platform")
    if parsed.table is not None and parsed.report != "flag":
        parser.error("--table keeps the flags only")
    return parsed


def report(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    renames = {**sources.CLEAN_NAMES, **dict(r.split("=", 1) for r in args.rename)}
    labels = StatusLabels(args.cheaper, args.equal, args.dearer)

    told = _REJECTED if args.rejects else None
    pricing = sources.read_csv(spark, args.pricing, sources.schemas.PRICING, names=renames, rejected=told)
    if args.rejects:
        pricing, rejected = sources.split_rejected(pricing, _REJECTED)
        sources.write_rejected(rejected, args.rejects)
    if args.report == "priority":
        return ops.priority_status(pricing, labels=labels)
    if args.report == "top-items":
        return ops.top30_item_count(pricing, text_threshold=args.text_threshold)
    platform = sources.read_csv(spark, args.platform, sources.schemas.PLATFORM, names=renames)
    if args.report == "scorecard":
        return ops.regional_scorecard(pricing, platform, labels=labels)
    flags = ops.top30_model_flag(pricing, platform, text_threshold=args.text_threshold)
    key = ["region", "item_id", "model_id"]
    if args.table:
        stored = sources.publish(
            flags, args.table, persistent=True, overwrite=True, keys=key, buckets=args.buckets
        )
    else:
        stored = sources.publish(flags, FLAG_VIEW)
    return stored.select(*key, "is_top_30_model")


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName(f"bazaarlens {args.report}").getOrCreate()
    report(spark, args).show(args.rows, truncate=False)


if __name__ == "__main__":
    main()
