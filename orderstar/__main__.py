"""Command line: ``spark-submit`` or ``python -m orderstar STEP ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans import refresh as plan
from .sources.files import remove_old_versions


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="orderstar", description=__doc__)
    steps = parser.add_subparsers(dest="step", required=True)

    def step(
        name: str, text: str, raw: bool = False, core: bool = False, resume: bool = False
    ) -> None:
        options = steps.add_parser(name, help=text)
        if raw:
            options.add_argument("raw", help="parquet folder or glob with order lines")
        options.add_argument("warehouse", help="folder of the warehouse to write")
        if core:
            options.add_argument("--previous", help="warehouse a first version takes users and drivers from")
            options.add_argument("--strict", action="store_true", help="stop at a broken constraint")
        if resume:
            options.add_argument("--resume", action="store_true", help="keep tables already written whole")
        options.add_argument("--max-shuffle-partitions", type=int, help="default: what the input asks for")

    step("load", "order lines to staging", raw=True)
    step("core", "dimensions and facts", core=True, resume=True)
    step("marts", "daily item sales and both marts", resume=True)
    step("orders-mart", "the mart of orders alone")
    step("items-mart", "daily item sales and the mart of items alone")
    step("publish", "make the version that was built the current one")
    step("refresh", "all of these", raw=True, core=True, resume=True)
    retain = steps.add_parser("retain", help="delete old versions")
    retain.add_argument("warehouse", help="folder of the warehouse")
    retain.add_argument("--keep", type=int, required=True, help="complete versions that stay")
    return parser.parse_args(given)


def main(given: list[str] | None = None) -> None:
    args = arguments(given)
    spark = SparkSession.builder.appName(f"orderstar-{args.step}").getOrCreate()
    root = args.warehouse
    if args.step == "retain":
        print("deleted:", *remove_old_versions(spark, root, args.keep))
        return
    most = args.max_shuffle_partitions
    marts = {"marts": None, "orders-mart": [plan.ORDERS_MART], "items-mart": [plan.ITEMS_MART]}
    if args.step == "load":
        plan.load_staging(spark, args.raw, root)
    elif args.step == "core":
        built = plan.build_core(spark, root, args.previous, args.strict, most, args.resume)
        plan.recorded_counts(built).show(truncate=False)
    elif args.step in marts:
        plan.build_marts(spark, root, marts[args.step], most, getattr(args, "resume", False))
    elif args.step == "publish":
        plan.publish(spark, root)
    else:
        built = plan.refresh(spark, args.raw, root, args.previous, args.strict, most, args.resume)
        plan.recorded_counts(built).show(truncate=False)


if __name__ == "__main__":
    main()
