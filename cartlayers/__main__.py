"""Command line: `spark-submit` entry for one layer or all of them."""

from __future__ import annotations

import argparse

from cartlayers.plans.gold import MIN_ORDERS
from cartlayers.plans.incremental import run_incremental
from cartlayers.plans.layers import (
    CleaningReport,
    profile,
    run_all,
    run_bronze,
    run_gold,
    run_silver,
)
from cartlayers.session import get_session
from cartlayers.settings import Settings
from cartlayers.sources.releases import ReleaseStore
from cartlayers.sources.tables import repair_catalog

LAYERS = ("bronze", "silver", "gold")


def _show_rows(rows: dict[str, int]) -> None:
    for table, n in rows.items():
        print(f"bronze.{table}: {n} rows")


def _show_cleaning(report: CleaningReport) -> None:
    report.typing.filter("falhas > 0").show(truncate=False)
    report.removed.filter("removidas > 0 OR descartadas > 0").show(truncate=False)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="cartlayers", description=__doc__)
    parser.add_argument(
        "layer", choices=[*LAYERS, "all", "incremental", "profile", "repair", "vacuum"],
        help="a layer or all of them in full, what is new only, diagnostics, the catalog, or old releases",
    )
    parser.add_argument("--raw-path", default=Settings.raw_path)
    parser.add_argument("--file-prefix", default=Settings.file_prefix)
    parser.add_argument("--catalog", default=None)
    parser.add_argument("--storage-path", default=None, help="folder of all tables, else that of the databases")
    parser.add_argument("--keep", type=int, default=10, help="releases that vacuum keeps")
    parser.add_argument("--format", dest="table_format", default=Settings.table_format)
    parser.add_argument("--run-id", default=None, help="one id for layers that run separately")
    parser.add_argument(
        "--gate", default="gold", help="layers that failed checks stop, comma-separated, or none"
    )
    parser.add_argument("--observed-count", action="store_true", help="do not recount landing files")
    parser.add_argument("--review-grain", choices=["row", "order"], default="row")
    parser.add_argument("--min-orders", type=int, default=MIN_ORDERS)
    args = parser.parse_args(argv)
    gates = tuple(g for g in args.gate.split(",") if g and g != "none")
    if not set(gates) <= set(LAYERS):
        parser.error(f"--gate takes {', '.join(LAYERS)} or none")
    settings = Settings(
        raw_path=args.raw_path,
        file_prefix=args.file_prefix,
        catalog=args.catalog,
        table_format=args.table_format,
        storage_path=args.storage_path,
    )
    spark = get_session()
    recount, gated = not args.observed_count, args.layer in gates
    if args.layer == "bronze":
        _show_rows(run_bronze(spark, settings, args.run_id, recount, gated))
    elif args.layer == "silver":
        _show_cleaning(run_silver(spark, settings, args.run_id, gated))
    elif args.layer == "gold":
        run_gold(spark, settings, args.run_id, gated, args.review_grain, args.min_orders)
    elif args.layer == "all":
        report = run_all(
            spark, settings, gates, args.run_id, recount, args.review_grain, args.min_orders
        )
        print(f"run {report.run_id}")
        _show_rows(report.rows)
        _show_cleaning(report.cleaning)
    elif args.layer == "incremental":
        done = run_incremental(spark, settings, args.run_id, gates, args.min_orders)
        print(f"run {done.run_id}")
        for table, parts in done.landed.items():
            print(f"bronze.{table}: {len(parts)} new batches, silver: {len(done.touched.get(table, ()))} parts replaced")
        totals = {None: "up to date", True: "rebuilt", False: "updated"}[done.rebuilt]
        print(f"gold: {totals}")
    elif args.layer == "repair":
        for layer in LAYERS:
            repair_catalog(spark, settings, layer)
    elif args.layer == "vacuum":
        for layer in LAYERS:
            gone = ReleaseStore.of(spark, settings, layer).vacuum(args.keep)
            print(f"{layer}: {len(gone)} folders deleted")
    else:
        found = profile(spark, settings)
        for nulls in found.nulls.values():
            nulls.show(truncate=False)
        for frame in (found.scores_outside, found.inconsistent_dates, found.log):
            frame.show(truncate=False)


if __name__ == "__main__":
    main()
