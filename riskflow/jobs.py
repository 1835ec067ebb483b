"""Command line: ``python -m riskflow.jobs <step> --root <folder> ...``."""

from __future__ import annotations

import argparse

from riskflow.plans import layers
from riskflow.schemas import SOURCES
from riskflow.session import build_session


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="riskflow")
    steps = top.add_subparsers(dest="step", required=True)

    def step(name: str, **options) -> argparse.ArgumentParser:
        p = steps.add_parser(name)
        p.add_argument("--root", required=True)
        return p

    p = step("bronze")
    p.add_argument("--data", required=True, help="folder with <table>.csv files")
    p.add_argument("--tables", default=",".join(SOURCES))
    p.add_argument("--dates", nargs="*")
    p = step("silver")
    p.add_argument("--tables", default=",".join(SOURCES))
    p.add_argument("--dates", nargs="*")
    p.add_argument("--only-new", action="store_true")
    p.add_argument("--only-changed", action="store_true", help="months whose raw files were written since they were last cleaned")
    p.add_argument("--sweep", action="store_true", help="type undeclared text columns by the types kept for the table")
    p = step("profile")
    p.add_argument("--tables", default=",".join(SOURCES))
    p.add_argument("--exact", nargs="*", default=[], help="columns whose distinct values are counted exactly")
    p = step("applications")
    p.add_argument("choice", nargs="?", default="latest", help="latest, all, range, or a date")
    p.add_argument("first", nargs="?")
    p.add_argument("last", nargs="?")
    p = step("features")
    p.add_argument("--asof")
    p.add_argument("--strict", action="store_true")
    p.add_argument("--dates", nargs="*", help="application days to build, from stored state; the others stay")
    p.add_argument("--only-new", action="store_true", help="application days that the feature store does not hold")
    p = step("state")
    p.add_argument("--through", required=True, help="merge the snapshots up to this day into the customer state")
    p = step("categories")
    p.add_argument("--asof")
    p.add_argument("--top", type=int, default=15)
    p = step("labels")
    p.add_argument("--dpd", type=int, default=30)
    p.add_argument("--mob", type=int, default=1)
    p.add_argument("--dates", nargs="*")
    p = step("ever-default")
    p.add_argument("--asof", required=True)
    p.add_argument("--dpd", type=int, default=30)
    p.add_argument("--mob", type=int, default=0)
    p = step("train")
    p.add_argument("--snapshotdate", required=True)
    p.add_argument("--kind", choices=["lr", "gbt"], default="lr")
    p.add_argument("--dpd", type=int, default=30)
    p.add_argument("--mob", type=int, default=1)
    p.add_argument("--trials", type=int)
    p.add_argument("--select", type=int, help="fit medians and a choice of so many features with the model")
    p.add_argument("--balanced", action="store_true", help="with --select: weigh classes")
    p = step("score")
    p.add_argument("--model", required=True)
    p.add_argument("--dates", nargs="*")
    p.add_argument("--format", default="parquet")
    p = step("monitor")
    p.add_argument("--model", required=True)
    p.add_argument("--mode", choices=["maturity", "snapshot", "customer"], default="maturity")
    p.add_argument("--dpd", type=int, default=30)
    p.add_argument("--mob", type=int, default=1)
    p.add_argument("--dates", nargs="*", help="label months to compute; the report keeps the others")
    p.add_argument("--format", default="parquet")
    return top


def run(spark, args: argparse.Namespace) -> None:
    if args.step == "bronze":
        for table in args.tables.split(","):
            layers.bronze(spark, f"{args.data}/{table}.csv", table, args.root, args.dates)
    elif args.step == "silver":
        for table in args.tables.split(","):
            layers.silver(spark, table, args.root, args.dates, args.only_new, sweep=args.sweep, only_changed=args.only_changed)
    elif args.step == "profile":
        for table in args.tables.split(","):
            layers.profile_report(spark, args.root, table, exact=args.exact)
    elif args.step == "applications":
        layers.application_table(spark, args.root, args.choice, args.first, args.last)
    elif args.step == "features":
        layers.feature_table(spark, args.root, args.asof, args.strict, dates=args.dates, only_new=args.only_new)
    elif args.step == "state":
        layers.customer_state(spark, args.root, args.through)
    elif args.step == "categories":
        layers.categories(spark, args.root, args.asof, args.top, refit=True)
    elif args.step == "ever-default":
        layers.ever_default_table(spark, args.root, args.asof, args.dpd, args.mob)
    elif args.step == "labels":
        layers.label_table(spark, args.root, args.dpd, args.mob, args.dates)
    elif args.step == "train":
        trials = args.trials or {"lr": 10, "gbt": 100}[args.kind]
        layers.train(spark, args.root, args.snapshotdate, args.kind, dpd=args.dpd, mob=args.mob, n_trials=trials, select=args.select, balanced=args.balanced)
    elif args.step == "score":
        layers.score(spark, args.root, args.model, args.dates, args.format)
    elif args.step == "monitor":
        layers.monitor(spark, args.root, args.model, args.mode, args.mob, args.format, args.dpd, args.dates)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"riskflow-{args.step}")
    try:
        run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
