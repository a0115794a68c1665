"""Command line: ``python -m marmita update --source ... --root ...``, also through spark-submit."""

from __future__ import annotations

import argparse

from marmita import jobs
from marmita.operators.maintenance import TARGET_FILE_BYTES
from marmita.session import build_session
from marmita.sources.generator import Volume
from marmita.streaming.runner import Lakehouse


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="marmita")
    jobs_of = parser.add_subparsers(dest="job", required=True)

    generate = jobs_of.add_parser("generate", help="archive synthetic batches")
    generate.add_argument("--target", required=True)
    generate.add_argument("--batches", type=int, required=True)
    generate.add_argument("--first", type=int, default=0)
    for name, default in (("clients", 1), ("restaurants", 1), ("drivers", 1), ("items-per-restaurant", 8),
                          ("orders", 8), ("seed", 0)):
        generate.add_argument(f"--{name}", type=int, default=default)

    update = jobs_of.add_parser("update", help="bring bronze, silver and gold up to date")
    update.add_argument("--source", required=True)
    update.add_argument("--root", required=True)
    update.add_argument("--source-format", default="parquet")
    update.add_argument("--max-files", help="files per micro-batch")
    update.add_argument("--validate-first", action="store_true")
    update.add_argument("--dedup", choices=("arrival", "state"), default="arrival")
    update.add_argument("--dedup-orders", action="store_true")
    update.add_argument("--keep-rejected", action="store_true")

    cost = jobs_of.add_parser("cost", help="cost tables from saved replies")
    cost.add_argument("--responses", required=True)
    cost.add_argument("--subscription", required=True)
    cost.add_argument("--schema", default="observability")
    cost.add_argument("--lookback-days", type=int, default=30)

    governance = jobs_of.add_parser("governance", help="tags and masked views")
    governance.add_argument("--schema", default="default")
    governance.add_argument("--governance-schema", default="governance")

    maintenance = jobs_of.add_parser("maintenance", help="rewrite small files: TABLE=FOLDER ...")
    maintenance.add_argument("tables", nargs="+")
    maintenance.add_argument("--target-root", required=True)
    maintenance.add_argument("--target-bytes", type=int, default=TARGET_FILE_BYTES)

    compact = jobs_of.add_parser("compact", help="rewrite the days of a lakehouse that consist of several files")
    compact.add_argument("--root", required=True)
    compact.add_argument("--schema", help="schema whose catalog tables follow")

    retention = jobs_of.add_parser("retention", help="remove the days of a lakehouse that are too old")
    retention.add_argument("--root", required=True)
    retention.add_argument("--as-of", required=True, help="day, such as 2024-12-31")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = build_session(f"marmita-{args.job}")
    if args.job == "generate":
        volume = Volume(args.clients, args.restaurants, args.drivers, args.items_per_restaurant, args.orders, args.seed)
        jobs.run_generate(spark, args.target, args.batches, args.first, volume=volume)
    elif args.job == "update":
        options = {"maxFilesPerTrigger": args.max_files} if args.max_files else {}
        house = jobs.run_update(
            spark, args.root, args.source, source_format=args.source_format, validate_first=args.validate_first,
            dedup=args.dedup, dedup_orders=args.dedup_orders, keep_rejected=args.keep_rejected,
            source_options=options)
        for table, progress in house.progress.items():
            print(table, progress)
    elif args.job == "cost":
        jobs.run_cost(spark, args.responses, args.subscription, args.schema, args.lookback_days).show(100, False)
    elif args.job == "governance":
        print(jobs.run_governance(spark, args.schema, args.governance_schema))
    elif args.job == "compact":
        print(jobs.run_live_maintenance(Lakehouse(spark, args.root, ""), args.schema))
    elif args.job == "retention":
        print(jobs.run_retention(Lakehouse(spark, args.root, ""), args.as_of))
    else:
        tables = dict(pair.split("=", 1) for pair in args.tables)
        print(jobs.run_maintenance(spark, tables, args.target_root, args.target_bytes))


if __name__ == "__main__":
    main()
