"""Command line: run the pipeline or query its tables.

    python -m wardflow --root /shared/hospital run --dims
    python -m wardflow --root /shared/hospital schedule --every "5 minutes"
    python -m wardflow --root /shared/hospital sql "SELECT * FROM kpi_doctor_workload"
"""

from __future__ import annotations

import argparse
import datetime as dt

from wardflow.domains import DOMAINS
from wardflow.session import build_session
from wardflow.sources.csv_drop import file_inventory
from wardflow.sources.warehouse import Warehouse
from wardflow.streaming.ingest import ingest_available, start_ingest
from wardflow.streaming.pipeline import refresh_dimensions, run_pipeline, start_schedule


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="wardflow")
    parser.add_argument("--root", required=True, help="folder all executors share")
    parser.add_argument("--drops", help="folder holding one CSV folder per domain (default <root>/drops)")
    parser.add_argument("--master", help="Spark master, if spark-submit does not set it")
    commands = parser.add_subparsers(dest="command", required=True)

    ingest = commands.add_parser("ingest", help="take new files into the landing tables")
    ingest.add_argument("--every", help="keep running, looking for files this often")

    run = commands.add_parser("run", help="one run of the whole pipeline")
    run.add_argument("--dims", action="store_true", help="refresh the dimensions too")
    run.add_argument("--strict", action="store_true", help="log rows no rule can decide")
    run.add_argument("--as-of", type=dt.date.fromisoformat, help="date of the dimension versions")

    schedule = commands.add_parser("schedule", help="run the pipeline periodically")
    schedule.add_argument("--every", default="5 minutes")
    schedule.add_argument("--dims", action="store_true")

    dims = commands.add_parser("dims", help="refresh the dimensions")
    dims.add_argument("--as-of", type=dt.date.fromisoformat)
    dims.add_argument("--only-changed", action="store_true", help="new versions for real changes only")

    files = commands.add_parser("files", help="list the files of a drop folder")
    files.add_argument("domain", choices=list(DOMAINS))

    reset = commands.add_parser("reset", help="empty a landing table, to load its files again")
    reset.add_argument("domain", choices=list(DOMAINS))

    sql = commands.add_parser("sql", help="query the published tables and views")
    sql.add_argument("statement")
    sql.add_argument("--role", help="see personal columns as this role may")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = build_session(master=args.master)
    drops = {d: f"{args.drops}/{d}" for d in DOMAINS} if args.drops else {}
    wh = Warehouse(spark, args.root, drops)
    if args.command == "ingest" and args.every:
        queries = [start_ingest(wh, name, every=args.every) for name in DOMAINS]
        if any(queries):
            spark.streams.awaitAnyTermination()
    elif args.command == "ingest":
        ingest_available(wh)
    elif args.command == "run":
        print(run_pipeline(wh, dims=args.dims, as_of=args.as_of, strict=args.strict).status)
    elif args.command == "schedule":
        start_schedule(wh, every=args.every, dims=args.dims).awaitTermination()
    elif args.command == "dims":
        refresh_dimensions(wh, args.as_of, only_changed=args.only_changed)
    elif args.command == "files":
        file_inventory(spark, wh.drop_folder(args.domain)).show(truncate=False)
    elif args.command == "reset":
        wh.reset_landing(args.domain)
    elif args.command == "sql":
        wh.register_views(role=args.role)
        spark.sql(args.statement).show(truncate=False)


if __name__ == "__main__":
    main()
