"""Jobs from the command line: ``load``, ``stream``, ``build``, ``check``, ``run``,
``refresh`` and ``show``.

``build``, ``check`` and ``run`` exit with 1 when a check fails, before anything is published;
``--severity warn`` reports failures and publishes all the same.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import Row, SparkSession

from hitloom.operators.quality import QualityError, gate
from hitloom.operators.star import STAR
from hitloom.operators.summaries import presented
from hitloom.plans.full_run import run
from hitloom.plans.ingest import load_increment
from hitloom.plans.rollup import refresh, summary_tables
from hitloom.plans.warehouse import SUMMARIES, build_checked, check_stored, newest_builds
from hitloom.session import GIB, build_session, size_to_input
from hitloom.sources.folders import folder_bytes
from hitloom.sources.silver import silver_view
from hitloom.streaming.file_ingest import ingest_new_files

MODELS = (*STAR, *SUMMARIES)

# What each job is given, and which of it is read and so sizes the shuffles.
JOBS = {
    "load": (("landing", "silver"), "landing"),
    "stream": (("landing", "silver", "checkpoint"), "landing"),
    "build": (("silver", "warehouse"), "silver"),
    "run": (("landing", "silver", "warehouse"), "landing"),
    "check": (("silver", "warehouse"), "silver"),
    "refresh": (("silver", "rollup"), "silver"),
    "show": (("warehouse", "summary"), None),
}


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="hitloom", description=__doc__)
    parser.add_argument("--input-gib", type=int,
                        help="log text to read, for sizing; else the size of the folder read")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name, (places, _) in JOBS.items():
        job = jobs.add_parser(name)
        for place in places:
            job.add_argument(place, choices=sorted(SUMMARIES) if place == "summary" else None)
        if name == "stream":
            job.add_argument("--dedup-across-batches", action="store_true")
            job.add_argument("--max-files", type=int, help="log files per batch")
        if name == "load":
            job.add_argument("--keep-late", action="store_true",
                             help="load rows older than silver's latest too")
            job.add_argument("--quarantine", action="store_true",
                             help="count and keep lines that cannot be read in full")
        if name == "build":
            job.add_argument("--only", nargs="+", metavar="MODEL", choices=sorted(MODELS),
                             help="these models and what they are made from")
        if name in ("build", "run", "check"):
            job.add_argument("--severity", choices=("error", "warn"), default="error",
                             help="what a failed check is")
        if name == "run":
            job.add_argument("--stream", metavar="CHECKPOINT",
                             help="bring in new files only, remembered in this folder")
    return parser


def size_session(spark: SparkSession, args: argparse.Namespace) -> None:
    """Settings for the size given, or for that of the folder the job reads."""
    read = JOBS[args.job][1]
    if args.input_gib:
        size_to_input(spark, args.input_gib * GIB)
    elif read:
        size_to_input(spark, folder_bytes(spark, getattr(args, read)))


def _print_checks(rows: list[Row]) -> None:
    for row in rows:
        print(*(row[c] for c in ("check", "table", "column", "failures")),
              "ok" if row["passed"] else "FAILED")


def main(arguments: list[str] | None = None) -> int:
    args = _parser().parse_args(arguments)
    spark = build_session()
    size_session(spark, args)
    try:
        if args.job == "load":
            print(load_increment(spark, args.landing, args.silver, args.keep_late,
                                 args.quarantine))
        elif args.job == "stream":
            print(ingest_new_files(
                spark, args.landing, args.silver, args.checkpoint,
                dedup_across_batches=args.dedup_across_batches,
                max_files_per_trigger=args.max_files,
            ))
        elif args.job == "build":
            silver = silver_view(spark, args.silver)
            _, checks, published = build_checked(silver, args.warehouse, args.severity,
                                                 only=args.only)
            _print_checks(checks)
            published.show(100, truncate=False)
        elif args.job == "check":
            checks = check_stored(silver_view(spark, args.silver), args.warehouse)
            gate(checks, args.severity)
            _print_checks(checks)
        elif args.job == "refresh":
            for day in refresh(spark, args.silver, args.rollup):
                print(*day)
            for name, table in summary_tables(spark, args.rollup).items():
                print(name)
                presented(table, name).show(1000, truncate=False)
        elif args.job == "show":
            place = newest_builds(spark, args.warehouse, [args.summary])[args.summary]
            table = spark.read.parquet(place)
            presented(table, args.summary).show(1000, truncate=False)
        else:
            result = run(spark, args.landing, args.silver, args.warehouse, args.stream,
                         args.severity)
            print(result.rows_by_stage)
            _print_checks(result.checks)
            result.published.show(100, truncate=False)
    except QualityError as error:
        _print_checks(error.failed)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
