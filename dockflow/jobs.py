"""Batch jobs for ``spark-submit`` (or ``python -m dockflow.jobs``).

* ``clean``   raw CSV (or ZIP archives) -> curated Parquet, plus the
  data-quality funnel written as CSV next to the results.
* ``analyze`` curated Parquet -> one CSV per core analysis (``--all``: every
  report query) from the one-scan report, optionally a folder of ``*.sql``
  files run over the ``trips`` view.
* ``lake``    the two lake questions (monthly trips, top draining stations)
  against any Hadoop-compatible URI.
* ``land``    incremental landing: new ZIP archives -> raw zone (``--landing``),
  then new raw files -> cleaned rides appended to the curated zone; both are
  catch-up streams with checkpoints under ``--checkpoint``, so a re-run only
  processes what arrived since; the curated zone then equals cleaning all files.

Cluster settings come from ``spark-submit``; ``--local`` builds a local
session for a laptop run.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):  # run as a script (spark-submit dockflow/jobs.py ...)
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from dockflow.operators import analyses, flows  # noqa: E402
from dockflow.operators.clean import clean_and_count  # noqa: E402
from dockflow.plans.catalog import run_sql_files  # noqa: E402
from dockflow.plans.rollup import REPORT_QUERIES, run_report  # noqa: E402
from dockflow.session import local_session, scratch_path  # noqa: E402
from dockflow.sources.archives import read_archived_trips  # noqa: E402
from dockflow.sources.curated import read_trips, write_trips  # noqa: E402
from dockflow.sources.raw_csv import month_paths, read_raw_trips  # noqa: E402
from dockflow.sources.results import export_all, export_result, preview, read_result  # noqa: E402
from dockflow.streaming.landing import land_archives, land_trips, run_to_completion  # noqa: E402


def _session(args: argparse.Namespace) -> SparkSession:
    if args.local:
        return local_session(f"dockflow-{args.job}")
    return SparkSession.builder.appName(f"dockflow-{args.job}").getOrCreate()


def clean_job(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.archives:
        raw = read_archived_trips(spark, args.raw, check_header=args.check_header)
    elif args.months:
        raw = read_raw_trips(spark, month_paths(args.raw, args.months), check_header=args.check_header)
    else:
        raw = read_raw_trips(spark, args.raw, check_header=args.check_header)
    # One read of raw: the funnel is counted while the trips are written aside, before they are dealt to months.
    trips, funnel = clean_and_count(raw, scratch_path(spark, "cleaned"), tz=args.tz, blank_names_as_missing=args.blank_names_as_missing)
    out = f"{args.out.rstrip('/')}/quality_funnel"
    export_result(funnel, out)
    preview(read_result(spark, out, funnel.schema))
    write_trips(trips, args.curated)


def analyze_job(spark: SparkSession, args: argparse.Namespace) -> None:
    trips = read_trips(spark, args.curated, months=args.months)
    results = run_report(trips, REPORT_QUERIES if args.all else None, min_activity=args.min_activity)
    if args.sql_dir:
        results.update(run_sql_files(spark, trips, args.sql_dir))
    for name, path in zip(results, export_all(results, args.out), strict=True):  # each result is computed once
        print(f"[{name}]")
        preview(read_result(spark, path, results[name].schema))


def lake_job(spark: SparkSession, args: argparse.Namespace) -> None:
    trips = read_trips(spark, args.curated)
    preview(analyses.monthly_trips(trips))
    preview(flows.top_draining_stations(trips, min_activity=args.min_activity, k=5))


def land_job(spark: SparkSession, args: argparse.Namespace) -> None:
    ckpt = args.checkpoint.rstrip("/")
    if args.landing:
        run_to_completion(land_archives(spark, args.landing, args.raw, f"{ckpt}/archives", check_header=args.check_header))
    run_to_completion(
        land_trips(
            spark,
            args.raw,
            args.curated,
            f"{ckpt}/trips",
            tz=args.tz,
            max_files_per_trigger=args.max_files_per_trigger,
        )
    )


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="dockflow.jobs")
    p.add_argument("job", choices=["clean", "analyze", "lake", "land"])
    p.add_argument("--raw", help="raw CSV folder/glob, or ZIP folder with --archives")
    p.add_argument("--curated", required=True, help="curated Parquet path (any Hadoop-compatible URI)")
    p.add_argument("--out", default="output", help="result folder")
    p.add_argument("--months", nargs="*", help="yyyyMM for raw (clean) or yyyy-MM for curated (analyze)")
    p.add_argument("--archives", action="store_true")
    p.add_argument("--check-header", action="store_true")
    p.add_argument("--blank-names-as-missing", action="store_true")
    p.add_argument("--tz", default=None, help="zone of the raw wall-clock times, for DST-aware durations")
    p.add_argument("--min-activity", type=int, default=flows.DEFAULT_MIN_ACTIVITY)
    p.add_argument("--sql-dir", default=None)
    p.add_argument("--all", action="store_true", help="analyze: every report query, not only the ten core ones")
    p.add_argument("--landing", default=None, help="land: folder of new ZIP archives")
    p.add_argument("--checkpoint", default=None, help="land: checkpoint folder of the landing streams")
    p.add_argument("--max-files-per-trigger", type=int, default=1000, help="land: raw files in one batch")
    p.add_argument("--local", action="store_true")
    args = p.parse_args(argv)
    if args.job in ("clean", "land") and not args.raw:
        p.error(f"{args.job} needs --raw")
    if args.job == "land" and not args.checkpoint:
        p.error("land needs --checkpoint")
    spark = _session(args)
    {"clean": clean_job, "analyze": analyze_job, "lake": lake_job, "land": land_job}[args.job](spark, args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
