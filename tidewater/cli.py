"""Command line: ``python -m tidewater <stage> --root ... [options]``.

Stages: ``ingest``, ``silver``, ``gold``, ``run`` (all three), ``report``
(the dashboard queries as JSON lines) and ``stream`` (file-stream ingest).
Under ``spark-submit`` the cluster's session settings apply; only the session
time zone is pinned (calendar features depend on it).
"""

from __future__ import annotations

import argparse
import json
import logging
from dataclasses import asdict, is_dataclass

from pyspark.sql import SparkSession

from tidewater.plans import bronze, gold, reports, silver
from tidewater.plans.common import LakePaths
from tidewater.plans.orchestrate import RunConfig, optional_int, optional_str, run
from tidewater.schemas import TREND_DIMENSIONS


def _paths(args: argparse.Namespace) -> LakePaths:
    base = LakePaths.under(args.root, lookup=args.lookup_file)
    overrides = {k: getattr(args, f"{k}_dir") for k in ("landing", "bronze", "quarantine", "silver", "gold")}
    return LakePaths(
        **{k: (v or getattr(base, k)) for k, v in overrides.items()},
        run_log=args.run_log_dir or base.run_log,
        lookup=base.lookup,
        checkpoints=base.checkpoints,
    )


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tidewater", description="Trip-record lakehouse on Spark")
    parser.add_argument("stage", choices=["ingest", "silver", "gold", "run", "report", "stream"])
    parser.add_argument("--root", required=True, help="lakehouse root (any Hadoop URI)")
    for name in ("landing", "bronze", "quarantine", "silver", "gold", "run-log"):
        parser.add_argument(f"--{name}-dir", default=None)
    parser.add_argument("--lookup-file", default=None)
    parser.add_argument("--batch-id", default=None)
    parser.add_argument("--year", default=None)
    parser.add_argument("--month", default=None)
    parser.add_argument("--dedup", action="store_true", help="quarantine duplicate trips")
    parser.add_argument("--retries", type=int, default=1, help="run: more attempts at a stage that fails")
    parser.add_argument("--retry-delay", type=float, default=300.0, help="run: seconds before the next attempt")
    parser.add_argument("--force", action="store_true", help="ingest and transform done months again")
    parser.add_argument(
        "--only-changed",
        action="store_true",
        help="gold: recompute only the months whose Silver batch is not the one their fact was made from",
    )
    parser.add_argument("--drill-down", default="is_weekend", choices=TREND_DIMENSIONS)
    parser.add_argument("--checkpoint", default=None, help="stream checkpoint location")
    parser.add_argument("--app-name", default="tidewater")
    return parser


def _emit(value) -> None:
    print(json.dumps(asdict(value) if is_dataclass(value) else value, default=str))


def main(argv: list[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    args = build_parser().parse_args(argv)
    spark = (
        SparkSession.builder.appName(args.app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    paths = _paths(args)
    year, month, batch = optional_int(args.year), optional_int(args.month), optional_str(args.batch_id)
    try:
        if args.stage == "ingest":
            _emit(bronze.ingest(spark, paths, batch_id=batch, dedup=args.dedup, force=args.force))
        elif args.stage == "silver":
            _emit(silver.transform(spark, paths, year=year, month=month, batch_id=batch, force=args.force))
        elif args.stage == "gold":
            _emit(gold.transform(spark, paths, year=year, month=month, batch_id=batch, only_changed=args.only_changed))
        elif args.stage == "run":
            cfg = RunConfig(
                paths=paths, batch_id=batch, year=year, month=month, dedup=args.dedup,
                only_changed_gold=args.only_changed, force=args.force,
                retries=args.retries, retry_delay_sec=args.retry_delay,
            )
            _emit({k: asdict(v) for k, v in run(spark, cfg).items()})
        elif args.stage == "report":
            fact, dim = reports.load_gold(spark, paths)
            year = reports.newest_year(spark, paths) if year is None else year
            outputs = {
                "years": reports.report_years(spark, paths),
                "kpis": reports.kpis(fact, year),
                "trend": reports.trend(fact, dim, year, args.drill_down),
                "borough": reports.borough_ranking(fact, dim, year),
                "hourly": reports.hourly_profile(fact, year),
            }
            for name, frame in outputs.items():
                _emit({name: [row.asDict() for row in frame.collect()]})
        elif args.stage == "stream":
            from tidewater.streaming.landing_stream import ingest_stream

            ckpt = args.checkpoint or f"{args.root.rstrip('/')}/_checkpoints/landing_stream"
            query, progress = ingest_stream(spark, paths, ckpt, dedup=args.dedup)
            query.awaitTermination()
            _emit({"records_processed": progress.records_processed, "batches": progress.batches})
    finally:
        spark.stop()
