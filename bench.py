"""Benchmark: the lakehouse stages on files and the registered queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Landing files are staged from ``lineitem`` into a fresh scratch folder (not
timed). Timed, in order: ingest (landing → Bronze + quarantine), Silver,
Gold, the dashboard reports over the Gold files, then every registered check
query over the whole tables (executed into Spark's ``noop`` sink so the full
result is computed without shipping it to the driver).

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
"value" is the lakehouse run the reference performs — ingest + Silver + Gold
(all months but the newest) + the dashboard queries over Gold; "queries" has
every timing, including the registered check queries (total:
"checks_total_sec") and the incremental run that follows when the newest month
lands (total: "incremental_run_sec").

``BENCH_LOOP_BASELINE=1`` additionally runs the same stage functions the way a
driver loop schedules them — one ingest per landing file, one Silver and one
Gold job per month — into a second lakehouse, and reports those timings under
"loop_baseline" (not part of "value").
"""

from __future__ import annotations

import json
import os
import re
import shutil
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidewater.plans import bronze, gold, reports, silver  # noqa: E402
from tidewater.plans.catalog import QUERIES, REPORT_YEAR  # noqa: E402
from tidewater.plans.common import LakePaths  # noqa: E402
from tidewater.session import ensure_checkpoint_dir, local_session  # noqa: E402
from tidewater.sources.fixtures import zone_lookup  # noqa: E402
from tools.staging import stage_landing_files  # noqa: E402


WARM_SF_DIR = "/root/testdata/sf0.001"
JOBS: dict[str, int] = {}
WINDOWS: dict[str, tuple[float, float]] = {}


def _timed(results: dict[str, float], name: str, fn, spark=None) -> None:
    if spark is not None:
        spark.sparkContext.setJobGroup(name, name)
    wall = time.time() * 1000
    start = time.perf_counter()
    fn()
    results[name] = round(time.perf_counter() - start, 3)
    WINDOWS[name] = (wall, time.time() * 1000)
    if spark is not None:
        JOBS[name] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
        spark.sparkContext.setJobGroup("other", "other")


def _structure(event_dir: str, paths: LakePaths) -> dict[str, int]:
    """BASELINE's structural figures, measured from this run's event log:
    SQL executions that scan the landing files during ingest (= scans per
    landing file, each scans all pending files once), and write executions
    into Silver / the fact during their stage."""
    from tools.eventlog import events

    executions = []
    for event in events(event_dir):
        if event["Event"].endswith("SparkListenerSQLExecutionStart"):
            executions.append((event["time"], event.get("physicalPlanDescription", "")))

    def count(stage: str, predicate) -> int:
        lo, hi = WINDOWS.get(stage, (0, -1))
        return sum(1 for at, plan in executions if lo <= at <= hi and predicate(plan))

    def writes_to(root: str):
        return lambda plan: "InsertIntoHadoopFsRelationCommand" in plan and root.split(":", 1)[-1] in plan

    return {
        "landing_scans_per_file": count("ingest", lambda plan: paths.landing in plan and "Scan parquet" in plan),
        "silver_write_jobs": count("silver", writes_to(paths.silver)),
        "fact_write_jobs": count("gold", writes_to(paths.fact)),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    match = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(match.group(1)) if match else None

    scratch = tempfile.mkdtemp(prefix="tidewater-bench-")
    spark = local_session(
        cpus,
        shuffle_partitions=cpus * 2,
        app_name="tidewater-bench",
        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": scratch},
    )
    ensure_checkpoint_dir(spark, os.path.join(scratch, "checkpoints"))

    paths = LakePaths.under(os.path.join(scratch, "lake"))
    # every month lands in `arrivals`; all but the newest are copied to the
    # landing zone for the full run, the newest one later for the incremental run
    arrivals = os.path.join(scratch, "arrivals")
    stage_landing_files(spark, sf_dir, arrivals, os.path.join(scratch, "staging"))
    names = sorted(os.listdir(arrivals))
    os.makedirs(paths.landing, exist_ok=True)
    for name in names[:-1]:
        shutil.copyfile(os.path.join(arrivals, name), os.path.join(paths.landing, name))
    os.makedirs(os.path.dirname(paths.lookup), exist_ok=True)
    zone_lookup(spark, sf_dir).toPandas().to_csv(paths.lookup, index=False)
    # warm the JVM (JIT, codegen paths) with an untimed pass over a tiny lake
    warm = LakePaths.under(os.path.join(scratch, "warm"))
    warm_dir = WARM_SF_DIR if os.path.isdir(WARM_SF_DIR) else sf_dir
    stage_landing_files(spark, warm_dir, warm.landing, os.path.join(scratch, "warm_staging"))
    bronze.ingest(spark, warm)
    silver.transform(spark, warm)
    gold.transform(spark, warm)

    times: dict[str, float] = {}
    _timed(times, "ingest", lambda: bronze.ingest(spark, paths), spark)
    _timed(times, "silver", lambda: silver.transform(spark, paths), spark)
    _timed(times, "gold", lambda: gold.transform(spark, paths), spark)

    # steady state: one new month arrives; only it is ingested, transformed and summarised
    shutil.copyfile(os.path.join(arrivals, names[-1]), os.path.join(paths.landing, names[-1]))
    incremental: dict[str, float] = {}
    _timed(incremental, "incremental_ingest", lambda: bronze.ingest(spark, paths))
    _timed(incremental, "incremental_silver", lambda: silver.transform(spark, paths))
    _timed(incremental, "incremental_gold", lambda: gold.transform(spark, paths, only_changed=True))

    loop_times: dict[str, float] = {}
    if os.environ.get("BENCH_LOOP_BASELINE") == "1":
        from tidewater.sources.landing import list_landing_files

        loop = LakePaths.under(os.path.join(scratch, "loop"))
        loop = LakePaths(
            landing=paths.landing, bronze=loop.bronze, quarantine=loop.quarantine, silver=loop.silver,
            gold=loop.gold, run_log=loop.run_log, lookup=paths.lookup, checkpoints=loop.checkpoints,
        )
        files = list_landing_files(spark, paths.landing)
        months = sorted({(f.year, f.month) for f in files})
        # (the loop baseline runs over all months, the newest included)
        _timed(loop_times, "ingest_per_file", lambda: [bronze.ingest_files(spark, [f], loop) for f in files])
        _timed(loop_times, "silver_per_month",
               lambda: [silver.transform(spark, loop, year=y, month=m) for y, m in months])
        _timed(loop_times, "gold_per_month",
               lambda: [gold.transform(spark, loop, year=y, month=m) for y, m in months])

    fact, dim = reports.load_gold(spark, paths)
    _timed(times, "dash_years", lambda: reports.report_years(spark, paths).collect())
    _timed(times, "dash_kpis", lambda: reports.kpis(fact, REPORT_YEAR).collect())
    for drill in ("is_weekend", "pickup_borough", "pickup_day_of_week"):
        _timed(times, f"dash_trend_{drill}", lambda d=drill: reports.trend(fact, dim, REPORT_YEAR, d).collect())
    _timed(times, "dash_borough", lambda: reports.borough_ranking(fact, dim, REPORT_YEAR).collect())
    _timed(times, "dash_hourly", lambda: reports.hourly_profile(fact, REPORT_YEAR).collect())

    headline = sum(times.values())
    checks: dict[str, float] = {}
    for name, query in QUERIES.items():
        _timed(checks, name, lambda q=query: q(spark, sf_dir).write.format("noop").mode("overwrite").save())

    spark.stop()
    event_dirs = [os.path.join(scratch, d) for d in os.listdir(scratch) if d.startswith("eventlog")]
    structure = _structure(event_dirs[0], paths) if event_dirs else {}
    print(
        json.dumps(
            {
                "metric": "lakehouse_run_seconds",
                "value": round(headline, 3),
                "unit": "sec",
                "queries": {**times, **incremental, **checks},
                "incremental_run_sec": round(sum(incremental.values()), 3),
                "checks_total_sec": round(sum(checks.values()), 3),
                "sf": sf,
                "cpus": cpus,
                "landing_files": len(os.listdir(paths.landing)),
                "spark_jobs_per_stage": JOBS,
                "structure": structure,
                **({"loop_baseline": loop_times} if loop_times else {}),
                "scratch": scratch,
            }
        )
    )


if __name__ == "__main__":
    main()
