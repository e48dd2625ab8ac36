"""Partitioned Parquet writes and the run-log.

Every stage writes with *dynamic* partition overwrite: only the
``year=Y/month=M`` partitions present in the output are replaced, all others
stay. Re-running a stage for a period therefore replaces that period's files
instead of appending a second copy, which makes every stage idempotent.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.periods import PERIOD
from tidewater.schemas import RUN_LOG_SCHEMA

# Output file layout of a partitioned write.
#   "scan":      no shuffle; each scan task writes the periods it read.
#                Files follow the input split size (spark.sql.files.maxPartitionBytes).
#   "rebalance": AQE-sized files per period (one shuffle, splits hot periods).
LAYOUTS = ("scan", "rebalance")


def laid_out(frame: DataFrame, layout: str, partition_by: list[str] | tuple[str, ...] = tuple(PERIOD)) -> DataFrame:
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    return frame.hint("rebalance", *partition_by) if layout == "rebalance" else frame


def counted(frame: DataFrame, n_periods: int) -> tuple[DataFrame, Callable[[], dict[tuple[int, int], int]]]:
    """``frame``, observed, and a function that gives its rows per month once it has
    been written: the counts are made in the write itself, without another job.

    The observed aggregate is a frequent-items sketch, which is exact while it
    tracks more items than occur; it tracks at least twice the months. Observe the
    frame that is written, after its last exchange: then a task that runs again
    after a lost executor is counted once.
    """
    observed = Observation()
    tracked = max(1024, 1 << (2 * n_periods).bit_length())
    months = F.expr(f"to_json(approx_top_k(year * 100 + month, {max(1, n_periods)}, {tracked}))")

    def read() -> dict[tuple[int, int], int]:
        return {divmod(int(r["item"]), 100): int(r["count"]) for r in json.loads(observed.get["months"] or "[]")}

    return frame.observe(observed, months.alias("months")), read


def write_partitioned(
    frame: DataFrame,
    root: str,
    partition_by: list[str] | tuple[str, ...] = tuple(PERIOD),
    layout: str = "scan",
) -> None:
    frame = laid_out(frame, layout, partition_by)
    (
        frame.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(root)
    )


def write_lookup(frame: DataFrame, path: str) -> None:
    """Full overwrite of an unpartitioned table, in files of the size that AQE
    aims at: one file for a lookup table."""
    frame.hint("rebalance").write.mode("overwrite").parquet(path)


def log_run(
    spark: SparkSession,
    root: str,
    stage: str,
    counts: dict[tuple[int, int], tuple[int | None, int | None]],
    batch_id: str,
    source_batches: dict[tuple[int, int], str | None] | None = None,
) -> None:
    """Record (rows written, rows rejected) and the batch read, per period.

    The log is partitioned by stage, year and month and written after the
    stage's data with dynamic partition overwrite: it holds one row per stage
    and month however often the stages run, and runs of different stages or
    months touch different partitions."""
    stamp, sources = datetime.now(timezone.utc), source_batches or {}
    rows = [
        (stage, year, month, written, rejected, batch_id, sources.get((year, month)), stamp)
        for (year, month), (written, rejected) in sorted(counts.items())
    ]
    if rows:
        write_partitioned(spark.createDataFrame(rows, RUN_LOG_SCHEMA).coalesce(1), root, ("stage", *PERIOD))
