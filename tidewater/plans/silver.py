"""Bronze → Silver: one job over all pending months.

Pending = months whose Bronze directory holds data (optionally one requested
month) less Silver's done months: those Silver holds, and those logged to have
had no valid rows, unless Bronze has since been written by another batch. Only
the pending months' directories are read; columns are resolved by name against
each file, so the rows of a file without ``schema_family`` get its default,
whatever the other files hold, and a differently typed column is cast. The cleansing rules reach the Parquet scan as pushed
filters; the output is written beside the table and put in place at the end, by
default without a shuffle (each scan task writes the month it read). Months that
another run is transforming are left to it.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession

from tidewater.operators.enrich import clean_and_enrich, silver_projection
from tidewater.operators.periods import select_period
from tidewater.plans.claims import claimed
from tidewater.plans.common import (
    LakePaths,
    StageState,
    batch_timestamp,
    logger,
    new_batch_id,
    stage_state,
    table_counts,
)
from tidewater.schemas import BRONZE_SCHEMA, PERIOD_SCHEMA, SILVER_DEFAULT_FAMILY
from tidewater.sinks.publish import publish, recover, stage_months
from tidewater.sinks.writers import log_run
from tidewater.sources.tables import read_resolved

STAGE = "silver"
#: What a column stands for in the rows of a file that does not have it.
ABSENT = {"schema_family": SILVER_DEFAULT_FAMILY}


@dataclass
class SilverResult:
    batch_id: str
    partitions_processed: int = 0
    periods: list[tuple[int, int]] = field(default_factory=list)
    missing: list[tuple[int, int]] = field(default_factory=list)
    skipped: list[tuple[int, int]] = field(default_factory=list)
    busy: list[tuple[int, int]] = field(default_factory=list)
    rows_written: int = 0
    job_duration_sec: float = 0.0


def build_silver(bronze: DataFrame, batch_id: str | Column, transformed_at: Column | None = None) -> DataFrame:
    """Pure transform: Bronze rows → Silver rows (29 columns)."""
    return silver_projection(clean_and_enrich(bronze), batch_id, transformed_at)


def plan_periods(
    spark: SparkSession,
    paths: LakePaths,
    year: int | None,
    month: int | None,
    force: bool = False,
) -> tuple[list[tuple[int, int]], list[tuple[int, int]], list[tuple[int, int]], StageState]:
    """(pending, missing, skipped) periods for this run, and the stage's state.

    Period sets hold at most one entry per month and are combined on the
    driver. With ``force`` done months are transformed again.
    """
    state = stage_state(spark, paths, STAGE, paths.silver, "bronze", paths.bronze)
    source = set(state.source)
    requested = select_period(year, month)
    missing: list[tuple[int, int]] = []
    if requested is not None:
        missing = sorted(set(requested) - source)
        for y, m in missing:
            logger.warning("silver: partition year=%d/month=%d not found in Bronze", y, m)
        source &= set(requested)
    done = set() if force else state.done
    return sorted(source - done), missing, sorted(source & done), state


def transform(
    spark: SparkSession,
    paths: LakePaths,
    year: int | None = None,
    month: int | None = None,
    batch_id: str | None = None,
    layout: str = "scan",
    force: bool = False,
) -> SilverResult:
    """Transform every pending Bronze month (or the one month requested). A
    requested month that Bronze does not hold is reported in ``missing``."""
    start = time.time()
    active_batch = batch_id or new_batch_id("silver-")
    wanted, missing, skipped, _ = plan_periods(spark, paths, year, month, force)
    result = SilverResult(active_batch, missing=missing, skipped=skipped)
    if wanted:
        with claimed(spark, paths, STAGE, wanted, active_batch) as mine:
            result.busy = sorted(set(wanted) - set(mine))
            recover(spark, paths.silver, mine)
            # a run that held them before may have finished some
            pending, _, _, state = plan_periods(spark, paths, year, month, force)
            result.periods = sorted(set(pending) & set(mine))
            _transform_claimed(spark, paths, result, state, layout)
    if not result.partitions_processed:
        logger.warning("silver: no partitions to process")
    result.job_duration_sec = time.time() - start
    return result


def _transform_claimed(spark: SparkSession, paths: LakePaths, result: SilverResult, state: StageState, layout: str) -> None:
    pending = result.periods
    bronze = read_resolved(spark, paths.bronze, pending, BRONZE_SCHEMA, ABSENT) if pending else None
    if bronze is None:
        return
    silver = build_silver(bronze, result.batch_id, batch_timestamp())
    staged = stage_months(silver, paths.silver, pending, layout)
    publish(spark, staged)
    read = table_counts(spark, {"read": (paths.bronze, PERIOD_SCHEMA)}, pending)["read"]
    counts = {p: (staged.rows[p], read[p] - staged.rows[p]) for p in pending}
    log_run(spark, paths.run_log, STAGE, counts, result.batch_id, state.source_batches)
    result.partitions_processed = len(pending)
    result.rows_written = sum(staged.rows.values())
