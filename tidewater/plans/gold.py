"""Silver → Gold star schema: zone dimension and trip-summary fact.

The fact is always recomputed for the selected months (all months, or one
requested month) in a single job: partial aggregation before the shuffle on
the seven keys, final aggregation, then a rebalance on (year, month) of the
small aggregated rows so each month is written as a few AQE-sized files and a
month holding a large share of trips is split rather than sent to one task.
With ``only_changed`` only the months are recomputed whose Silver batch is not
the one their fact was made from.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.fact import aggregate_fact, stamp_fact
from tidewater.operators.periods import select_period
from tidewater.operators.zones import zone_dimension
from tidewater.plans.common import (
    LakePaths,
    StageState,
    batch_timestamp,
    logger,
    new_batch_id,
    stage_state,
)
from tidewater.schemas import SILVER_SCHEMA
from tidewater.sinks.writers import log_run, write_lookup, write_partitioned
from tidewater.sources.tables import drop_periods, read_periods, read_zone_lookup, run_log_summary

STAGE = "gold"


@dataclass
class GoldResult:
    batch_id: str
    partitions_processed: int = 0
    periods: list[tuple[int, int]] = field(default_factory=list)
    missing: list[tuple[int, int]] = field(default_factory=list)
    stale: list[tuple[int, int]] = field(default_factory=list)
    dimension_built: bool = False
    duration_sec: float = 0.0


def build_fact(silver: DataFrame, batch_id: str | Column, generated_at: Column | None = None) -> DataFrame:
    """Pure transform: Silver rows → fact rows (7 keys, 9 measures, stamps)."""
    return stamp_fact(aggregate_fact(silver), batch_id, generated_at)


def build_dimension(spark: SparkSession, lookup_path: str, gold_dim_path: str) -> bool:
    """Zone lookup CSV → ``dim_taxi_zone`` (full overwrite).

    Returns False (and logs a warning) when the lookup file does not exist.
    Raises ``ValueError`` when a needed column is absent, and when a
    ``location_id`` occurs twice: the reports rely on it being unique (a
    duplicate would multiply fact rows). Rows without an id join no trip and
    may occur any number of times.
    """
    try:
        dim = zone_dimension(read_zone_lookup(spark, lookup_path))
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            logger.warning("gold: lookup file %s missing, dim_taxi_zone not built", lookup_path)
            return False
        raise
    twice = dim.where("location_id IS NOT NULL").groupBy("location_id").count().where("count > 1").agg(F.min("location_id"))
    example = twice.first()[0]
    if example is not None:
        raise ValueError(f"zone lookup has duplicate location_id {example}")
    write_lookup(dim, gold_dim_path)
    return True


def changed_periods(spark: SparkSession, paths: LakePaths, state: StageState) -> set[tuple[int, int]]:
    """Source months whose stored fact was not made from the Silver batch that
    the month now holds: never summarised, written by another batch since, or
    of unknown batch. No clocks are compared."""
    mine = run_log_summary(spark, paths.run_log).get(STAGE, {})
    return {
        p
        for p in state.source
        if p not in state.stored
        or p not in mine
        or state.source_batches.get(p) is None
        or mine[p].source_batch_id != state.source_batches[p]
    }


def transform(
    spark: SparkSession,
    paths: LakePaths,
    year: int | None = None,
    month: int | None = None,
    batch_id: str | None = None,
    layout: str = "rebalance",
    only_changed: bool = False,
) -> GoldResult:
    """Build the dimension (if the lookup exists) and recompute the fact.

    By default every selected month is recomputed (a month's fact depends
    only on that month's Silver rows, so this is idempotent). With
    ``only_changed`` a month is recomputed only when Silver holds another batch
    of it than its fact was made from. A requested month that Silver does not
    hold is reported in ``missing``. Fact months that Silver no longer holds are
    removed and reported in ``stale``: all of them in a run over every month,
    the requested one in a run for one month.
    """
    start = time.time()
    active_batch = batch_id or new_batch_id("gold-")
    result = GoldResult(active_batch)
    if paths.lookup:
        result.dimension_built = build_dimension(spark, paths.lookup, paths.dim_zone)

    state = stage_state(spark, paths, STAGE, paths.fact, "silver", paths.silver)
    source, stale = set(state.source), state.stored - state.source
    requested = select_period(year, month)
    if requested is not None:
        result.missing = sorted(set(requested) - source)
        for y, m in result.missing:
            logger.warning("gold: partition year=%d/month=%d not found in Silver", y, m)
        source &= set(requested)
        stale &= set(requested)
    if stale:
        result.stale = sorted(stale)
        logger.warning("gold: removing the fact of months that Silver no longer holds: %s", result.stale)
        drop_periods(spark, paths.fact, stale)
    if only_changed:
        source &= changed_periods(spark, paths, state)
    periods = sorted(source)
    result.periods = periods
    silver = read_periods(spark, paths.silver, periods, SILVER_SCHEMA) if periods else None
    if silver is None:
        logger.warning("gold: no partitions found to process")
        result.periods = []
        result.duration_sec = time.time() - start
        return result

    fact = build_fact(silver, active_batch, batch_timestamp())
    write_partitioned(fact, paths.fact, layout=layout)
    log_run(spark, paths.run_log, STAGE, {p: (None, None) for p in periods}, active_batch, state.source_batches)
    result.partitions_processed = len(periods)
    result.duration_sec = time.time() - start
    return result
