"""Period sets for incremental runs: what landed, what is done, what is left.

Periods are (year, month) pairs; a few hundred at most, so these joins are
cheap, and Spark broadcasts them by its own size estimate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PERIOD = ["year", "month"]


def period_set(frame: DataFrame) -> DataFrame:
    return frame.select(*[F.col(c).cast("int").alias(c) for c in PERIOD]).distinct()


def pending_periods(landed: DataFrame, done: DataFrame) -> DataFrame:
    """Landed periods not yet done (left anti join)."""
    return period_set(landed).join(period_set(done), PERIOD, "left_anti")


def missing_periods(requested: DataFrame, existing: DataFrame) -> DataFrame:
    """Requested periods that have no data (left anti join)."""
    return period_set(requested).join(period_set(existing), PERIOD, "left_anti")


def available_periods(requested: DataFrame, existing: DataFrame) -> DataFrame:
    """Requested periods that do have data (left semi join)."""
    return period_set(requested).join(period_set(existing), PERIOD, "left_semi")


def period_filter(periods: list[tuple[int, int]]) -> F.Column:
    """Predicate on the partition columns selecting exactly ``periods``.

    Built from literals so the planner prunes partitions before listing
    files; the list is small (one entry per month).
    """
    codes = sorted({int(y) * 100 + int(m) for y, m in periods})
    if not codes:
        return F.lit(False)
    return (F.col("year") * 100 + F.col("month")).isin(codes)


def select_period(year: int | None, month: int | None) -> list[tuple[int, int]] | None:
    """Both given → that one month; otherwise (even if one is given) → all."""
    if year is not None and month is not None:
        return [(int(year), int(month))]
    return None
