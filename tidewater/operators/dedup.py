"""Duplicate-record detection, skew-safe.

A duplicate is a row whose business key (within its landing period) was
already seen; the copy with the smallest row identity is kept, every other
copy is routed to quarantine. NULL key values count as equal.

A window ``row_number()`` over the key would send every copy of a hot key to
one task. Instead one grouped aggregate (partial aggregation collapses a hot
key per map task) finds the keys that occur more than once and the first row of
each. Rows are then joined, null-safely, to that set. It is small where
duplicates are few, so Spark broadcasts it by its size and the full rows are
not shuffled at all; a large set is joined by sort and merge, and Spark splits
the hot keys on the rows' side.

The row identity is a ``bigint`` unique within the scope. For landing data
it is the Parquet row index: a landing period has exactly one file (the file
name carries the period), so (year, month, row index) names one row. Being
fixed-width, ``min`` runs as a hash aggregate.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.schemas import DEDUP_KEY

ROW_ID = "_row_id"
DUPLICATE_FLAG = "_is_duplicate"


def file_row_id() -> F.Column:
    """Row index within its Parquet file: stable when a lost task is
    recomputed, unlike ``monotonically_increasing_id``."""
    return F.col("_metadata.row_index")


def repeated_keys(
    rows: DataFrame,
    key: list[str] = DEDUP_KEY,
    scope: list[str] | tuple[str, ...] = ("year", "month"),
    row_id: str = ROW_ID,
) -> DataFrame:
    """(scope, key, ``_first``) of keys that occur more than once, ``_first``
    being the smallest row id."""
    found = rows.groupBy(*scope, *key).agg(F.min(row_id).alias("_first"), F.count(F.lit(1)).alias("_n"))
    return found.where("_n > 1").drop("_n")


def mark_duplicates(
    rows: DataFrame,
    key: list[str] = DEDUP_KEY,
    scope: list[str] | tuple[str, ...] = ("year", "month"),
    row_id: str = ROW_ID,
    materialize: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``rows`` plus a boolean ``_is_duplicate`` column.

    ``materialize`` may write the repeated keys when the caller reuses the
    result for more than one write; a written table also tells Spark its size.
    """
    names = [*scope, *key]
    repeated = repeated_keys(rows, key, scope, row_id)
    if materialize is not None:
        repeated = materialize(repeated)
    other = repeated.select(*[F.col(c).alias(f"_key_{c}") for c in names], "_first")
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in names])
    marked = rows.join(other, same, "left").drop(*[f"_key_{c}" for c in names])
    later = F.col("_first").isNotNull() & (F.col(row_id) != F.col("_first"))
    return marked.withColumn(DUPLICATE_FLAG, later).drop("_first")


def unique_rows(marked: DataFrame) -> DataFrame:
    return marked.filter(~F.col(DUPLICATE_FLAG)).drop(DUPLICATE_FLAG)


def duplicate_rows(marked: DataFrame) -> DataFrame:
    return marked.filter(F.col(DUPLICATE_FLAG)).drop(DUPLICATE_FLAG)
