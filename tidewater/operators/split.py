"""Valid / invalid split of normalized rows and the two output layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import all_required_present, any_required_missing
from tidewater.operators.normalize import REASON_COLUMN
from tidewater.schemas import (
    BRONZE_COLUMNS,
    FAILURE_SCHEMA_VIOLATION,
    QUARANTINE_COLUMNS,
    REQUIRED_COLUMNS,
)


def valid_rows(normalized: DataFrame) -> DataFrame:
    """Rows with every required column present (reason is empty)."""
    return normalized.filter(all_required_present(REQUIRED_COLUMNS))


def invalid_rows(normalized: DataFrame) -> DataFrame:
    """Rows with at least one required column missing (reason non-empty).

    Together with :func:`valid_rows` an exact partition of the input.
    """
    return normalized.filter(any_required_missing(REQUIRED_COLUMNS))


def bronze_projection(frame: DataFrame, *, keep: list[str] | None = None) -> DataFrame:
    """The 30 Bronze columns in table order (plus ``keep`` helpers)."""
    return frame.select(*BRONZE_COLUMNS, *(keep or []))


def quarantine_projection(
    frame: DataFrame,
    failure_mode: str = FAILURE_SCHEMA_VIOLATION,
    failure_reason=None,
) -> DataFrame:
    """The 32 quarantine columns: Bronze plus failure mode and reason."""
    reason = failure_reason if failure_reason is not None else F.col(REASON_COLUMN)
    return frame.withColumns(
        {
            "failure_mode": F.lit(failure_mode),
            "failure_reason": reason if not isinstance(reason, str) else F.lit(reason),
        }
    ).select(*QUARANTINE_COLUMNS)


def schema_violations(normalized: DataFrame) -> DataFrame:
    return quarantine_projection(invalid_rows(normalized))


def bronze_rows(normalized: DataFrame) -> DataFrame:
    return bronze_projection(valid_rows(normalized))
