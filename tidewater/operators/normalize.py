"""Unify a landing frame to the Bronze layout (plus the violation reason)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import resolve_source_columns, safe_value, violation_reason
from tidewater.schemas import REQUIRED_COLUMNS, SCHEMA_FAMILY, TRIP_COLUMNS

REASON_COLUMN = "schema_violation_reason"


def normalize_trips(
    frame: DataFrame,
    *,
    period_year: Column,
    period_month: Column,
    source_file: Column,
    batch_id: str | Column,
    ingested_at: Column | None = None,
    schema_family: str = SCHEMA_FAMILY,
    carry: list[str] | None = None,
) -> DataFrame:
    """One ``select`` from a landing frame to the Bronze columns.

    Present source columns are cast to the target type (``try_cast``), absent
    ones become typed NULLs, extra ones are dropped. The period comes from the
    caller (the file name in ingestion), not from the pickup time. ``carry``
    lists helper columns passed through unchanged (e.g. a row identity).
    The result has the 30 Bronze columns, ``schema_violation_reason`` and the
    carried columns.
    """
    available = resolve_source_columns(frame.columns)
    source_types = dict(frame.dtypes)
    batch = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    stamp = ingested_at if ingested_at is not None else F.current_timestamp()
    trip_columns = [
        safe_value(available, source, data_type, source_types).alias(name)
        for name, data_type, source in TRIP_COLUMNS
    ]
    normalized = frame.select(
        *trip_columns,
        F.lit(schema_family).alias("schema_family"),
        batch.cast("string").alias("batch_id"),
        source_file.cast("string").alias("source_file"),
        period_year.cast("int").alias("year"),
        period_month.cast("int").alias("month"),
        stamp.cast("timestamp").alias("ingested_at"),
        *[F.col(name) for name in (carry or [])],
    )
    return normalized.withColumn(REASON_COLUMN, violation_reason(REQUIRED_COLUMNS))
