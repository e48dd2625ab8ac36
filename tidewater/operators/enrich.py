"""Bronze → Silver: cleansing rules, duration and calendar features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import (
    cleansing_rules,
    day_of_week,
    duration_minutes,
    hour_of_day,
    passes_cleansing,
    weekend_flag,
)
from tidewater.schemas import SILVER_COLUMNS, SILVER_DEFAULT_FAMILY


def add_trip_features(frame: DataFrame) -> DataFrame:
    """Duration in minutes, pickup hour, weekday (Sun=1) and weekend flag."""
    pickup = F.col("pickup_datetime")
    return frame.withColumns(
        {
            "trip_duration_minutes": duration_minutes(pickup, F.col("dropoff_datetime")),
            "pickup_hour": hour_of_day(pickup),
            "pickup_day_of_week": day_of_week(pickup),
        }
    ).withColumn("is_weekend", weekend_flag(F.col("pickup_day_of_week")))


def clean_and_enrich(bronze: DataFrame) -> DataFrame:
    """Apply the cleansing rules, add features, keep positive durations.

    The rules are plain comparisons on stored columns, so they become
    PushedFilters of the Bronze scan. Rejected rows are dropped, not kept.
    """
    cleaned = bronze.filter(passes_cleansing())
    return add_trip_features(cleaned).filter(F.col("trip_duration_minutes") > 0.0)


def silver_projection(
    frame: DataFrame, batch_id: str | Column, transformed_at: Column | None = None
) -> DataFrame:
    """The 29 Silver columns; ``batch_id`` is replaced by the Silver batch."""
    if "schema_family" not in frame.columns:
        frame = frame.withColumn("schema_family", F.lit(SILVER_DEFAULT_FAMILY))
    batch = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    stamp = transformed_at if transformed_at is not None else F.current_timestamp()
    return frame.withColumns(
        {"batch_id": batch.cast("string"), "transformed_at": stamp.cast("timestamp")}
    ).select(*SILVER_COLUMNS)


def rule_failure_counts(bronze: DataFrame, by: list[str]) -> DataFrame:
    """Per group: Bronze rows, rows failing each rule (NULL counts as failing)
    and rows that reach Silver. One pass, one partial + final aggregate."""
    rules = cleansing_rules()
    featured = add_trip_features(bronze)
    duration_ok = F.col("trip_duration_minutes") > 0.0
    measures = [F.count(F.lit(1)).alias("bronze_rows")]
    measures += [
        F.count_if(~F.coalesce(rule, F.lit(False))).alias(f"fail_{name}")
        for name, rule in rules.items()
    ]
    measures.append(F.count_if(~F.coalesce(duration_ok, F.lit(False))).alias("fail_duration"))
    measures.append(
        F.count_if(F.coalesce(passes_cleansing() & duration_ok, F.lit(False))).alias("silver_rows")
    )
    return featured.groupBy(*by).agg(*measures)
