"""Gold fact: trips summarised by period, hour, weekday and origin/destination."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.schemas import FACT_KEYS


def aggregate_fact(silver: DataFrame) -> DataFrame:
    """GROUP BY the seven fact keys with the nine measures.

    All measures are decomposable, so Spark runs a partial aggregate before
    the shuffle: a hot key (one location holding a third of all trips) is
    reduced to one row per map task and never lands whole in one task.

    ``total_trips`` counts non-NULL vendors (not rows) and the averages divide
    by their own non-NULL inputs, as the fact has always defined them.
    """
    # fixed values: names, order and definitions of the nine stored measures
    return silver.groupBy(*FACT_KEYS).agg(
        F.count("vendor_id").alias("total_trips"),
        F.sum("passenger_count").alias("total_passengers"),
        F.sum("trip_distance").alias("total_distance_miles"),
        F.avg("trip_distance").alias("avg_distance_miles"),
        F.avg("trip_duration_minutes").alias("avg_duration_minutes"),
        F.sum("fare_amount").alias("total_fare_amount"),
        F.sum("tip_amount").alias("total_tip_amount"),
        F.sum("total_amount").alias("total_revenue"),
        F.avg("total_amount").alias("avg_cost_per_trip"),
    )


def stamp_fact(fact: DataFrame, batch_id: str | Column, generated_at: Column | None = None) -> DataFrame:
    batch = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    stamp = generated_at if generated_at is not None else F.current_timestamp()
    return fact.withColumns(
        {"batch_id": batch.cast("string"), "generated_at": stamp.cast("timestamp")}
    )
