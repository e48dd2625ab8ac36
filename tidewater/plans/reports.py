"""Report queries over the Gold star schema: DataFrame in, DataFrame out. The
result column names are fixed values.

Each report returns a small, already aggregated frame; the caller collects it.
Reports that need the zone name pre-aggregate the fact per pickup location
*before* the join (a few hundred rows), instead of joining every fact row;
sums are associative and the join maps each location to exactly its
dimension rows, so the result is the same as aggregating the joined frame.
Reports that need no zone column read the fact alone (the dimension is
checked to have unique ``location_id`` when it is built, so the left join
neither adds nor drops fact rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import guarded_ratio, zero_if_null
from tidewater.operators.zones import with_pickup_zone
from tidewater.plans.common import LakePaths
from tidewater.schemas import BRONZE_SCHEMA, DIM_ZONE_SCHEMA, FACT_SCHEMA, QUARANTINE_SCHEMA, SILVER_SCHEMA, TREND_DIMENSIONS
from tidewater.sources.tables import period_dirs, read_table


def report_frame(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """fact ⟕ dim: fact columns plus pickup_borough / pickup_zone /
    pickup_service_zone."""
    return with_pickup_zone(fact, dim)


def select_year(fact: DataFrame, year: int | None = None) -> DataFrame:
    """Rows of ``year``; ``None`` selects the newest year present.

    For a frame, the newest year is found in the plan (a one-row aggregate,
    semi-joined). That reads the year of every row, so over a stored fact pass
    the year that :func:`newest_year` finds from the directories: a literal
    prunes all other years' files.
    """
    if year is not None:
        return fact.filter(F.col("year") == F.lit(int(year)))
    newest = fact.agg(F.max("year").alias("year"))
    return fact.join(newest, "year", "left_semi")


def stored_years(spark: SparkSession, paths: LakePaths) -> list[int]:
    """The years the stored fact holds, newest first, from its directories."""
    return sorted({year for year, _ in period_dirs(spark, paths.fact)}, reverse=True)


def newest_year(spark: SparkSession, paths: LakePaths) -> int | None:
    """The newest year the stored fact holds, from its directories."""
    return next(iter(stored_years(spark, paths)), None)


def report_years(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """Distinct years of the stored fact, newest first: one row per year, from the
    table's directories; no file is opened."""
    return spark.createDataFrame([(year,) for year in stored_years(spark, paths)], "year int")


def available_years(fact: DataFrame) -> DataFrame:
    """Distinct years of a frame, newest first; for a stored fact see
    :func:`report_years`."""
    return fact.select("year").distinct().orderBy(F.desc("year"))


def kpis(fact: DataFrame, year: int | None = None) -> DataFrame:
    """One row: trips, revenue, passengers, tips and tip per trip.

    Missing totals (no rows for the year) become 0; tip per trip is 0.0 when
    there are no trips.
    """
    totals = select_year(fact, year).agg(
        F.sum("total_trips").alias("total_trips"),
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("total_passengers").alias("total_passengers"),
        F.sum("total_tip_amount").alias("total_tip_amount"),
    )
    trips = zero_if_null(F.col("total_trips"), 0)
    tips = zero_if_null(F.col("total_tip_amount"), 0.0)
    return totals.select(
        trips.alias("total_trips"),
        zero_if_null(F.col("total_revenue"), 0.0).alias("total_revenue"),
        zero_if_null(F.col("total_passengers"), 0).alias("total_passengers"),
        tips.alias("total_tip_amount"),
        guarded_ratio(tips, trips, when_zero=0.0).alias("avg_tip"),
    )


def _per_pickup_location(fact: DataFrame, by: list[str], measures: dict[str, str]) -> DataFrame:
    return fact.groupBy(*by, "pulocationid").agg(
        *[F.sum(source).alias(alias) for alias, source in measures.items()]
    )


def trend(
    fact: DataFrame,
    dim: DataFrame,
    year: int | None = None,
    drill_down: str = "is_weekend",
) -> DataFrame:
    """Trips per month split by one drill-down dimension, by month."""
    if drill_down not in TREND_DIMENSIONS:
        raise ValueError(f"drill_down must be one of {TREND_DIMENSIONS}, got {drill_down!r}")
    selected = select_year(fact, year)
    if drill_down == "pickup_borough":
        per_location = _per_pickup_location(selected, ["month"], {"total_trips": "total_trips"})
        selected = with_pickup_zone(per_location, dim)
    return (
        selected.groupBy("month", drill_down)
        .agg(F.sum("total_trips").alias("total_trips"))
        .orderBy("month", drill_down)
    )


def borough_ranking(
    fact: DataFrame,
    dim: DataFrame,
    year: int | None = None,
) -> DataFrame:
    """Revenue and trips per pickup borough (NULL = unknown zone), highest
    revenue first."""
    per_location = _per_pickup_location(
        select_year(fact, year), [], {"total_revenue": "total_revenue", "total_trips": "total_trips"}
    )
    zoned = with_pickup_zone(per_location, dim)
    return (
        zoned.groupBy("pickup_borough")
        .agg(F.sum("total_revenue").alias("total_revenue"), F.sum("total_trips").alias("total_trips"))
        .orderBy(F.desc("total_revenue"))
    )


def hourly_profile(fact: DataFrame, year: int | None = None) -> DataFrame:
    """Trips, summed distance and distance per trip by pickup hour.

    Distance per trip is sum-then-divide (not an average of averages); NULL
    when an hour has no counted trips.
    """
    return (
        select_year(fact, year)
        .groupBy("pickup_hour")
        .agg(
            F.sum("total_trips").alias("total_trips"),
            F.sum("total_distance_miles").alias("sum_distance"),
        )
        .withColumn("avg_distance", guarded_ratio(F.col("sum_distance"), F.col("total_trips")))
        .orderBy("pickup_hour")
    )


def load_gold(spark: SparkSession, paths: LakePaths) -> tuple[DataFrame, DataFrame]:
    """(fact, dim) from a lakehouse's Gold tables; ``year``/``month`` of the
    fact come from its partition directories, so year filters prune files.

    Without a dimension table (no lookup was ever provided) an empty one is
    used: every pickup zone is then unknown, reported as a NULL borough.
    """
    fact = read_table(spark, paths.fact, FACT_SCHEMA)
    if fact is None:
        raise FileNotFoundError(f"no Gold fact table at {paths.fact}; run the gold stage first")
    dim = read_table(spark, paths.dim_zone, DIM_ZONE_SCHEMA)
    if dim is None:
        dim = spark.createDataFrame([], DIM_ZONE_SCHEMA)
    return fact, dim


def register_views(spark: SparkSession, paths: LakePaths) -> list[str]:
    """Temp views for SQL users: ``trips_bronze``, ``trips_quarantine``,
    ``trips_silver``, ``fact_trip_summary``, ``dim_taxi_zone`` and
    ``trip_report`` (fact ⟕ zone). Views over tables that do not exist yet are
    skipped; the registered names are returned."""
    tables = {
        "trips_bronze": (paths.bronze, BRONZE_SCHEMA),
        "trips_quarantine": (paths.schema_violations, QUARANTINE_SCHEMA),
        "trips_silver": (paths.silver, SILVER_SCHEMA),
        "fact_trip_summary": (paths.fact, FACT_SCHEMA),
        "dim_taxi_zone": (paths.dim_zone, DIM_ZONE_SCHEMA),
    }
    frames = {}
    for name, (root, schema) in tables.items():
        frame = read_table(spark, root, schema)
        if frame is not None:
            frame.createOrReplaceTempView(name)
            frames[name] = frame
    if "fact_trip_summary" in frames and "dim_taxi_zone" in frames:
        report_frame(frames["fact_trip_summary"], frames["dim_taxi_zone"]).createOrReplaceTempView("trip_report")
        frames["trip_report"] = None
    return sorted(frames)
