"""The lakehouse stages as one lazy plan over the driver's test tables.

Landing trips come from ``lineitem`` and the zone lookup from ``nation`` ⋈
``region`` (see :mod:`tidewater.sources.fixtures`). Each function returns the
frame a stage would write, without writing it, so every stage's logic can be
checked against an independent SQL engine on the whole tables. The stage
functions used here are the same ones the file-based stages call.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.dedup import ROW_ID, mark_duplicates
from tidewater.operators.enrich import clean_and_enrich, silver_projection
from tidewater.operators.fact import aggregate_fact, stamp_fact
from tidewater.operators.normalize import normalize_trips
from tidewater.operators.split import valid_rows
from tidewater.operators.zones import zone_dimension
from tidewater.sources.fixtures import (
    FIXTURE_BATCH_ID,
    FIXTURE_SOURCE_FILE,
    landing_trips,
    zone_lookup,
)

# Audit timestamps differ on every run; fixture flows carry a fixed one and
# the checks leave these columns out.
AUDIT_COLUMNS = ("ingested_at", "transformed_at", "generated_at")


def _fixed_stamp():
    return F.lit("2000-01-01 00:00:00").cast("timestamp")


def normalized(spark: SparkSession, sf_dir: str, landing: DataFrame | None = None) -> DataFrame:
    """All landing rows in the Bronze layout plus the violation reason."""
    raw = landing if landing is not None else landing_trips(spark, sf_dir)
    carry = [ROW_ID] if ROW_ID in raw.columns else []
    return normalize_trips(
        raw,
        period_year=F.year("shipdate"),
        period_month=F.month("shipdate"),
        source_file=F.lit(FIXTURE_SOURCE_FILE),
        batch_id=FIXTURE_BATCH_ID,
        ingested_at=_fixed_stamp(),
        carry=carry,
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_rows(normalized(spark, sf_dir)).drop("schema_violation_reason")


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_projection(clean_and_enrich(bronze(spark, sf_dir)), FIXTURE_BATCH_ID, _fixed_stamp())


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamp_fact(aggregate_fact(silver(spark, sf_dir)), FIXTURE_BATCH_ID, _fixed_stamp())


def dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_dimension(zone_lookup(spark, sf_dir))


def landing_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing rows plus an exact second copy of every six-passenger trip.

    Each branch gets its own row identity (2 × source row index + copy
    number), so the copies are distinguishable the way re-delivered rows at
    different positions are.
    """
    base = landing_trips(spark, sf_dir, with_row_id=True)

    def tag(frame: DataFrame, copy: int) -> DataFrame:
        return frame.withColumn(ROW_ID, F.col(ROW_ID) * 2 + F.lit(copy))

    copies = base.filter(F.col("passenger_count") == 6)
    return tag(base, 0).unionByName(tag(copies, 1))


def dedup_marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid rows of the landing-with-copies data, marked duplicate or not."""
    rows = valid_rows(normalized(spark, sf_dir, landing_with_copies(spark, sf_dir)))
    return mark_duplicates(rows)


def done_before(periods: DataFrame, year: int) -> DataFrame:
    """A done-set for the incremental checks: every period before ``year``."""
    return periods.filter(F.col("year") < F.lit(year))


def without_audit(frame: DataFrame) -> DataFrame:
    return frame.drop(*[c for c in AUDIT_COLUMNS if c in frame.columns])


# Trip attributes stored as int that may hold NULLs; check views carry them as
# double so every client library maps them to the same type (a NULL-bearing
# int column otherwise arrives as float from one engine and as a nullable
# integer from the other).
NULLABLE_TRIP_INTS = ("vendor_id", "passenger_count", "ratecode_id", "pulocationid", "dolocationid", "payment_type")
TIME_TEXT = "yyyy-MM-dd HH:mm:ss"


def stable_doubles(frame: DataFrame, scale: int = 6) -> DataFrame:
    """Doubles normalised for cross-engine comparison: snapped to 9 decimals
    (absorbs summation-order noise), rounded half-up to ``scale`` as an
    exact decimal, back to double. The oracle SQL applies the same steps."""
    out = []
    for field in frame.schema.fields:
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            expr = F.round(F.col(field.name).try_cast("decimal(38,9)"), scale).cast("double")
            out.append(expr.alias(field.name))
        else:
            out.append(F.col(field.name))
    return frame.select(*out)


def comparable_trips(frame: DataFrame) -> DataFrame:
    """Trip-level check view: stable doubles, NULL-bearing int attributes as
    double, timestamps as ``yyyy-MM-dd HH:mm:ss`` text (the same value in any
    client, whatever its timestamp unit). The oracle SQL does the same.
    Integers become doubles after the rounding step: they are exact already."""
    rounded = stable_doubles(frame)
    out = []
    for field in rounded.schema.fields:
        name = field.name
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            out.append(F.date_format(F.col(name), TIME_TEXT).alias(name))
        elif name in NULLABLE_TRIP_INTS:
            out.append(F.col(name).cast("double").alias(name))
        else:
            out.append(F.col(name))
    return rounded.select(*out)
