"""Table layouts of the trip lakehouse.

Everything in this module is a fixed value: column names, their order and
types must stay exactly as listed so that Bronze, quarantine, Silver and Gold
tables keep the documented layout.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# Bronze trip columns in table order: (target name, target type, source column
# in the landing file, or None for a column that is always a typed NULL).
TRIP_COLUMNS: list[tuple[str, str, str | None]] = [
    ("vendor_name", "string", None),
    ("vendor_id", "int", "VendorID"),
    ("pickup_datetime", "timestamp", "tpep_pickup_datetime"),
    ("dropoff_datetime", "timestamp", "tpep_dropoff_datetime"),
    ("passenger_count", "int", "passenger_count"),
    ("trip_distance", "double", "trip_distance"),
    ("ratecode_id", "int", "RatecodeID"),
    ("store_and_fwd_flag", "string", "store_and_fwd_flag"),
    ("pickup_longitude", "double", None),
    ("pickup_latitude", "double", None),
    ("dropoff_longitude", "double", None),
    ("dropoff_latitude", "double", None),
    ("pulocationid", "int", "PULocationID"),
    ("dolocationid", "int", "DOLocationID"),
    ("payment_type", "int", "payment_type"),
    ("fare_amount", "double", "fare_amount"),
    ("extra", "double", "extra"),
    ("mta_tax", "double", "mta_tax"),
    ("tip_amount", "double", "tip_amount"),
    ("tolls_amount", "double", "tolls_amount"),
    ("improvement_surcharge", "double", "improvement_surcharge"),
    ("congestion_surcharge", "double", "congestion_surcharge"),
    ("airport_fee", "double", "airport_fee"),
    ("total_amount", "double", "total_amount"),
]

# Columns that must be non-NULL for a row to enter Bronze, in reason order.
REQUIRED_COLUMNS: list[str] = [
    "pickup_datetime",
    "dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "pulocationid",
    "dolocationid",
    "fare_amount",
    "total_amount",
]

SCHEMA_FAMILY = "modern"
SILVER_DEFAULT_FAMILY = "yellow_tripdata"
FAILURE_SCHEMA_VIOLATION = "schema_violation"
FAILURE_DUPLICATE = "duplicate_record"
DUPLICATE_REASON = "duplicate business key"

# Landing file names carry the period: yellow_tripdata_YYYY-MM.parquet
LANDING_GLOB = "yellow_tripdata_*.parquet"
LANDING_PATTERN = r"^yellow_tripdata_(\d{4})-(\d{2})\.parquet$"

BRONZE_COLUMNS: list[str] = [name for name, _, _ in TRIP_COLUMNS] + [
    "schema_family",
    "batch_id",
    "source_file",
    "year",
    "month",
    "ingested_at",
]

QUARANTINE_COLUMNS: list[str] = BRONZE_COLUMNS + ["failure_mode", "failure_reason"]

SILVER_COLUMNS: list[str] = [
    "vendor_id",
    "vendor_name",
    "pickup_datetime",
    "dropoff_datetime",
    "trip_duration_minutes",
    "pickup_hour",
    "pickup_day_of_week",
    "is_weekend",
    "passenger_count",
    "trip_distance",
    "ratecode_id",
    "store_and_fwd_flag",
    "pulocationid",
    "dolocationid",
    "payment_type",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
    "total_amount",
    "schema_family",
    "batch_id",
    "year",
    "month",
    "transformed_at",
]

FACT_KEYS: list[str] = [
    "year",
    "month",
    "pickup_hour",
    "pickup_day_of_week",
    "is_weekend",
    "pulocationid",
    "dolocationid",
]

FACT_MEASURES: list[str] = [
    "total_trips",
    "total_passengers",
    "total_distance_miles",
    "avg_distance_miles",
    "avg_duration_minutes",
    "total_fare_amount",
    "total_tip_amount",
    "total_revenue",
    "avg_cost_per_trip",
]

# Business key that identifies a duplicated trip (within one landing period).
DEDUP_KEY: list[str] = [
    "vendor_id",
    "pickup_datetime",
    "dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "pulocationid",
    "dolocationid",
    "fare_amount",
    "total_amount",
]

# Zone lookup CSV header and the dimension names it maps to.
ZONE_LOOKUP_SCHEMA = T.StructType(
    [
        T.StructField("LocationID", T.IntegerType(), True),
        T.StructField("Borough", T.StringType(), True),
        T.StructField("Zone", T.StringType(), True),
        T.StructField("service_zone", T.StringType(), True),
    ]
)
ZONE_RENAMES: dict[str, str] = {
    "LocationID": "location_id",
    "Borough": "borough",
    "Zone": "zone",
    "service_zone": "service_zone",
}
# Dimension columns as they appear on the report frame.
PICKUP_ZONE_RENAMES: dict[str, str] = {
    "borough": "pickup_borough",
    "zone": "pickup_zone",
    "service_zone": "pickup_service_zone",
}

# Drill-down dimensions the monthly trend accepts.
TREND_DIMENSIONS: tuple[str, ...] = ("is_weekend", "pickup_borough", "pickup_day_of_week")

# Run-log: one row per (stage, period) written after the stage's data.
# Only the partition columns: enough to count rows of a table of any layout.
PERIOD_SCHEMA = T.StructType([T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())])

RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("stage", T.StringType(), False),
        T.StructField("year", T.IntegerType(), False),
        T.StructField("month", T.IntegerType(), False),
        T.StructField("rows_written", T.LongType(), True),
        T.StructField("rows_rejected", T.LongType(), True),
        T.StructField("batch_id", T.StringType(), True),
        T.StructField("source_batch_id", T.StringType(), True),
        T.StructField("logged_at", T.TimestampType(), True),
    ]
)



# --- fixed values: column types of the stored tables -------------------------
# Known types let readers skip schema inference (no footer-reading job per
# read) and make a table written with other types fail loudly on read.
_SHORT_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
}
_TRIP_TYPES = {name: kind for name, kind, _ in TRIP_COLUMNS}
_COLUMN_TYPES = {
    **_TRIP_TYPES,
    "schema_family": "string",
    "batch_id": "string",
    "source_file": "string",
    "year": "int",
    "month": "int",
    "ingested_at": "timestamp",
    "failure_mode": "string",
    "failure_reason": "string",
    "trip_duration_minutes": "double",
    "pickup_hour": "int",
    "pickup_day_of_week": "int",
    "is_weekend": "boolean",
    "transformed_at": "timestamp",
    "total_trips": "bigint",
    "total_passengers": "bigint",
    "total_distance_miles": "double",
    "avg_distance_miles": "double",
    "avg_duration_minutes": "double",
    "total_fare_amount": "double",
    "total_tip_amount": "double",
    "total_revenue": "double",
    "avg_cost_per_trip": "double",
    "generated_at": "timestamp",
}
FACT_COLUMNS: list[str] = FACT_KEYS + FACT_MEASURES + ["batch_id", "generated_at"]
DIM_ZONE_SCHEMA = T.StructType(
    [
        T.StructField("location_id", T.IntegerType(), True),
        T.StructField("borough", T.StringType(), True),
        T.StructField("zone", T.StringType(), True),
        T.StructField("service_zone", T.StringType(), True),
    ]
)


def stored_schema(columns: list[str]) -> T.StructType:
    """Read schema of a year/month-partitioned table with these columns."""
    return T.StructType([T.StructField(c, _SHORT_TYPES[_COLUMN_TYPES[c]], True) for c in columns])


BRONZE_SCHEMA = stored_schema(BRONZE_COLUMNS)
QUARANTINE_SCHEMA = stored_schema(QUARANTINE_COLUMNS)
SILVER_SCHEMA = stored_schema(SILVER_COLUMNS)
FACT_SCHEMA = stored_schema(FACT_COLUMNS)
