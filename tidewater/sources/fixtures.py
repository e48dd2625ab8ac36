"""Trip-shaped test data derived from the driver's TPC-H-style tables.

``lineitem`` becomes landing trip records (one per line item), ``nation`` ⋈
``region`` becomes the zone lookup. The expressions are plain SQL that Spark
and DuckDB evaluate identically; the oracle queries in ``__spark_entry__``
repeat them as text. ``l_shipdate`` stands in for the landing file's period.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# --- fixed values: landing columns derived from lineitem ---------------------
# Three landing columns (improvement_surcharge, congestion_surcharge,
# airport_fee) are left out on purpose so normalisation yields typed NULLs.
TRIP_EXPRESSIONS: list[str] = [
    "CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE CAST(l_suppkey % 2 + 1 AS BIGINT) END AS VendorID",
    "l_shipdate + INTERVAL '1' HOUR * (l_partkey % 24) + INTERVAL '1' MINUTE * (l_orderkey % 60)"
    " AS tpep_pickup_datetime",
    "l_shipdate + INTERVAL '1' HOUR * (l_partkey % 24)"
    " + INTERVAL '1' MINUTE * (l_orderkey % 60 + l_orderkey % 90 - 5) AS tpep_dropoff_datetime",
    "CASE WHEN l_orderkey % 89 = 0 THEN NULL ELSE CAST(l_linenumber - 1 AS DOUBLE) END AS passenger_count",
    "CAST(l_discount * 100 AS DOUBLE) AS trip_distance",
    "CAST(l_partkey % 6 + 1 AS DOUBLE) AS RatecodeID",
    "l_returnflag AS store_and_fwd_flag",
    "CASE WHEN l_orderkey % 53 = 0 THEN 0 ELSE CAST((l_partkey % 12 + 1) * 3 AS BIGINT) END AS PULocationID",
    "CASE WHEN l_orderkey % 101 = 0 THEN NULL WHEN l_orderkey % 59 = 0 THEN 0"
    " ELSE CAST(l_partkey % 8 + 1 AS BIGINT) END AS DOLocationID",
    "CAST(l_linenumber % 4 + 1 AS BIGINT) AS payment_type",
    "l_extendedprice / 1000 - 2 AS fare_amount",
    "CAST(0.5 AS DOUBLE) AS extra",
    "CAST(0.5 AS DOUBLE) AS mta_tax",
    "l_tax * 100 AS tip_amount",
    "CAST(0 AS DOUBLE) AS tolls_amount",
    "l_extendedprice / 1000 - 1 + l_tax * 100 AS total_amount",
    "l_shipdate AS shipdate",
]

# Zone lookup in the CSV's own header layout, ids 1-25.
ZONE_EXPRESSIONS: list[str] = [
    "CAST(n_nationkey + 1 AS INT) AS LocationID",
    "r_name AS Borough",
    "n_name AS Zone",
    "CASE WHEN n_nationkey % 2 = 0 THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone",
]

FIXTURE_SOURCE_FILE = "fixture://lineitem"
FIXTURE_BATCH_ID = "fixture-batch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def landing_trips(spark: SparkSession, sf_dir: str, with_row_id: bool = False) -> DataFrame:
    """Landing-layout trips (plus ``shipdate``), one per lineitem row.

    ``with_row_id`` adds ``_row_id``, the row's index in the lineitem file.
    """
    lineitem = table(spark, sf_dir, "lineitem")
    extra = ["_metadata.row_index AS _row_id"]
    return lineitem.selectExpr(*TRIP_EXPRESSIONS, *(extra if with_row_id else []))


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey, "inner")
    return joined.selectExpr(*ZONE_EXPRESSIONS)
