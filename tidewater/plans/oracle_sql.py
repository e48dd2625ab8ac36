"""Independent SQL for every registered check query (DuckDB dialect).

Written by hand from the stage definitions, not generated from the Spark
plans. Tables ``lineitem nation region orders`` are views over the same
Parquet files. Doubles go through ``STABLE(x)`` = snap to 9 decimals, round
half-up to 6, back to double, the same steps the Spark side applies.

DuckDB spellings that differ from Spark: ``dayofweek`` starts at 0 (Sunday),
``hour``/``dayofweek`` are BIGINT, ``CAST(double AS INT)`` rounds (so TRUNC
first), ``SUM(int)`` is HUGEINT (cast to BIGINT).
"""

from __future__ import annotations

# --- fixed values: the test-data derivation, as SQL text ---------------------
RAW_SELECT = """
SELECT CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE CAST(l_suppkey % 2 + 1 AS BIGINT) END AS VendorID,
  l_shipdate + INTERVAL '1' HOUR * (l_partkey % 24) + INTERVAL '1' MINUTE * (l_orderkey % 60) AS tpep_pickup_datetime,
  l_shipdate + INTERVAL '1' HOUR * (l_partkey % 24) + INTERVAL '1' MINUTE * (l_orderkey % 60 + l_orderkey % 90 - 5) AS tpep_dropoff_datetime,
  CASE WHEN l_orderkey % 89 = 0 THEN NULL ELSE CAST(l_linenumber - 1 AS DOUBLE) END AS passenger_count,
  CAST(l_discount * 100 AS DOUBLE) AS trip_distance,
  CAST(l_partkey % 6 + 1 AS DOUBLE) AS RatecodeID, l_returnflag AS store_and_fwd_flag,
  CASE WHEN l_orderkey % 53 = 0 THEN 0 ELSE CAST((l_partkey % 12 + 1) * 3 AS BIGINT) END AS PULocationID,
  CASE WHEN l_orderkey % 101 = 0 THEN NULL WHEN l_orderkey % 59 = 0 THEN 0
       ELSE CAST(l_partkey % 8 + 1 AS BIGINT) END AS DOLocationID,
  CAST(l_linenumber % 4 + 1 AS BIGINT) AS payment_type,
  l_extendedprice / 1000 - 2 AS fare_amount, CAST(0.5 AS DOUBLE) AS extra, CAST(0.5 AS DOUBLE) AS mta_tax,
  l_tax * 100 AS tip_amount, CAST(0 AS DOUBLE) AS tolls_amount,
  l_extendedprice / 1000 - 1 + l_tax * 100 AS total_amount, l_shipdate AS shipdate
FROM lineitem
"""

DIM_SELECT = """
SELECT CAST(n_nationkey + 1 AS INT) AS location_id, r_name AS borough, n_name AS zone,
  CASE WHEN n_nationkey % 2 = 0 THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone
FROM nation JOIN region ON n_regionkey = r_regionkey
"""

# Normalisation of a landing relation {src} to the Bronze layout + reason.
NORM_TEMPLATE = """
SELECT *,
  trim(concat_ws(', ',
    CASE WHEN pickup_datetime IS NULL THEN 'pickup_datetime' END,
    CASE WHEN dropoff_datetime IS NULL THEN 'dropoff_datetime' END,
    CASE WHEN passenger_count IS NULL THEN 'passenger_count' END,
    CASE WHEN trip_distance IS NULL THEN 'trip_distance' END,
    CASE WHEN pulocationid IS NULL THEN 'pulocationid' END,
    CASE WHEN dolocationid IS NULL THEN 'dolocationid' END,
    CASE WHEN fare_amount IS NULL THEN 'fare_amount' END,
    CASE WHEN total_amount IS NULL THEN 'total_amount' END)) AS schema_violation_reason
FROM (
  SELECT CAST(NULL AS VARCHAR) AS vendor_name,
    TRY_CAST(VendorID AS INTEGER) AS vendor_id,
    TRY_CAST(tpep_pickup_datetime AS TIMESTAMP) AS pickup_datetime,
    TRY_CAST(tpep_dropoff_datetime AS TIMESTAMP) AS dropoff_datetime,
    TRY_CAST(TRUNC(passenger_count) AS INTEGER) AS passenger_count,
    TRY_CAST(trip_distance AS DOUBLE) AS trip_distance,
    TRY_CAST(TRUNC(RatecodeID) AS INTEGER) AS ratecode_id,
    TRY_CAST(store_and_fwd_flag AS VARCHAR) AS store_and_fwd_flag,
    CAST(NULL AS DOUBLE) AS pickup_longitude,
    CAST(NULL AS DOUBLE) AS pickup_latitude,
    CAST(NULL AS DOUBLE) AS dropoff_longitude,
    CAST(NULL AS DOUBLE) AS dropoff_latitude,
    TRY_CAST(PULocationID AS INTEGER) AS pulocationid,
    TRY_CAST(DOLocationID AS INTEGER) AS dolocationid,
    TRY_CAST(payment_type AS INTEGER) AS payment_type,
    TRY_CAST(fare_amount AS DOUBLE) AS fare_amount,
    TRY_CAST(extra AS DOUBLE) AS extra,
    TRY_CAST(mta_tax AS DOUBLE) AS mta_tax,
    TRY_CAST(tip_amount AS DOUBLE) AS tip_amount,
    TRY_CAST(tolls_amount AS DOUBLE) AS tolls_amount,
    CAST(NULL AS DOUBLE) AS improvement_surcharge,
    CAST(NULL AS DOUBLE) AS congestion_surcharge,
    CAST(NULL AS DOUBLE) AS airport_fee,
    TRY_CAST(total_amount AS DOUBLE) AS total_amount,
    'modern' AS schema_family,
    'fixture-batch' AS batch_id,
    'fixture://lineitem' AS source_file,
    CAST(year(shipdate) AS INTEGER) AS year,
    CAST(month(shipdate) AS INTEGER) AS month
  FROM {src}
) n
"""

BRONZE_COLS = """vendor_name, vendor_id, pickup_datetime, dropoff_datetime, passenger_count,
  trip_distance, ratecode_id, store_and_fwd_flag, pickup_longitude, pickup_latitude,
  dropoff_longitude, dropoff_latitude, pulocationid, dolocationid, payment_type, fare_amount,
  extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, congestion_surcharge,
  airport_fee, total_amount, schema_family, batch_id, source_file, year, month"""

RULES = """passenger_count > 0 AND trip_distance > 0 AND fare_amount >= 0
  AND total_amount >= 0 AND pulocationid > 0 AND dolocationid > 0"""

DURATION = """(CAST(floor(epoch(dropoff_datetime)) AS BIGINT)
  - CAST(floor(epoch(pickup_datetime)) AS BIGINT)) / CAST(60 AS DOUBLE)"""

BASE_CTES = f"""
WITH raw AS ({RAW_SELECT}),
norm AS ({NORM_TEMPLATE.format(src="raw")}),
bronze AS (SELECT {BRONZE_COLS} FROM norm WHERE schema_violation_reason = ''),
silver_base AS (
  SELECT *, {DURATION} AS trip_duration_minutes,
    CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
    CAST(dayofweek(pickup_datetime) + 1 AS INTEGER) AS pickup_day_of_week
  FROM bronze WHERE {RULES}
),
silver AS (
  SELECT vendor_id, vendor_name, pickup_datetime, dropoff_datetime, trip_duration_minutes,
    pickup_hour, pickup_day_of_week, pickup_day_of_week IN (1, 7) AS is_weekend,
    passenger_count, trip_distance, ratecode_id, store_and_fwd_flag, pulocationid, dolocationid,
    payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge,
    congestion_surcharge, airport_fee, total_amount, schema_family, batch_id, year, month
  FROM silver_base WHERE trip_duration_minutes > 0
),
fact AS (
  SELECT year, month, pickup_hour, pickup_day_of_week, is_weekend, pulocationid, dolocationid,
    COUNT(vendor_id) AS total_trips,
    CAST(SUM(passenger_count) AS BIGINT) AS total_passengers,
    SUM(trip_distance) AS total_distance_miles,
    AVG(trip_distance) AS avg_distance_miles,
    AVG(trip_duration_minutes) AS avg_duration_minutes,
    SUM(fare_amount) AS total_fare_amount,
    SUM(tip_amount) AS total_tip_amount,
    SUM(total_amount) AS total_revenue,
    AVG(total_amount) AS avg_cost_per_trip,
    'fixture-batch' AS batch_id
  FROM silver
  GROUP BY year, month, pickup_hour, pickup_day_of_week, is_weekend, pulocationid, dolocationid
),
dim AS ({DIM_SELECT})
"""

DEDUP_CTES = f"""
WITH raw AS ({RAW_SELECT}),
raw2 AS (SELECT * FROM raw UNION ALL SELECT * FROM raw WHERE passenger_count = 6),
norm2 AS ({NORM_TEMPLATE.format(src="raw2")}),
ranked AS (
  SELECT {BRONZE_COLS},
    row_number() OVER (PARTITION BY year, month, vendor_id, pickup_datetime, dropoff_datetime,
      passenger_count, trip_distance, pulocationid, dolocationid, fare_amount, total_amount) AS rn
  FROM norm2 WHERE schema_violation_reason = ''
)
"""


def stable(expr: str) -> str:
    return f"CAST(ROUND(TRY_CAST({expr} AS DECIMAL(38,9)), 6) AS DOUBLE)"


def _stable_all(columns: list[str]) -> str:
    return ", ".join(f"{stable(c)} AS {c}" for c in columns)


TRIP_INTS = ["vendor_id", "passenger_count", "ratecode_id", "pulocationid", "dolocationid", "payment_type"]
TRIP_TIMES = ["pickup_datetime", "dropoff_datetime"]


def _trip_view(doubles: list[str]) -> str:
    """REPLACE list of a trip-level check view: stable doubles, NULL-bearing
    int attributes as double, timestamps as text."""
    parts = [f"{stable(c)} AS {c}" for c in doubles]
    parts += [f"CAST({c} AS DOUBLE) AS {c}" for c in TRIP_INTS]
    parts += [f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in TRIP_TIMES]
    return ", ".join(parts)


TRIP_DOUBLES = [
    "trip_distance", "pickup_longitude", "pickup_latitude", "dropoff_longitude",
    "dropoff_latitude", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "congestion_surcharge", "airport_fee", "total_amount",
]
FACT_DOUBLES = [
    "total_distance_miles", "avg_distance_miles", "avg_duration_minutes", "total_fare_amount",
    "total_tip_amount", "total_revenue", "avg_cost_per_trip",
]
SILVER_DOUBLES = ["trip_duration_minutes"] + [
    c for c in TRIP_DOUBLES if not c.endswith(("longitude", "latitude"))
]

RULE_COUNTS = f"""
SELECT year, month,
  COUNT(*) AS bronze_rows,
  COUNT(*) FILTER (WHERE NOT coalesce(passenger_count > 0, FALSE)) AS fail_passenger_count,
  COUNT(*) FILTER (WHERE NOT coalesce(trip_distance > 0, FALSE)) AS fail_trip_distance,
  COUNT(*) FILTER (WHERE NOT coalesce(fare_amount >= 0, FALSE)) AS fail_fare_amount,
  COUNT(*) FILTER (WHERE NOT coalesce(total_amount >= 0, FALSE)) AS fail_total_amount,
  COUNT(*) FILTER (WHERE NOT coalesce(pulocationid > 0, FALSE)) AS fail_pulocationid,
  COUNT(*) FILTER (WHERE NOT coalesce(dolocationid > 0, FALSE)) AS fail_dolocationid,
  COUNT(*) FILTER (WHERE NOT coalesce({DURATION} > 0, FALSE)) AS fail_duration,
  COUNT(*) FILTER (WHERE coalesce({RULES} AND {DURATION} > 0, FALSE)) AS silver_rows
FROM bronze GROUP BY year, month
"""

ORDER_PERIODS = """SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year,
  CAST(month(o_orderdate) AS INTEGER) AS month FROM orders"""

ORACLE: dict[str, str] = {
    "bronze_normalized": BASE_CTES
    + f"SELECT * REPLACE ({_trip_view(TRIP_DOUBLES)}) FROM norm",
    "violation_reason_counts": BASE_CTES
    + "SELECT schema_violation_reason, COUNT(*) AS row_count FROM norm GROUP BY schema_violation_reason",
    "bronze_clean": BASE_CTES + f"SELECT * REPLACE ({_trip_view(TRIP_DOUBLES)}) FROM bronze",
    "quarantine_schema": BASE_CTES
    + f"""SELECT {BRONZE_COLS}, 'schema_violation' AS failure_mode,
      schema_violation_reason AS failure_reason
    FROM (SELECT * REPLACE ({_trip_view(TRIP_DOUBLES)}) FROM norm) q
    WHERE schema_violation_reason <> ''""",
    "ingest_counts": BASE_CTES
    + """SELECT year, month,
      COUNT(*) FILTER (WHERE schema_violation_reason = '') AS clean_records,
      COUNT(*) FILTER (WHERE schema_violation_reason <> '') AS violations
    FROM norm GROUP BY year, month""",
    "silver_rule_counts": BASE_CTES + RULE_COUNTS,
    "silver_trips": BASE_CTES + f"SELECT * REPLACE ({_trip_view(SILVER_DOUBLES)}) FROM silver",
    "dim_zone": BASE_CTES + "SELECT * FROM dim",
    "gold_fact_trip_summary": BASE_CTES
    + f"SELECT * REPLACE ({_stable_all(FACT_DOUBLES)}) FROM fact",
    "gold_fact_month": BASE_CTES
    + f"SELECT * REPLACE ({_stable_all(FACT_DOUBLES)}) FROM fact WHERE year = 1998 AND month = 3",
    "fact_enriched": BASE_CTES
    + f"""SELECT f.* REPLACE ({_stable_all(FACT_DOUBLES)}),
      d.borough AS pickup_borough, d.zone AS pickup_zone, d.service_zone AS pickup_service_zone
    FROM fact f LEFT JOIN dim d ON f.pulocationid = d.location_id""",
    "report_years": BASE_CTES + "SELECT DISTINCT year FROM fact",
    "report_kpis": BASE_CTES
    + f"""SELECT CAST(coalesce(SUM(total_trips), 0) AS BIGINT) AS total_trips,
      {stable("coalesce(SUM(total_revenue), 0.0)")} AS total_revenue,
      CAST(coalesce(SUM(total_passengers), 0) AS BIGINT) AS total_passengers,
      {stable("coalesce(SUM(total_tip_amount), 0.0)")} AS total_tip_amount,
      {stable("CASE WHEN coalesce(SUM(total_trips), 0) > 0 THEN coalesce(SUM(total_tip_amount), 0.0) / SUM(total_trips) ELSE 0.0 END")} AS avg_tip
    FROM fact WHERE year = 1998""",
    "report_kpis_newest": BASE_CTES
    + f"""SELECT CAST(coalesce(SUM(total_trips), 0) AS BIGINT) AS total_trips,
      {stable("coalesce(SUM(total_revenue), 0.0)")} AS total_revenue,
      CAST(coalesce(SUM(total_passengers), 0) AS BIGINT) AS total_passengers,
      {stable("coalesce(SUM(total_tip_amount), 0.0)")} AS total_tip_amount,
      {stable("CASE WHEN coalesce(SUM(total_trips), 0) > 0 THEN coalesce(SUM(total_tip_amount), 0.0) / SUM(total_trips) ELSE 0.0 END")} AS avg_tip
    FROM fact WHERE year = (SELECT MAX(year) FROM fact)""",
    "report_kpis_empty": BASE_CTES
    + f"""SELECT CAST(coalesce(SUM(total_trips), 0) AS BIGINT) AS total_trips,
      {stable("coalesce(SUM(total_revenue), 0.0)")} AS total_revenue,
      CAST(coalesce(SUM(total_passengers), 0) AS BIGINT) AS total_passengers,
      {stable("coalesce(SUM(total_tip_amount), 0.0)")} AS total_tip_amount,
      {stable("CASE WHEN coalesce(SUM(total_trips), 0) > 0 THEN coalesce(SUM(total_tip_amount), 0.0) / SUM(total_trips) ELSE 0.0 END")} AS avg_tip
    FROM fact WHERE year = 1990""",
    "report_trend_weekend": BASE_CTES
    + """SELECT month, is_weekend, CAST(SUM(total_trips) AS BIGINT) AS total_trips
    FROM fact WHERE year = 1998 GROUP BY month, is_weekend""",
    "report_trend_borough": BASE_CTES
    + """SELECT f.month, d.borough AS pickup_borough, CAST(SUM(f.total_trips) AS BIGINT) AS total_trips
    FROM fact f LEFT JOIN dim d ON f.pulocationid = d.location_id
    WHERE f.year = 1998 GROUP BY f.month, d.borough""",
    "report_trend_dow": BASE_CTES
    + """SELECT month, pickup_day_of_week, CAST(SUM(total_trips) AS BIGINT) AS total_trips
    FROM fact WHERE year = 1998 GROUP BY month, pickup_day_of_week""",
    "report_borough": BASE_CTES
    + f"""SELECT d.borough AS pickup_borough, {stable("SUM(f.total_revenue)")} AS total_revenue,
      CAST(SUM(f.total_trips) AS BIGINT) AS total_trips
    FROM fact f LEFT JOIN dim d ON f.pulocationid = d.location_id
    WHERE f.year = 1998 GROUP BY d.borough""",
    "report_hourly": BASE_CTES
    + f"""SELECT pickup_hour, CAST(SUM(total_trips) AS BIGINT) AS total_trips,
      {stable("SUM(total_distance_miles)")} AS sum_distance,
      {stable("CASE WHEN SUM(total_trips) = 0 THEN NULL ELSE SUM(total_distance_miles) / SUM(total_trips) END")} AS avg_distance
    FROM fact WHERE year = 1998 GROUP BY pickup_hour""",
    "pending_periods": BASE_CTES
    + """SELECT l.year, l.month FROM (SELECT DISTINCT year, month FROM norm) l
    WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT year, month FROM norm WHERE year < 1998) d
                      WHERE d.year = l.year AND d.month = l.month)""",
    "missing_periods": BASE_CTES
    + f"""SELECT r.year, r.month FROM ({ORDER_PERIODS}) r
    WHERE NOT EXISTS (SELECT 1 FROM silver s WHERE s.year = r.year AND s.month = r.month)""",
    "missing_event_periods": BASE_CTES
    + """SELECT r.year, r.month FROM (SELECT DISTINCT CAST(year(ts) AS INTEGER) AS year,
      CAST(month(ts) AS INTEGER) AS month FROM events) r
    WHERE NOT EXISTS (SELECT 1 FROM silver s WHERE s.year = r.year AND s.month = r.month)""",
    "available_periods": BASE_CTES
    + f"""SELECT r.year, r.month FROM ({ORDER_PERIODS}) r
    WHERE EXISTS (SELECT 1 FROM silver s WHERE s.year = r.year AND s.month = r.month)""",
    "dedup_clean": DEDUP_CTES
    + f"SELECT * EXCLUDE (rn) REPLACE ({_trip_view(TRIP_DOUBLES)}) FROM ranked WHERE rn = 1",
    "dedup_quarantine": DEDUP_CTES
    + f"""SELECT * EXCLUDE (rn) REPLACE ({_trip_view(TRIP_DOUBLES)}),
      'duplicate_record' AS failure_mode, 'duplicate business key' AS failure_reason
    FROM ranked WHERE rn > 1""",
}

# The tables as the stages store them: rows carry their landing file's name and
# the run that made them. Months before 1998 came with the first run.
STORED = """
CASE WHEN year < 1998 THEN 'run1' ELSE 'run2' END AS batch_id,
  'yellow_tripdata_' || year || '-' || lpad(CAST(month AS VARCHAR), 2, '0') || '.parquet' AS source_file"""

RUN_COUNTS = """
counts AS (
  SELECT year, month, year < 1998 AS early, COUNT(*) FILTER (WHERE schema_violation_reason = '') AS clean,
    COUNT(*) FILTER (WHERE schema_violation_reason <> '') AS violations
  FROM norm GROUP BY year, month),
kept AS (SELECT year, month, COUNT(*) AS n FROM silver GROUP BY year, month),
months AS (SELECT c.*, coalesce(k.n, 0) AS kept FROM counts c LEFT JOIN kept k USING (year, month)),
totals AS (
  SELECT early, COUNT(*) AS landed, COUNT(*) FILTER (WHERE clean > 0) AS in_bronze, COUNT(*) FILTER (WHERE kept > 0) AS in_silver,
    SUM(clean) AS clean, SUM(violations) AS violations, SUM(kept) AS kept
  FROM months GROUP BY early)"""


def _number(expr: str, name: str) -> str:
    return f"CAST({expr} AS DOUBLE) AS {name}"


def _history(run: int, new: str, before: str) -> str:
    """One run's three stages: ``new`` the totals that landed before it, ``before``
    those that were done; either may be empty."""
    done = lambda column: f"coalesce((SELECT SUM({column}) FROM totals WHERE {before}), 0)"
    got = lambda column: f"coalesce((SELECT SUM({column}) FROM totals WHERE {new}), 0)"
    return f"""
SELECT {run} AS run, 'bronze' AS stage, {_number(got("landed"), "months")}, {_number(done("landed"), "skipped")},
  {_number(got("clean"), "rows_written")}, {_number(got("violations"), "rows_rejected")}, CAST(NULL AS BOOLEAN) AS dimension_built
UNION ALL SELECT {run}, 'silver', {_number(got("in_bronze"), "m")}, {_number(done("in_bronze"), "s")}, {_number(got("kept"), "r")},
  CAST(NULL AS DOUBLE), CAST(NULL AS BOOLEAN)
UNION ALL SELECT {run}, 'gold', CAST({got("in_silver")} + {done("in_silver")} AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE),
  CAST(NULL AS DOUBLE), {"FALSE" if run == 1 else "TRUE"}"""


def _placed(order: str) -> str:
    return f"row_number() OVER (ORDER BY {order}) - 1 AS place"


_KPIS = ORACLE["report_kpis_newest"].removeprefix(BASE_CTES)
FILES: dict[str, str] = {
    "files_landing": BASE_CTES
    + """SELECT DISTINCT 'yellow_tripdata_' || year || '-' || lpad(CAST(month AS VARCHAR), 2, '0') || '.parquet' AS file, year, month
    FROM norm""",
    "files_bronze": BASE_CTES + f"SELECT * EXCLUDE (batch_id, source_file) REPLACE ({_trip_view(TRIP_DOUBLES)}), {STORED} FROM bronze",
    "files_quarantine": BASE_CTES
    + f"""SELECT * EXCLUDE (batch_id, source_file, schema_violation_reason) REPLACE ({_trip_view(TRIP_DOUBLES)}), {STORED},
      'schema_violation' AS failure_mode, schema_violation_reason AS failure_reason FROM norm WHERE schema_violation_reason <> ''""",
    "files_silver": BASE_CTES + f"SELECT * REPLACE ({_trip_view(SILVER_DOUBLES)}, 'silver' AS batch_id) FROM silver",
    "files_silver_mixed": BASE_CTES
    + f"""SELECT * REPLACE ({_trip_view(SILVER_DOUBLES)},
      CASE WHEN payment_type % 2 = 1 THEN 'yellow_tripdata' ELSE 'modern' END AS schema_family) FROM silver""",
    "files_fact": BASE_CTES + f"SELECT * REPLACE ({_stable_all(FACT_DOUBLES)}, 'gold' AS batch_id) FROM fact",
    "files_fact_month": BASE_CTES
    + f"SELECT * REPLACE ({_stable_all(FACT_DOUBLES)}, 'gold' AS batch_id) FROM fact WHERE year = 1998 AND month = 3",
    "files_dim": BASE_CTES + "SELECT * FROM dim",
    "files_periods": BASE_CTES
    + """SELECT DISTINCT 'bronze' AS name, year, month FROM bronze UNION ALL SELECT DISTINCT 'silver', year, month FROM silver
    UNION ALL SELECT DISTINCT 'fact', year, month FROM fact""",
    "files_run_log": BASE_CTES.rstrip() + "," + RUN_COUNTS
    + f"""
SELECT 'bronze' AS stage, year, month, {_number("clean", "rows_written")}, {_number("violations", "rows_rejected")},
  CASE WHEN early THEN 'run1' ELSE 'run2' END AS batch, CAST(NULL AS VARCHAR) AS source_batch FROM months
UNION ALL SELECT 'silver', year, month, {_number("kept", "w")}, {_number("clean - kept", "r")}, 'silver', CASE WHEN early THEN 'run1' ELSE 'run2' END
FROM months WHERE clean > 0
UNION ALL SELECT 'gold', year, month, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), 'gold', 'silver' FROM months WHERE kept > 0""",
    "files_run_history": BASE_CTES.rstrip() + "," + RUN_COUNTS
    + _history(1, "early", "FALSE") + " UNION ALL " + _history(2, "NOT early", "early") + " UNION ALL " + _history(3, "FALSE", "TRUE"),
    "files_audit": BASE_CTES
    + """SELECT 'bronze' AS name, CASE WHEN year < 1998 THEN 'run1' ELSE 'run2' END AS batch, COUNT(*) AS row_count, TRUE AS one_timestamp
    FROM bronze GROUP BY 2
    UNION ALL SELECT 'quarantine', CASE WHEN year < 1998 THEN 'run1' ELSE 'run2' END, COUNT(*), TRUE FROM norm
    WHERE schema_violation_reason <> '' GROUP BY 2
    UNION ALL SELECT 'silver', 'silver', COUNT(*), TRUE FROM silver GROUP BY year < 1998
    UNION ALL SELECT 'fact', 'gold', COUNT(*), TRUE FROM fact""",
    "files_report_years": BASE_CTES + f"SELECT year, {_placed('year DESC')} FROM (SELECT DISTINCT year FROM fact)",
    "files_report_kpis": BASE_CTES + f"SELECT *, CAST(0 AS BIGINT) AS place FROM ({_KPIS})",
    "files_report_trend": BASE_CTES
    + f"SELECT *, {_placed('month, pickup_day_of_week')} FROM ({ORACLE['report_trend_dow'].removeprefix(BASE_CTES)})",
    "files_report_borough": BASE_CTES
    + f"SELECT *, {_placed('total_revenue DESC')} FROM ({ORACLE['report_borough'].removeprefix(BASE_CTES)})",
    "files_report_hourly": BASE_CTES + f"SELECT *, {_placed('pickup_hour')} FROM ({ORACLE['report_hourly'].removeprefix(BASE_CTES)})",
}
ORACLE |= FILES
