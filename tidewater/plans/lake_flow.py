"""The stages over files: a whole lake made from the driver's test tables.

:func:`built` lands the trips derived from ``lineitem`` as monthly files and runs
ingest, Silver and Gold over them three times: with the months before
``SPLIT_YEAR`` and no zone lookup, with the rest landed and the lookup there, and
once more with nothing new. The landing files drift as real ones do: by month,
counts and ids are stored as other types and in another column order, so they
conflict. The registered queries read what the stages have stored.

The lake lies in the session's checkpoint folder and is built once for a session
and a set of tables.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidewater.plans import fixture_flow as flow
from tidewater.plans import gold, reports, silver
from tidewater.plans.common import LakePaths
from tidewater.plans.orchestrate import RunConfig, run
from tidewater.schemas import BRONZE_SCHEMA, DIM_ZONE_SCHEMA, FACT_SCHEMA, QUARANTINE_SCHEMA, RUN_LOG_SCHEMA, SILVER_SCHEMA
from tidewater.session import scratch_root
from tidewater.sources.fixtures import landing_trips, zone_lookup
from tidewater.sources.landing import list_landing_files
from tidewater.sources.tables import file_system, period_dirs, read_table

#: Months from this year on land before the second run.
SPLIT_YEAR = 1998


@dataclass
class Lake:
    paths: LakePaths
    history: list[tuple]


_LAKES: dict[tuple[str, str], Lake] = {}


def _variants(trips: DataFrame) -> list[DataFrame]:
    """The trips of every third month as they are, with counts as BIGINT and vendors
    as INT in reversed column order, and with payment types as text."""
    turn = F.month("shipdate") % 3
    reversed_order = trips.select(*reversed(trips.columns)).withColumns(
        {"passenger_count": F.col("passenger_count").cast("bigint"), "VendorID": F.col("VendorID").cast("int")}
    )
    as_text = trips.withColumn("payment_type", F.col("payment_type").cast("string"))
    return [frame.where(turn == k) for k, frame in enumerate((trips, reversed_order, as_text))]


def land(spark: SparkSession, trips: DataFrame, landing: str, scratch: str) -> None:
    """Write ``trips`` (with ``shipdate``) as ``yellow_tripdata_YYYY-MM.parquet``, one
    file a month: Spark writes a directory per month, whose one file is renamed."""
    fs, path = file_system(spark, landing)
    fs.mkdirs(path(landing))
    for k, variant in enumerate(_variants(trips)):
        months = variant.withColumn("_period", F.date_format("shipdate", "yyyy-MM")).drop("shipdate")
        months.repartition("_period").write.partitionBy("_period").parquet(f"{scratch}/{k}")
        for part in fs.globStatus(path(f"{scratch}/{k}/_period=*/part-*.parquet")) or []:
            period = part.getPath().getParent().getName().split("=")[1]
            fs.rename(part.getPath(), path(f"{landing}/yellow_tripdata_{period}.parquet"))


def _build(spark: SparkSession, sf_dir: str) -> Lake:
    root = f"{scratch_root(spark)}/tidewater-lake/{uuid.uuid4().hex}"
    paths = LakePaths.under(f"{root}/lake", lookup=f"{root}/zones")
    trips, early = landing_trips(spark, sf_dir), F.year("shipdate") < SPLIT_YEAR
    history: list[tuple] = []
    for number, arrivals in enumerate((trips.where(early), trips.where(~early), None), start=1):
        if arrivals is not None:
            land(spark, arrivals, paths.landing, f"{root}/staging{number}")
        if number == 2:
            zone_lookup(spark, sf_dir).write.option("header", "true").csv(paths.lookup)
        done = run(spark, RunConfig(paths=paths, batch_id=f"run{number}", retries=0))
        ingested, transformed, modeled = done["ingest"], done["silver"], done["gold"]
        history += [
            (number, "bronze", len(ingested.periods), ingested.files_skipped, ingested.records_processed, ingested.schema_violations, None),
            (number, "silver", transformed.partitions_processed, len(transformed.skipped), transformed.rows_written, None, None),
            (number, "gold", modeled.partitions_processed, None, None, None, modeled.dimension_built),
        ]
    return Lake(paths, history)


def built(spark: SparkSession, sf_dir: str) -> Lake:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _LAKES or not period_dirs(spark, _LAKES[key].paths.fact):
        _LAKES[key] = _build(spark, sf_dir)
    return _LAKES[key]


def _kind(batch: Column) -> Column:
    """What a batch id begins with: the ingest's own name, ``silver`` or ``gold``."""
    return F.substring_index(batch, "-", 1)


def stored(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stored table; the landing file of a row by its name, its batch by kind."""
    paths = built(spark, sf_dir).paths
    root, schema = {
        "bronze": (paths.bronze, BRONZE_SCHEMA), "quarantine": (paths.schema_violations, QUARANTINE_SCHEMA),
        "silver": (paths.silver, SILVER_SCHEMA), "fact": (paths.fact, FACT_SCHEMA), "dim": (paths.dim_zone, DIM_ZONE_SCHEMA),
    }[name]
    frame = read_table(spark, root, schema)
    if "source_file" in frame.columns:
        frame = frame.withColumn("source_file", F.regexp_extract("source_file", "[^/]*$", 0))
    return frame.withColumn("batch_id", _kind(F.col("batch_id"))) if "batch_id" in frame.columns else frame


def landing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """file, year, month of each landing file."""
    files = list_landing_files(spark, built(spark, sf_dir).paths.landing)
    return spark.createDataFrame([(f.name, f.year, f.month) for f in files], "file string, year int, month int")


def table_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """name, year, month: the months each table holds, from its directories."""
    paths = built(spark, sf_dir).paths
    roots = {"bronze": paths.bronze, "silver": paths.silver, "fact": paths.fact}
    rows = [(name, y, m) for name, root in roots.items() for y, m in sorted(period_dirs(spark, root))]
    return spark.createDataFrame(rows, "name string, year int, month int")


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the run-log says of every stage and month."""
    log = read_table(spark, built(spark, sf_dir).paths.run_log, RUN_LOG_SCHEMA)
    counts = [F.col(c).cast("double").alias(c) for c in ("rows_written", "rows_rejected")]  # NULL for Gold
    return log.select("stage", "year", "month", *counts, _kind(F.col("batch_id")).alias("batch"), _kind(F.col("source_batch_id")).alias("source_batch"))


def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each stage of each run has done and skipped."""
    schema = "run int, stage string, months double, skipped double, rows_written double, rows_rejected double, dimension_built boolean"
    rows = [(a, b, *(None if x is None else float(x) for x in rest[:-1]), rest[-1]) for a, b, *rest in built(spark, sf_dir).history]
    return spark.createDataFrame(rows, schema)


def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per table and batch: rows, and whether they carry one audit timestamp, not
    NULL and the same in the quarantine as in Bronze."""
    paths = built(spark, sf_dir).paths
    stamps = {"bronze": (paths.bronze, BRONZE_SCHEMA, "ingested_at"), "quarantine": (paths.schema_violations, QUARANTINE_SCHEMA, "ingested_at"),
              "silver": (paths.silver, SILVER_SCHEMA, "transformed_at"), "fact": (paths.fact, FACT_SCHEMA, "generated_at")}
    frames = [
        read_table(spark, root, schema).groupBy(F.lit(name).alias("name"), "batch_id").agg(
            F.count(F.lit(1)).alias("row_count"), F.count(column).alias("stamped"), F.min(column).alias("first"), F.max(column).alias("last")
        )
        for name, (root, schema, column) in stamps.items()
    ]
    every = frames[0].unionByName(frames[1]).unionByName(frames[2]).unionByName(frames[3])
    of_batch = W.partitionBy("batch_id")
    one = (F.min("first").over(of_batch) == F.max("last").over(of_batch)) & (F.col("stamped") == F.col("row_count"))
    return every.select("name", _kind(F.col("batch_id")).alias("batch"), "row_count", one.alias("one_timestamp"))


def placed(report: DataFrame) -> DataFrame:
    """A report with each row's place in its order."""
    return report.coalesce(1).withColumn("place", F.monotonically_increasing_id())


def report(spark: SparkSession, sf_dir: str, name: str, year: int) -> DataFrame:
    """A dashboard report over the stored Gold tables, with its order."""
    paths = built(spark, sf_dir).paths
    fact, dim = reports.load_gold(spark, paths)
    return placed({
        "years": lambda: reports.report_years(spark, paths), "trend": lambda: reports.trend(fact, dim, year, "pickup_day_of_week"),
        "borough": lambda: reports.borough_ranking(fact, dim, year), "hourly": lambda: reports.hourly_profile(fact, year),
        "kpis": lambda: reports.kpis(fact, reports.newest_year(spark, paths)),
    }[name]())


def silver_of_mixed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver of a Bronze table that another tool has left: in every month, the trips
    paid by type 1 or 3 lie in files without ``schema_family`` and without the
    surcharge columns' later one (``airport_fee``), vendors stored as text and
    passengers as BIGINT; the others in files that have them all."""
    root = f"{scratch_root(spark)}/tidewater-lake/{uuid.uuid4().hex}"
    paths = LakePaths.under(root)
    trips, plain = flow.bronze(spark, sf_dir), F.col("payment_type") % 2 == 1
    older = trips.where(plain).drop("schema_family", "airport_fee").withColumns(
        {"vendor_id": F.col("vendor_id").cast("string"), "passenger_count": F.col("passenger_count").cast("bigint")}
    )
    for frame in (older, trips.where(~plain)):
        frame.write.mode("append").partitionBy("year", "month").parquet(paths.bronze)
    silver.transform(spark, paths, batch_id="fixture-batch")
    return read_table(spark, paths.silver, SILVER_SCHEMA)


def fact_of_one_month(spark: SparkSession, sf_dir: str, year: int, month: int) -> DataFrame:
    """The fact of a lake for which Gold was asked for one month only."""
    lake = built(spark, sf_dir).paths
    root = f"{scratch_root(spark)}/tidewater-lake/{uuid.uuid4().hex}"
    own = LakePaths.under(root)
    paths = LakePaths(lake.landing, lake.bronze, lake.quarantine, lake.silver, own.gold, own.run_log, lake.lookup)
    gold.transform(spark, paths, year=year, month=month)
    return read_table(spark, paths.fact, FACT_SCHEMA).withColumn("batch_id", _kind(F.col("batch_id")))
