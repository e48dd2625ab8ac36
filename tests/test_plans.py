"""Physical-plan properties that matter at scale: pushdown, pruning,
partial aggregation, checked broadcast, no Python in the hot path."""

from __future__ import annotations

import contextlib
import io
import os

import pytest

import __spark_entry__ as contract
from conftest import SF_SMALL
from test_ingest import _drifting_landing
from tidewater.operators.dedup import mark_duplicates
from tidewater.operators.split import schema_violations, valid_rows
from tidewater.plans import bronze, catalog, gold, reports, silver
from tidewater.plans.bronze import normalized_landing
from tidewater.sources.landing import list_landing_files
from tidewater.schemas import BRONZE_SCHEMA
from tidewater.sources.tables import read_periods, read_resolved


def plan_of(frame) -> str:
    buffer = io.StringIO()
    with contextlib.redirect_stdout(buffer):
        frame.explain(mode="formatted")
    return buffer.getvalue()


@pytest.fixture(scope="module")
def small_lake(spark, tmp_path_factory):
    from tidewater.plans.common import LakePaths
    from tidewater.sources.fixtures import zone_lookup

    root = tmp_path_factory.mktemp("plans")
    paths = LakePaths.under(str(root / "lake"))
    os.makedirs(paths.landing)
    _drifting_landing(paths.landing)
    os.makedirs(os.path.dirname(paths.lookup))
    zone_lookup(spark, SF_SMALL).toPandas().to_csv(paths.lookup, index=False)
    bronze.ingest(spark, paths)
    silver.transform(spark, paths)
    gold.transform(spark, paths)
    return paths


def test_silver_scan_prunes_months_and_pushes_rules(spark, small_lake):
    frame = silver.build_silver(read_resolved(spark, small_lake.bronze, [(2026, 2)], BRONZE_SCHEMA), "b")
    plan = plan_of(frame)
    assert all("/year=2026/month=2/" in f for f in frame.inputFiles())
    pushed = plan.split("PushedFilters:")[1].splitlines()[0]
    for rule in ("GreaterThan(passenger_count,0)", "GreaterThan(trip_distance,0.0)",
                 "GreaterThan(pulocationid,0)", "GreaterThanOrEqual(fare_amount,0.0)"):
        assert rule in pushed
    assert "Exchange" not in plan  # map-only: no shuffle before the write


def test_ingest_reads_only_the_pending_files_once_per_output(spark, small_lake):
    files = list_landing_files(spark, small_lake.landing)
    plan = plan_of(schema_violations(normalized_landing(spark, files[:2], "b")))
    scans = [line for line in plan.splitlines() if line.startswith("Location: InMemoryFileIndex")]
    assert len(scans) == 2  # one scan per schema group, two groups in these files
    assert all("2026-03" not in line and "2026-04" not in line for line in scans)


def test_report_year_is_a_partition_filter_and_dim_is_broadcast(spark, small_lake):
    fact, dim = reports.load_gold(spark, small_lake)
    plan = plan_of(reports.borough_ranking(fact, dim, 2026))
    assert "PartitionFilters: [isnotnull(year" in plan and "(year#" in plan
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    # the fact is pre-aggregated per pickup location before the join
    join_at = plan.index("BroadcastHashJoin") if "BroadcastHashJoin" in plan else plan.index("BroadcastExchange")
    assert "HashAggregate" in plan[join_at:]
    kpi_plan = plan_of(reports.kpis(fact, 2026))
    assert "Join" not in kpi_plan
    assert "ReadSchema: struct<total_trips:bigint,total_passengers:bigint,total_tip_amount:double,total_revenue:double>" in kpi_plan


def test_fact_aggregation_is_partial_then_final(spark):
    plan = plan_of(contract.queries()["gold_fact_trip_summary"](spark, SF_SMALL))
    assert plan.count("HashAggregate") >= 2 and "SortAggregate" not in plan


def test_dedup_aggregates_by_hash_and_joins_the_few_repeated_keys(spark, small_lake, tmp_path):
    plan = plan_of(contract.queries()["dedup_clean"](spark, SF_SMALL))
    assert "SortAggregate" not in plan and "HashAggregate" in plan

    def stored(repeated):
        repeated.write.parquet(str(tmp_path / "repeated"))
        return spark.read.parquet(str(tmp_path / "repeated"))

    files = list_landing_files(spark, small_lake.landing)
    marked = mark_duplicates(valid_rows(normalized_landing(spark, files, "b")), materialize=stored)
    plan = plan_of(marked)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan  # full rows are not shuffled


def test_newest_year_is_a_literal_and_reads_one_year(spark, small_lake):
    year = reports.newest_year(spark, small_lake)
    assert year == 2026
    fact, dim = reports.load_gold(spark, small_lake)
    for frame in (reports.kpis(fact, year), reports.trend(fact, dim, year), reports.borough_ranking(fact, dim, year), reports.hourly_profile(fact, year)):
        filters = [line for line in plan_of(frame).splitlines() if line.startswith("PartitionFilters")]
        assert filters and all("year" in f and "= 2026)" in f for f in filters)


def test_building_reports_starts_no_job(spark, small_lake):
    fact, dim = reports.load_gold(spark, small_lake)
    spark.sparkContext.setJobGroup("build-reports", "plans only")
    try:
        frame = reports.borough_ranking(fact, dim, 2026)
        reports.trend(fact, dim, 2026, "pickup_borough")
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("build-reports")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs
    assert "BroadcastHashJoin" in plan_of(frame)  # by the dimension's size in bytes
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan_of(reports.borough_ranking(fact, dim, 2026))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_python_and_no_pairwise_join_in_the_plan(spark, name):
    plan = plan_of(contract.queries()[name](spark, SF_SMALL))
    for marker in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas"):
        assert marker not in plan
    for marker in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert marker not in plan


def test_reading_months_lists_only_their_directories(spark, small_lake):
    frame = read_periods(spark, small_lake.bronze, [(2026, 2)], BRONZE_SCHEMA)
    files = frame.inputFiles()
    assert files and all("/year=2026/month=2/" in f for f in files)
    assert frame.count() == 10
    assert read_periods(spark, small_lake.bronze, [(2030, 1)], BRONZE_SCHEMA) is None
