"""Landing → Bronze → Silver → Gold → reports on files (FIXTURES §B/§C),
idempotent re-runs, period selection, and lakes that were left by other tools,
lost their log or had months removed."""

from __future__ import annotations

import os
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from test_ingest import _trips, _write
from tidewater.plans import bronze, fixture_flow, gold, reports, silver
from tidewater.plans.common import LakePaths
from tidewater.plans.orchestrate import RunConfig, run
from tidewater.sources.fixtures import zone_lookup
from tools.staging import stage_landing_files
from tidewater.schemas import BRONZE_SCHEMA, FACT_SCHEMA, QUARANTINE_SCHEMA, SILVER_SCHEMA
from tidewater.sources.tables import read_table


def _table_rows(spark, root, drop=()):
    frame = read_table(spark, root)
    cols = sorted(c for c in frame.columns if c not in drop)
    return Counter(tuple(r) for r in frame.select(*cols).collect())


@pytest.fixture(scope="module")
def built_lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("e2e")
    paths = LakePaths.under(str(root / "lake"))
    stage_landing_files(spark, SF_SMALL, paths.landing, str(root / "staging"))
    os.makedirs(os.path.dirname(paths.lookup), exist_ok=True)
    zone_lookup(spark, SF_SMALL).toPandas().to_csv(paths.lookup, index=False)
    first = run(spark, RunConfig(paths=paths, batch_id="ingest-1"))
    return paths, first


def test_stage_counts_match_fixture_expectations(spark, built_lake):
    paths, first = built_lake
    assert first["ingest"].landing_files == 83
    assert first["ingest"].records_processed == 5890
    assert first["ingest"].schema_violations == 110
    assert read_table(spark, paths.bronze).count() == 5890
    quarantine = read_table(spark, paths.schema_violations)
    reasons = {r["failure_reason"]: r["count"] for r in quarantine.groupBy("failure_reason").count().collect()}
    assert reasons == {"passenger_count": 59, "dolocationid": 49, "passenger_count, dolocationid": 2}
    silver_tbl = read_table(spark, paths.silver)
    assert silver_tbl.count() == 4251
    assert silver_tbl.filter("is_weekend").count() == 1174
    assert silver_tbl.filter("vendor_id IS NULL").count() == 53
    fact = read_table(spark, paths.fact)
    assert fact.count() == 3647
    assert fact.filter("total_trips = 0").count() == 40
    assert fact.agg(F.max("total_trips")).first()[0] == 4
    assert fact.select("year", "month").distinct().count() == 83
    assert fact.filter("year = 1998 AND month = 3").count() == 41
    assert first["silver"].partitions_processed == 83
    assert first["gold"].partitions_processed == 83 and first["gold"].dimension_built


def test_reports_on_files(spark, built_lake):
    paths, _ = built_lake
    fact, dim = reports.load_gold(spark, paths)
    k = reports.kpis(fact, 1998).first()
    assert k["total_trips"] == 576
    assert round(k["total_revenue"], 2) == 32694.17
    assert k["total_passengers"] == 2114
    assert round(k["avg_tip"], 4) == 4.1510
    ranking = reports.borough_ranking(fact, dim, 1998).collect()
    assert len(ranking) == 6
    revenues = [r["total_revenue"] for r in ranking]
    assert revenues == sorted(revenues, reverse=True)
    unknown = [r for r in ranking if r["pickup_borough"] is None][0]
    assert round(unknown["total_revenue"], 2) == 11394.64 and unknown["total_trips"] == 205
    hours = [r["pickup_hour"] for r in reports.hourly_profile(fact, 1998).collect()]
    assert hours == sorted(hours)
    years = [r["year"] for r in reports.available_years(fact).collect()]
    assert years == sorted(years, reverse=True) and years[0] == 2001
    newest = reports.kpis(fact).first()
    assert newest["total_trips"] == reports.kpis(fact, 2001).first()["total_trips"]
    trend = reports.trend(fact, dim, 1998, "pickup_day_of_week").collect()
    assert [r["month"] for r in trend] == sorted(r["month"] for r in trend)
    with pytest.raises(ValueError):
        reports.trend(fact, dim, 1998, "payment_type")
    empty = reports.kpis(fact, 1990).first()
    assert tuple(empty) == (0, 0.0, 0, 0.0, 0.0)


def test_files_agree_with_lazy_flow(spark, built_lake):
    paths, _ = built_lake
    fact, dim = reports.load_gold(spark, paths)
    lazy_fact = fixture_flow.fact(spark, SF_SMALL)
    on_files = reports.borough_ranking(fact, dim, 1998).collect()
    lazy = reports.borough_ranking(lazy_fact, fixture_flow.dim(spark, SF_SMALL), 1998).collect()
    assert [(r[0], round(r[1], 6), r[2]) for r in on_files] == [(r[0], round(r[1], 6), r[2]) for r in lazy]
    keys = ["year", "month", "pickup_hour", "pickup_day_of_week", "is_weekend", "pulocationid", "dolocationid"]
    a = {tuple(r[k] for k in keys): r["total_trips"] for r in fact.collect()}
    b = {tuple(r[k] for k in keys): r["total_trips"] for r in lazy_fact.collect()}
    assert a == b


def test_rerun_is_idempotent(spark, built_lake):
    paths, _ = built_lake
    audit = ("ingested_at", "transformed_at", "generated_at", "batch_id")
    before = {name: _table_rows(spark, root, audit) for name, root in
              [("bronze", paths.bronze), ("quarantine", paths.schema_violations),
               ("silver", paths.silver), ("fact", paths.fact)]}
    second = run(spark, RunConfig(paths=paths))
    assert second["ingest"].files_skipped == 83 and second["ingest"].records_processed == 0
    assert second["silver"].partitions_processed == 0
    assert second["gold"].partitions_processed == 83
    after = {name: _table_rows(spark, root, audit) for name, root in
             [("bronze", paths.bronze), ("quarantine", paths.schema_violations),
              ("silver", paths.silver), ("fact", paths.fact)]}
    assert before == after


def test_period_selection_and_missing(spark, built_lake):
    paths, _ = built_lake
    one = gold.transform(spark, paths, year=1998, month=3, batch_id="gold-one")
    assert one.periods == [(1998, 3)] and one.missing == []
    fact = read_table(spark, paths.fact)
    assert fact.filter("batch_id = 'gold-one'").count() == 41
    assert fact.count() == 3647
    absent = gold.transform(spark, paths, year=2030, month=1)
    assert absent.partitions_processed == 0 and absent.missing == [(2030, 1)]
    only_year = silver.plan_periods(spark, paths, 1998, None)
    assert only_year[0] == [] and len(only_year[2]) == 83  # all months, all done


def _bare_bronze(spark, root, rows, month):
    """A Bronze month as another tool may have left it: no run-log, no batch
    columns, no schema_family, and vendor ids as text."""
    schema = (
        "vendor_id string, vendor_name string, pickup_datetime timestamp, dropoff_datetime timestamp, passenger_count int,"
        " trip_distance double, ratecode_id int, store_and_fwd_flag string, pulocationid int, dolocationid int, payment_type int,"
        " fare_amount double, extra double, mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double,"
        " congestion_surcharge double, airport_fee double, total_amount double"
    )
    full = [
        (vendor, "V", start, end, riders, miles, 1, "Y", 41, 62, 2, fare, 0.0, 0.0, 1.25, 0.0, 0.0, 0.0, 0.0, fare + 1.25)
        for vendor, start, end, riders, miles, fare in rows
    ]
    spark.createDataFrame(full, schema).write.parquet(f"{root}/year=2031/month={month}")


def test_stages_start_from_a_bare_bronze_directory(spark, tmp_path):
    paths = LakePaths.under(str(tmp_path / "bare"), lookup=str(tmp_path / "missing.csv"))
    day = datetime(2031, 2, 11, 19, 5)
    rows = [
        ("4", day, day.replace(hour=20, minute=17), 3, 9.5, 44.0), (None, day, day.replace(minute=35), 1, 2.5, 11.5),
        ("x", day, day, 1, 1.0, 5.0), ("4", day, day.replace(hour=21), 0, 1.0, 5.0), ("4", day, day.replace(hour=21), 2, 1.0, -5.0),
    ]
    _bare_bronze(spark, paths.bronze, rows, 2)
    assert silver.transform(spark, paths).periods == [(2031, 2)]
    stored = read_table(spark, paths.silver)
    assert {f.name: f.dataType for f in stored.schema.fields} == {f.name: f.dataType for f in SILVER_SCHEMA.fields}
    got = {r["vendor_id"]: r for r in stored.collect()}
    assert set(got) == {4, None} and got[4]["trip_duration_minutes"] == 72.0 and got[None]["trip_duration_minutes"] == 30.0
    assert {r["schema_family"] for r in got.values()} == {"yellow_tripdata"}
    result = gold.transform(spark, paths, year=2031, month=2, batch_id="gold-bare")
    assert not result.dimension_built and result.periods == [(2031, 2)]  # lookup missing: warned, not failed
    fact = read_table(spark, paths.fact).collect()
    assert [(r["pickup_hour"], r["total_trips"], r["total_passengers"], r["total_revenue"]) for r in fact] == [(19, 1, 4, 58.0)]
    assert fact[0]["avg_duration_minutes"] == 51.0 and fact[0]["batch_id"] == "gold-bare"
    assert silver.transform(spark, paths, year=2031, month=5).missing == [(2031, 5)]
    assert gold.transform(spark, paths, year=2031, month=5).partitions_processed == 0


def test_bronze_months_of_different_types_are_read_together(spark, tmp_path):
    from tidewater.sources.tables import read_resolved

    paths = LakePaths.under(str(tmp_path / "mixed"))
    day = datetime(2031, 3, 1, 6)
    _bare_bronze(spark, paths.bronze, [("7", day, day.replace(hour=7), 1, 1.0, 2.0)], 3)
    spark.sql("SELECT 9 AS vendor_id, 2L AS passenger_count, 'modern' AS schema_family").write.parquet(f"{paths.bronze}/year=2031/month=4")
    months = [(2031, 3), (2031, 4), (2031, 5)]
    for absent, family in ((silver.ABSENT, "yellow_tripdata"), ({}, None)):
        got = read_resolved(spark, paths.bronze, months, BRONZE_SCHEMA, absent)
        rows = {(r["month"], r["vendor_id"], r["passenger_count"], r["schema_family"]) for r in got.collect()}
        assert rows == {(3, 7, 1, family), (4, 9, 2, "modern")}
    assert read_resolved(spark, paths.bronze, [(2030, 1)], BRONZE_SCHEMA) is None


def test_lost_log_and_removed_months(spark, tmp_path):
    """Without its log the lake's months still count; removed months are done
    again or reported, and leave no stale fact rows."""
    import shutil

    paths = LakePaths.under(str(tmp_path / "lake"), lookup=str(tmp_path / "missing.csv"))
    os.makedirs(paths.landing)
    for month, n in ((1, 5), (2, 4), (3, 3)):
        _write(paths.landing, f"yellow_tripdata_2026-0{month}.parquet", _trips(n, month))
    run(spark, RunConfig(paths=paths))
    before = _table_rows(spark, paths.fact, ("generated_at", "batch_id"))

    shutil.rmtree(paths.run_log)
    again = run(spark, RunConfig(paths=paths))
    assert again["ingest"].files_skipped == 3 and again["silver"].skipped == [(2026, 1), (2026, 2), (2026, 3)]
    assert again["gold"].partitions_processed == 3 and _table_rows(spark, paths.fact, ("generated_at", "batch_id")) == before

    shutil.rmtree(f"{paths.silver}/year=2026/month=2")
    modeled = gold.transform(spark, paths)
    assert modeled.periods == [(2026, 1), (2026, 3)] and modeled.stale == [(2026, 2)]
    assert {r["month"] for r in read_table(spark, paths.fact).select("month").distinct().collect()} == {1, 3}
    assert gold.transform(spark, paths, year=2026, month=2).missing == [(2026, 2)]
    assert silver.transform(spark, paths).periods == [(2026, 2)]

    shutil.rmtree(f"{paths.bronze}/year=2026/month=1")
    redone = run(spark, RunConfig(paths=paths, only_changed_gold=True))
    assert redone["ingest"].periods == [(2026, 1)] and redone["ingest"].records_processed == 5
    assert _table_rows(spark, paths.fact, ("generated_at", "batch_id")) == before
    # Silver logs the batch that each month was made from: a new Bronze batch makes it pending
    bronze.ingest(spark, paths, force=True)
    assert silver.transform(spark, paths, force=True).partitions_processed == 3
    assert silver.transform(spark, paths).periods == []
    bronze.ingest(spark, paths, force=True)
    assert silver.transform(spark, paths).periods == [(2026, 1), (2026, 2), (2026, 3)]
    assert gold.transform(spark, paths, only_changed=True).periods == [(2026, 1), (2026, 2), (2026, 3)]
    assert gold.transform(spark, paths, only_changed=True).periods == []


def test_crash_while_logging_leaves_a_complete_lake(spark, tmp_path, monkeypatch):
    from tidewater.plans import bronze as stage

    paths = LakePaths.under(str(tmp_path / "lake"), lookup=str(tmp_path / "missing.csv"))
    os.makedirs(paths.landing)
    _write(paths.landing, "yellow_tripdata_2026-01.parquet", _trips(5, 1))

    def crash(*_, **__):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as m:
        m.setattr(stage, "log_run", crash)
        with pytest.raises(RuntimeError):
            bronze.ingest(spark, paths)
    done = run(spark, RunConfig(paths=paths))
    assert done["ingest"].files_skipped == 1 and done["silver"].rows_written == 5
    assert read_table(spark, paths.bronze).count() == 5 and done["gold"].partitions_processed == 1


def test_stored_types(spark, built_lake):
    """The tables' real column types, which the oracle comparison cannot see."""
    paths, _ = built_lake
    for root, schema in (
        (paths.bronze, BRONZE_SCHEMA), (paths.schema_violations, QUARANTINE_SCHEMA), (paths.silver, SILVER_SCHEMA), (paths.fact, FACT_SCHEMA)
    ):
        stored = {f.name: f.dataType for f in spark.read.parquet(root).schema.fields}
        assert stored == {f.name: f.dataType for f in schema.fields}, root


def test_gold_only_changed_months(spark, built_lake):
    paths, _ = built_lake
    full = gold.transform(spark, paths)  # logs every month for Gold
    assert full.partitions_processed == 83
    nothing = gold.transform(spark, paths, only_changed=True)
    assert nothing.partitions_processed == 0
    # another Silver batch of one month → only that month is recomputed
    from tidewater.sinks.writers import log_run

    log_run(spark, paths.run_log, "silver", {(1998, 3): (41, 0)}, "silver-manual")
    one = gold.transform(spark, paths, only_changed=True)
    assert one.periods == [(1998, 3)]
    assert read_table(spark, paths.fact).count() == 3647


def test_sql_views(spark, built_lake):
    paths, _ = built_lake
    names = reports.register_views(spark, paths)
    assert {"trips_bronze", "trips_silver", "fact_trip_summary", "dim_taxi_zone", "trip_report"} <= set(names)
    row = spark.sql(
        "SELECT SUM(total_trips) AS trips FROM trip_report WHERE year = 1998"
    ).first()
    assert row["trips"] == 576


def test_one_audit_timestamp_per_batch(spark, built_lake):
    paths, _ = built_lake
    bronze_stamps = {r[0] for r in read_table(spark, paths.bronze).select("ingested_at").distinct().collect()}
    quarantine_stamps = {
        r[0] for r in read_table(spark, paths.schema_violations).select("ingested_at").distinct().collect()
    }
    assert len(bronze_stamps) == 1 and bronze_stamps == quarantine_stamps
    silver_stamps = read_table(spark, paths.silver).select("transformed_at").distinct().count()
    assert silver_stamps == 1
