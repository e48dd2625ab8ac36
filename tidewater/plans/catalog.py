"""Registered check queries: each stage / operator over the whole test tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose
columns match the SQL of the same name in :mod:`tidewater.plans.oracle_sql`.
Audit timestamps are left out and doubles are normalised with
:func:`stable_doubles` so an independent engine can compare values.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import all_required_present, any_required_missing
from tidewater.operators import dedup, periods, split
from tidewater.operators.enrich import rule_failure_counts
from tidewater.operators.normalize import REASON_COLUMN
from tidewater.plans import fixture_flow as flow
from tidewater.plans import lake_flow, reports
from tidewater.schemas import FAILURE_DUPLICATE, DUPLICATE_REASON
from tidewater.sources.fixtures import table

REPORT_YEAR = 1998  # the year the dashboard checks look at
EMPTY_YEAR = 1990  # a year with no trips: KPIs must come back as zeros

Query = Callable[[SparkSession, str], DataFrame]


@contextmanager
def utc_plan(spark: SparkSession):
    """Build a plan with the session time zone set to UTC, then restore it.

    The fixture timestamps are naive wall-clock values, compared with an
    engine that has no time zone. Spark fixes the zone into each
    time-zone-aware expression when the frame is analysed, so the plan keeps
    UTC after the caller's setting is back.
    """
    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    spark.conf.set(key, "UTC")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _in_utc(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with utc_plan(spark):
            return query(spark, sf_dir)

    return run


def _check(frame: DataFrame) -> DataFrame:
    return flow.stable_doubles(flow.without_audit(frame))


def _check_trips(frame: DataFrame) -> DataFrame:
    return flow.comparable_trips(flow.without_audit(frame))


def bronze_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _check_trips(flow.normalized(spark, sf_dir))


def violation_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        flow.normalized(spark, sf_dir)
        .groupBy(REASON_COLUMN)
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def bronze_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _check_trips(split.bronze_rows(flow.normalized(spark, sf_dir)))


def quarantine_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _check_trips(split.schema_violations(flow.normalized(spark, sf_dir)))


def ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        flow.normalized(spark, sf_dir)
        .groupBy("year", "month")
        .agg(
            F.count_if(all_required_present()).alias("clean_records"),
            F.count_if(any_required_missing()).alias("violations"),
        )
    )


def silver_rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_failure_counts(flow.bronze(spark, sf_dir), by=["year", "month"])


def silver_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _check_trips(flow.silver(spark, sf_dir))


def dim_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flow.dim(spark, sf_dir)


def gold_fact_trip_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _check(flow.fact(spark, sf_dir))


def gold_fact_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    selected = periods.select_period(REPORT_YEAR, 3)
    return _check(flow.fact(spark, sf_dir).filter(periods.period_filter(selected)))


def fact_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _check(reports.report_frame(flow.fact(spark, sf_dir), flow.dim(spark, sf_dir)))


def report_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.available_years(flow.fact(spark, sf_dir))


def report_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flow.stable_doubles(reports.kpis(flow.fact(spark, sf_dir), REPORT_YEAR))


def report_kpis_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KPIs for the default year: the newest one present."""
    return flow.stable_doubles(reports.kpis(flow.fact(spark, sf_dir)))


def report_kpis_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flow.stable_doubles(reports.kpis(flow.fact(spark, sf_dir), EMPTY_YEAR))


def _trend(drill: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return reports.trend(flow.fact(spark, sf_dir), flow.dim(spark, sf_dir), REPORT_YEAR, drill)

    run.__name__ = f"report_trend_{drill}"
    return run


def report_borough(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flow.stable_doubles(
        reports.borough_ranking(flow.fact(spark, sf_dir), flow.dim(spark, sf_dir), REPORT_YEAR)
    )


def report_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flow.stable_doubles(reports.hourly_profile(flow.fact(spark, sf_dir), REPORT_YEAR))


def pending_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = periods.period_set(flow.normalized(spark, sf_dir))
    return periods.pending_periods(landed, flow.done_before(landed, REPORT_YEAR))


def _order_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))


def missing_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.missing_periods(_order_periods(spark, sf_dir), flow.silver(spark, sf_dir))


def missing_event_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months another feed (the ``events`` table) asks for that the lakehouse
    has no trips for."""
    events = table(spark, sf_dir, "events").select(F.year("ts").alias("year"), F.month("ts").alias("month"))
    return periods.missing_periods(events, flow.silver(spark, sf_dir))


def available_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.available_periods(_order_periods(spark, sf_dir), flow.silver(spark, sf_dir))


def dedup_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = flow.dedup_marked(spark, sf_dir)
    return _check_trips(split.bronze_projection(dedup.unique_rows(marked)))


def dedup_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = flow.dedup_marked(spark, sf_dir)
    return _check_trips(
        split.quarantine_projection(dedup.duplicate_rows(marked), FAILURE_DUPLICATE, DUPLICATE_REASON)
    )


def _stored(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        frame = lake_flow.stored(spark, sf_dir, name)
        return _check_trips(frame) if name in ("bronze", "quarantine", "silver") else _check(frame)

    run.__name__ = f"files_{name}"
    return run


def _stored_report(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return flow.stable_doubles(lake_flow.report(spark, sf_dir, name, REPORT_YEAR))

    run.__name__ = f"files_report_{name}"
    return run


def files_silver_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _check_trips(lake_flow.silver_of_mixed_files(spark, sf_dir))


def files_fact_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _check(lake_flow.fact_of_one_month(spark, sf_dir, REPORT_YEAR, 3))


_QUERIES: dict[str, Query] = {
    "bronze_normalized": bronze_normalized,
    "violation_reason_counts": violation_reason_counts,
    "bronze_clean": bronze_clean,
    "quarantine_schema": quarantine_schema,
    "ingest_counts": ingest_counts,
    "silver_rule_counts": silver_rule_counts,
    "silver_trips": silver_trips,
    "dim_zone": dim_zone,
    "gold_fact_trip_summary": gold_fact_trip_summary,
    "gold_fact_month": gold_fact_month,
    "fact_enriched": fact_enriched,
    "report_years": report_years,
    "report_kpis": report_kpis,
    "report_kpis_newest": report_kpis_newest,
    "report_kpis_empty": report_kpis_empty,
    "report_trend_weekend": _trend("is_weekend"),
    "report_trend_borough": _trend("pickup_borough"),
    "report_trend_dow": _trend("pickup_day_of_week"),
    "report_borough": report_borough,
    "report_hourly": report_hourly,
    "pending_periods": pending_periods,
    "missing_periods": missing_periods,
    "missing_event_periods": missing_event_periods,
    "available_periods": available_periods,
    "dedup_clean": dedup_clean,
    "dedup_quarantine": dedup_quarantine,
    "files_landing": lake_flow.landing_files,
    "files_bronze": _stored("bronze"),
    "files_quarantine": _stored("quarantine"),
    "files_silver": _stored("silver"),
    "files_silver_mixed": files_silver_mixed,
    "files_fact": _stored("fact"),
    "files_fact_month": files_fact_month,
    "files_dim": _stored("dim"),
    "files_periods": lake_flow.table_periods,
    "files_run_log": lake_flow.run_log,
    "files_run_history": lake_flow.run_history,
    "files_audit": lake_flow.audit,
    "files_report_years": _stored_report("years"),
    "files_report_kpis": _stored_report("kpis"),
    "files_report_trend": _stored_report("trend"),
    "files_report_borough": _stored_report("borough"),
    "files_report_hourly": _stored_report("hourly"),
}

QUERIES: dict[str, Query] = {name: _in_utc(query) for name, query in _QUERIES.items()}
