"""The driver contract: entry smoke, registry ↔ oracle, and every registered
query against its DuckDB oracle on the sf0.001 tables."""

from __future__ import annotations

import math
import os
import subprocess
import sys
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import SF_SMALL
from tidewater.plans import catalog

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def test_entry_runs(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["pickup_borough", "total_revenue", "total_trips"]
    assert len(frame.collect()) == 6


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) <= set(contract.queries()) and set(catalog.QUERIES) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_registry_without_the_training_data_operators():
    """Without their subpackage the other queries are registered as before."""
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name in ("corpus_pipeline", "tidewater.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as entry
from tidewater.plans import catalog
assert set(entry.queries()) == set(catalog.QUERIES) and set(entry.oracle_sql()) == set(catalog.QUERIES)
"""
    repo = os.path.dirname(os.path.abspath(contract.__file__))
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=repo, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]


def _canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 9)
        return v.isoformat() if hasattr(v, "isoformat") else v

    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    frame = contract.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in frame.collect()]
    result = duck.execute(contract.oracle_sql()[name])
    d_cols = [d[0] for d in result.description]
    d_rows = result.fetchall()
    assert sorted(frame.columns) == sorted(d_cols)
    assert len(rows) == len(d_rows)
    assert _canon(frame.columns, rows) == _canon(d_cols, d_rows)


@pytest.mark.parametrize("name", ["silver_trips", "bronze_clean", "gold_fact_trip_summary", "report_hourly"])
def test_queries_do_not_depend_on_the_session_time_zone(spark, duck, name):
    key = "spark.sql.session.timeZone"
    spark.conf.set(key, "America/New_York")
    try:
        frame = contract.queries()[name](spark, SF_SMALL)
        rows = [tuple(r) for r in frame.collect()]
        assert spark.conf.get(key) == "America/New_York"  # caller's setting restored
    finally:
        spark.conf.set(key, "UTC")
    result = duck.execute(contract.oracle_sql()[name])
    d_cols = [d[0] for d in result.description]
    assert _canon(frame.columns, rows) == _canon(d_cols, result.fetchall())
