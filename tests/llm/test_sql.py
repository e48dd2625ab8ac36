"""Queries that have SQL, against DuckDB; and the plans of the native ones."""

from __future__ import annotations

import io
from collections import Counter
from contextlib import redirect_stdout

import duckdb
import pytest

from tidewater.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    result = con.execute(queries.SQL[name])
    columns = [d[0] for d in result.description]
    frame = queries.QUERIES[name](spark, SF)
    assert sorted(frame.columns) == sorted(columns)
    assert Counter(map(tuple, frame.select(*columns).collect())) == Counter(result.fetchall())


@pytest.mark.parametrize("name", ["op1_quality_rules", "op4_line_dedup", "op11_mixing"])
def test_native_plans_have_no_python(spark, name):
    out = io.StringIO()
    with redirect_stdout(out):
        queries.QUERIES[name](spark, SF).explain()
    assert not any(x in out.getvalue() for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n != "pipeline"])
def test_no_query_pairs_rows_without_a_key(spark, name):
    out = io.StringIO()
    with redirect_stdout(out):
        frame = queries.QUERIES[name](spark, SF)
        frame.explain()
    assert frame.columns == list(dict.fromkeys(frame.columns))
    assert not any(x in out.getvalue() for x in ("CartesianProduct", "BroadcastNestedLoopJoin"))
