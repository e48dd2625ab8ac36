"""Files that disagree on their columns or types: within a month, between months,
and by the thousand."""

from __future__ import annotations

import json
import os
import subprocess
import sys
from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from test_plans import plan_of
from tidewater.plans import silver
from tidewater.plans.common import LakePaths
from tidewater.schemas import BRONZE_SCHEMA, SILVER_COLUMNS
from tidewater.sources import footers
from tidewater.sources.landing import LandingFile, group_by_schema, read_landing
from tidewater.sources.tables import read_resolved, read_table


def _file(root, month, name, **columns):
    directory = f"{root}/year=2031/month={month}"
    os.makedirs(directory, exist_ok=True)
    pq.write_table(pa.table({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()}), f"{directory}/{name}.parquet")


def _trip(minutes=(30,), **more):
    """Bronze columns of trips that pass every rule, without a schema family."""
    n = len(minutes)
    start = datetime(2031, 1, 6, 8)
    columns = {
        "vendor_name": pa.nulls(n, pa.string()), "vendor_id": pa.array([1] * n, pa.int32()),
        "pickup_datetime": pa.array([start] * n, pa.timestamp("us", tz="UTC")),
        "dropoff_datetime": pa.array([start.replace(minute=m) for m in minutes], pa.timestamp("us", tz="UTC")),
        "passenger_count": pa.array([2] * n, pa.int32()), "ratecode_id": pa.array([1] * n, pa.int32()),
        "store_and_fwd_flag": pa.array(["N"] * n), "payment_type": pa.array([1] * n, pa.int32()),
        "pulocationid": pa.array([3] * n, pa.int32()), "dolocationid": pa.array([4] * n, pa.int32()),
    }
    for name in ("trip_distance", "fare_amount", "total_amount", "extra", "mta_tax", "tolls_amount", "improvement_surcharge",
                 "congestion_surcharge", "airport_fee"):
        columns[name] = pa.array([2.5] * n)
    return columns | more


def test_no_column_of_any_file_is_lost(spark, tmp_path):
    """Two files of month 1, one with tips; another month with another type."""
    root = str(tmp_path / "bronze")
    _file(root, 1, "a", vendor_id=pa.array([1], pa.int32()), fare_amount=[5.0])
    _file(root, 1, "b", vendor_id=pa.array([2], pa.int32()), fare_amount=[6.0], tip_amount=[9.0])
    alone = read_resolved(spark, root, [(2031, 1)], BRONZE_SCHEMA)
    assert sorted((r["vendor_id"], r["tip_amount"]) for r in alone.collect()) == [(1, None), (2, 9.0)]
    _file(root, 2, "c", vendor_id=pa.array(["3"]), fare_amount=pa.array([7], pa.int64()))
    together = read_resolved(spark, root, [(2031, 1), (2031, 2)], BRONZE_SCHEMA)
    got = sorted((r["vendor_id"], r["fare_amount"], r["tip_amount"], r["month"]) for r in together.collect())
    assert got == [(1, 5.0, None, 1), (2, 6.0, 9.0, 1), (3, 7.0, None, 2)]


def test_a_month_whose_own_files_conflict(spark, tmp_path):
    root = str(tmp_path / "bronze")
    for k, kind in enumerate((pa.int32(), pa.int64(), pa.float64(), pa.string())):
        _file(root, 1, f"f{k}", passenger_count=pa.array([str(k)]).cast(kind), vendor_id=pa.array([k], pa.int32()))
    got = read_resolved(spark, root, [(2031, 1)], BRONZE_SCHEMA)
    assert sorted((r["vendor_id"], r["passenger_count"]) for r in got.collect()) == [(k, k) for k in range(4)]


def test_family_default_is_for_files_without_the_column(spark, tmp_path):
    """A file without ``schema_family`` gets the default, whatever the files beside
    it hold; a NULL that a file does hold stays NULL."""
    paths = LakePaths.under(str(tmp_path / "lake"), lookup="")
    fees = {"tip_amount": pa.array([1.0]), "batch_id": pa.array(["b"])}
    _file(paths.bronze, 1, "old", **_trip((10,), **fees))
    _file(paths.bronze, 1, "new", **_trip((20,), **fees, schema_family=pa.array(["modern"])))
    _file(paths.bronze, 2, "old", **_trip((30,), **fees))
    _file(paths.bronze, 3, "new", **_trip((40, 50), tip_amount=pa.array([1.0, 1.0]), schema_family=pa.array(["modern", None])))
    assert silver.transform(spark, paths).rows_written == 5
    stored = read_table(spark, paths.silver)
    assert sorted(stored.columns) == sorted(SILVER_COLUMNS)
    got = {r["trip_duration_minutes"]: r["schema_family"] for r in stored.collect()}
    assert got == {10.0: "yellow_tripdata", 20.0: "modern", 30.0: "yellow_tripdata", 40.0: "modern", 50.0: None}


def test_rules_are_pushed_into_every_scan(spark, tmp_path):
    root = str(tmp_path / "bronze")
    fees = {"tip_amount": pa.array([1.0])}
    _file(root, 1, "a", **_trip(**fees))
    _file(root, 2, "b", **_trip(**fees, schema_family=pa.array(["modern"])))
    frame = silver.build_silver(read_resolved(spark, root, [(2031, 1), (2031, 2)], BRONZE_SCHEMA, silver.ABSENT), "b")
    plan = plan_of(frame)
    pushed = [line for line in plan.splitlines() if line.startswith("PushedFilters")]
    assert len(pushed) == 2 and all("GreaterThan(passenger_count,0)" in line for line in pushed) and "Exchange" not in plan


def _landing(directory, count, kinds=(pa.int64(), pa.float64(), pa.int32())):
    os.makedirs(directory)
    files = []
    for k in range(count):
        year, month = 2000 + k // 12, k % 12 + 1
        path = f"{directory}/yellow_tripdata_{year}-{month:02d}.parquet"
        pq.write_table(pa.table({"VendorID": pa.array([k], kinds[k % len(kinds)])}), path)
        files.append(LandingFile("file:" + path, year, month))
    return files


def test_a_thousand_conflicting_files_take_one_footer_job(spark, tmp_path):
    files = _landing(tmp_path / "landing", 1000)
    tracker, group = spark.sparkContext.statusTracker(), "footers"
    spark.sparkContext.setJobGroup(group, "footers of a thousand files")
    try:
        found = footers.group_files(spark, [f.path for f in files])
        jobs = len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert jobs == 1
    assert [len(g.paths) for g in found] == [334, 333, 333]
    assert {p for g in found for p in g.paths} == {f.path for f in files}
    scans = read_landing(spark, files)
    assert len(scans) == 3 and sum(s.count() for s in scans) == 1000
    assert [schema["VendorID"].dataType.simpleString() for schema, _ in group_by_schema(spark, files)] == ["bigint", "double", "int"]


def test_column_order_and_rows_do_not_change_a_signature(tmp_path):
    one, two, three = (str(tmp_path / f"{k}.parquet") for k in "abc")
    pq.write_table(pa.table({"x": [1, 2], "y": ["a", "b"]}), one)
    pq.write_table(pa.table({"y": ["c"], "x": [None, 5][1:]}), two)
    pq.write_table(pa.table({"y": ["c"], "x": pa.array([5], pa.int32())}), three)
    marks = [footers.footer_reader()(p) for p in (one, two, f"file:{three}")]
    assert marks[0] == marks[1] != marks[2]


def test_files_that_only_spark_opens_are_told_apart_by_spark(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "bronze")
    _file(root, 1, "a", vendor_id=pa.array([1], pa.int32()))
    _file(root, 1, "b", vendor_id=pa.array([2], pa.int64()), schema_family=["modern"])
    with monkeypatch.context() as m:
        m.setattr(footers, "footer_signatures", lambda files: files.selectExpr("path", "CAST(NULL AS STRING) AS signature"))
        got = read_resolved(spark, root, [(2031, 1)], BRONZE_SCHEMA, silver.ABSENT)
    assert sorted((r["vendor_id"], r["schema_family"]) for r in got.collect()) == [(1, "yellow_tripdata"), (2, "modern")]


def test_unreadable_file_is_reported(spark, tmp_path):
    root = str(tmp_path / "bronze")
    _file(root, 1, "a", vendor_id=[1])
    with open(f"{root}/year=2031/month=1/b.parquet", "wb") as f:
        f.write(b"no parquet")
    with pytest.raises(Exception, match="(?i)footer|parquet"):
        read_resolved(spark, root, [(2031, 1)], BRONZE_SCHEMA).collect()


def test_signatures_are_text(spark, tmp_path):
    files = _landing(tmp_path / "landing", 2)
    rows = footers.footer_signatures(spark.createDataFrame([(f.path,) for f in files] + [("nowhere://x/y",)], "path string")).collect()
    assert [len(r["signature"] or "") for r in sorted(rows, key=lambda r: r["path"])] == [64, 64, 0]
    assert json.dumps([r["path"] for r in rows])


def test_tasks_need_nothing_of_this_package(tmp_path):
    """Executors without the package can read footers: what is sent to them names
    no module of it."""
    from pyspark import cloudpickle

    sent = cloudpickle.dumps(footers.footer_reader())
    code = "import pickle, sys; pickle.loads(sys.stdin.buffer.read()); assert 'tidewater' not in sys.modules"
    alone = subprocess.run([sys.executable, "-c", code], input=sent, cwd=tmp_path, env={"PATH": os.environ["PATH"]}, capture_output=True, timeout=60)
    assert alone.returncode == 0, alone.stderr[-500:]
