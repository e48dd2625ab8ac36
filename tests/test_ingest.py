"""Landing → Bronze ingestion on hand-made landing files (FIXTURES §A7)."""

from __future__ import annotations

import os
from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tidewater.plans import bronze
from tidewater.sources.tables import read_table


def _write(landing: str, name: str, columns: dict[str, pa.Array]) -> str:
    path = os.path.join(landing, name)
    pq.write_table(pa.table(columns), path)
    return path


def _trips(n: int, month: int, *, count_type=pa.int64(), ts_tz: str | None = None, fee: str | None = "airport_fee",
           passenger=None, dropoff_loc=None, fare=None):
    pick = [datetime(2026, month, 1 + i % 27, 8, i % 60) for i in range(n)]
    drop = [datetime(2026, month, 1 + i % 27, 9, i % 60) for i in range(n)]
    cols = {
        "VendorID": pa.array([1 + i % 2 for i in range(n)], pa.int64()),
        "tpep_pickup_datetime": pa.array(pick, pa.timestamp("us", tz=ts_tz)),
        "tpep_dropoff_datetime": pa.array(drop, pa.timestamp("us", tz=ts_tz)),
        "passenger_count": pa.array(passenger if passenger is not None else [1 + i % 3 for i in range(n)], count_type),
        "trip_distance": pa.array([1.0 + i for i in range(n)], pa.float64()),
        "RatecodeID": pa.array([1] * n, count_type),
        "store_and_fwd_flag": pa.array(["N"] * n),
        "PULocationID": pa.array([10 + i % 5 for i in range(n)], pa.int64()),
        "DOLocationID": pa.array(dropoff_loc if dropoff_loc is not None else [20 + i % 5 for i in range(n)], pa.int64()),
        "payment_type": pa.array([1] * n, pa.int64()),
        "fare_amount": pa.array(fare if fare is not None else [10.0 + i for i in range(n)], pa.float64()),
        "extra": pa.array([0.5] * n), "mta_tax": pa.array([0.5] * n), "tip_amount": pa.array([1.0] * n),
        "tolls_amount": pa.array([0.0] * n), "improvement_surcharge": pa.array([0.3] * n),
        "congestion_surcharge": pa.array([2.5] * n),
        "total_amount": pa.array([15.0 + i for i in range(n)], pa.float64()),
    }
    if fee:
        cols[fee] = pa.array([1.25] * n, pa.float64())
    return cols


def _drifting_landing(landing: str) -> None:
    _write(landing, "yellow_tripdata_2026-01.parquet", _trips(10, 1, count_type=pa.int64()))
    _write(landing, "yellow_tripdata_2026-02.parquet",
           _trips(10, 2, count_type=pa.float64(), ts_tz="UTC", fee="Airport_fee"))
    _write(landing, "yellow_tripdata_2026-03.parquet", _trips(10, 3, count_type=pa.float64(), fee=None))
    _write(landing, "yellow_tripdata_2026-04.parquet",
           _trips(4, 4, count_type=pa.float64(), ts_tz="UTC", fee=None,
                  passenger=[1.0, None, 2.0, None], dropoff_loc=[20, 21, 22, None]))


def test_schema_drift_one_bronze_table(spark, lake):
    _drifting_landing(lake.landing)
    result = bronze.ingest(spark, lake, batch_id="b-1")
    assert result.landing_files == 4 and result.files_skipped == 0
    assert result.records_processed == 32
    assert result.schema_violations == 2
    table = read_table(spark, lake.bronze)
    assert table.count() == 32
    by_month = {(r["year"], r["month"]): r["count"] for r in table.groupBy("year", "month").count().collect()}
    assert by_month == {(2026, 1): 10, (2026, 2): 10, (2026, 3): 10, (2026, 4): 2}
    fees = {r["month"]: r["fee"] for r in table.groupBy("month").agg({"airport_fee": "max"})
            .withColumnRenamed("max(airport_fee)", "fee").collect()}
    assert fees[1] == 1.25 and fees[2] == 1.25 and fees[3] is None
    reasons = sorted(r["failure_reason"] for r in read_table(spark, lake.schema_violations).collect())
    assert reasons == ["passenger_count", "passenger_count, dolocationid"]
    assert {r["batch_id"] for r in table.select("batch_id").distinct().collect()} == {"b-1"}
    assert table.filter("source_file NOT LIKE '%yellow_tripdata_2026-0_.parquet'").count() == 0
    # timestamps from a tz-aware and a naive file read as the same wall clock (UTC session)
    feb = table.filter("month = 2").orderBy("pickup_datetime").first()
    assert feb["pickup_datetime"] == datetime(2026, 2, 1, 8, 0)


def test_rerun_skips_done_months_and_takes_new_ones(spark, lake):
    _drifting_landing(lake.landing)
    bronze.ingest(spark, lake)
    again = bronze.ingest(spark, lake)
    assert again.files_skipped == 4 and again.records_processed == 0
    _write(lake.landing, "yellow_tripdata_2026-05.parquet", _trips(3, 5))
    third = bronze.ingest(spark, lake)
    assert third.files_skipped == 4 and third.records_processed == 3
    assert read_table(spark, lake.bronze).count() == 35
    assert read_table(spark, lake.schema_violations).count() == 2


def test_malformed_value_is_quarantined(spark, lake):
    cols = _trips(3, 6)
    cols["passenger_count"] = pa.array(["1", "abc", "2.7"])
    _write(lake.landing, "yellow_tripdata_2026-06.parquet", cols)
    result = bronze.ingest(spark, lake)
    assert result.records_processed == 2 and result.schema_violations == 1
    counts = sorted(r["passenger_count"] for r in read_table(spark, lake.bronze).collect())
    assert counts == [1, 2]


def test_bad_name_fails_before_any_write(spark, lake):
    _drifting_landing(lake.landing)
    _write(lake.landing, "yellow_tripdata_2024-1.parquet", _trips(2, 1))
    with pytest.raises(ValueError):
        bronze.ingest(spark, lake)
    assert read_table(spark, lake.bronze) is None
    assert read_table(spark, lake.schema_violations) is None


def test_no_landing_files(spark, lake):
    with pytest.raises(FileNotFoundError):
        bronze.ingest(spark, lake)


def test_all_invalid_month_is_not_reingested(spark, lake):
    _write(lake.landing, "yellow_tripdata_2026-07.parquet", _trips(3, 7, fare=[None, None, None]))
    first = bronze.ingest(spark, lake)
    assert first.records_processed == 0 and first.schema_violations == 3
    assert read_table(spark, lake.bronze) is None
    second = bronze.ingest(spark, lake)
    assert second.files_skipped == 1
    assert read_table(spark, lake.schema_violations).count() == 3


def test_crash_between_quarantine_and_bronze_recovers(spark, lake, monkeypatch):
    """A write that fails after another has finished leaves both tables as they
    were, and the next run does the whole of it."""
    _drifting_landing(lake.landing)
    real_stage = bronze.stage_months

    def failing(frame, root, *rest, **kw):
        if root == lake.bronze:
            raise RuntimeError("executor lost")
        return real_stage(frame, root, *rest, **kw)

    monkeypatch.setattr(bronze, "stage_months", failing)
    with pytest.raises(RuntimeError):
        bronze.ingest(spark, lake)
    assert read_table(spark, lake.schema_violations) is None and read_table(spark, lake.bronze) is None
    monkeypatch.setattr(bronze, "stage_months", real_stage)
    result = bronze.ingest(spark, lake)
    assert result.files_skipped == 0 and result.records_processed == 32 and result.schema_violations == 2
    assert read_table(spark, lake.schema_violations).count() == 2
    assert read_table(spark, lake.bronze).count() == 32
    assert not os.path.exists(f"{lake.bronze}/_staging") and not os.path.exists(f"{lake.schema_violations}/_staging")


def test_duplicates_are_quarantined_when_enabled(spark, lake):
    cols = _trips(5, 8)
    doubled = {k: pa.concat_arrays([v, v.slice(0, 2)]) for k, v in cols.items()}
    _write(lake.landing, "yellow_tripdata_2026-08.parquet", doubled)
    result = bronze.ingest(spark, lake, dedup=True)
    assert result.records_processed == 5 and result.duplicates == 2
    dups = read_table(spark, lake.duplicate_records)
    assert dups.count() == 2
    assert {r["failure_mode"] for r in dups.collect()} == {"duplicate_record"}


def test_compatible_files_are_read_in_one_scan(spark, lake):
    from tidewater.plans.bronze import normalized_landing
    from tidewater.sources.landing import list_landing_files, read_landing

    _write(lake.landing, "yellow_tripdata_2026-01.parquet", _trips(4, 1, fee="airport_fee"))
    _write(lake.landing, "yellow_tripdata_2026-02.parquet", _trips(3, 2, fee=None))
    _write(lake.landing, "yellow_tripdata_2026-03.parquet", _trips(2, 3, fee="Airport_fee"))
    files = list_landing_files(spark, lake.landing)
    assert len(read_landing(spark, files)) == 1
    rows = normalized_landing(spark, files, "b").groupBy("month").agg({"airport_fee": "max"}).collect()
    fees = {r["month"]: r["max(airport_fee)"] for r in rows}
    assert fees == {1: 1.25, 2: None, 3: 1.25}


def test_months_written_by_another_tool(spark, lake):
    """A Bronze month counts as done whoever wrote it; ``force`` replaces it."""
    from tidewater.operators.split import bronze_rows
    from tidewater.plans.bronze import normalized_landing
    from tidewater.sinks.writers import write_partitioned
    from tidewater.sources.landing import list_landing_files

    _write(lake.landing, "yellow_tripdata_2026-01.parquet", _trips(5, 1))
    files = list_landing_files(spark, lake.landing)
    external = bronze_rows(normalized_landing(spark, files, "external")).limit(2)
    write_partitioned(external, lake.bronze)  # 2 rows, no run-log entry
    adopted = bronze.ingest(spark, lake)
    assert adopted.files_skipped == 1 and read_table(spark, lake.bronze).count() == 2
    replaced = bronze.ingest(spark, lake, force=True)
    assert replaced.files_skipped == 0 and replaced.records_processed == 5
    assert read_table(spark, lake.bronze).count() == 5


def test_one_landing_file_per_month(spark, lake, tmp_path):
    """Of two files for a month the first by path counts, with and without
    dedup; a name that only ends like a landing file is refused."""
    from tidewater.sources.landing import LandingFile, list_landing_files

    other = str(tmp_path / "other")
    os.makedirs(other)
    _write(lake.landing, "yellow_tripdata_2026-05.parquet", _trips(4, 5))
    _write(other, "yellow_tripdata_2026-05.parquet", _trips(9, 5))
    first = list_landing_files(spark, lake.landing)
    files = first + [LandingFile("file:" + f"{other}/yellow_tripdata_2026-05.parquet", 2026, 5)]
    assert sorted(files, key=lambda f: f.path)[0] == first[0]
    for dedup in (False, True):
        result = bronze.ingest_files(spark, files, lake, dedup=dedup, force=True)
        assert (result.files_skipped, result.records_processed) == (1, 4)
        assert read_table(spark, lake.bronze).count() == 4
    _write(lake.landing, "yellow_tripdata_yellow_tripdata_2026-05.parquet", _trips(3, 5))
    with pytest.raises(ValueError, match="yellow_tripdata_yellow"):
        bronze.ingest(spark, lake)


@pytest.mark.parametrize("name", ["yellow_tripdata_2026-13.parquet", "yellow_tripdata_2026-00.parquet", "yellow_tripdata_26-01.parquet"])
def test_impossible_months_are_refused(name):
    from tidewater.sources.landing import parse_period

    with pytest.raises(ValueError):
        parse_period(name)


def test_quarantine_has_one_file_a_month(spark, lake):
    for month in (1, 2, 3):
        _write(lake.landing, f"yellow_tripdata_2026-0{month}.parquet", _trips(6, month, passenger=[None, 1, None, 1, None, 1]))
    bronze.ingest(spark, lake)
    files = read_table(spark, lake.schema_violations).inputFiles()
    assert len(files) == 3 and len({f.rsplit("/", 1)[0] for f in files}) == 3


def test_unreadable_landing_file_is_reported_as_such(spark, lake):
    _write(lake.landing, "yellow_tripdata_2026-01.parquet", _trips(2, 1))
    with open(os.path.join(lake.landing, "yellow_tripdata_2026-02.parquet"), "wb") as f:
        f.write(b"not parquet at all")
    with pytest.raises(Exception, match="(?i)footer|parquet"):
        bronze.ingest(spark, lake)


def test_hot_duplicate_key_holding_a_third_of_the_rows(spark, lake):
    """One trip repeated as a third of a month: one copy kept, every other copy
    quarantined, nothing dropped or capped."""
    from tidewater.plans import gold, silver

    base = _trips(40, 9)
    hot = {k: pa.concat_arrays([v] + [v.slice(0, 1)] * 20) for k, v in base.items()}  # 60 rows, 21 of trip 0
    _write(lake.landing, "yellow_tripdata_2026-09.parquet", hot)
    result = bronze.ingest(spark, lake, dedup=True)
    assert result.records_processed == 40 and result.duplicates == 20
    dups = read_table(spark, lake.duplicate_records)
    assert dups.count() == 20
    assert dups.select("pickup_datetime", "fare_amount").distinct().count() == 1
    silver.transform(spark, lake)
    gold.transform(spark, lake)
    fact = read_table(spark, lake.fact)
    assert fact.agg({"total_revenue": "sum"}).first()[0] == sum(15.0 + i for i in range(40))


@pytest.mark.parametrize(
    "first,second",
    [(pa.int32(), pa.int64()), (pa.int64(), pa.float64()), (pa.float32(), pa.float64()), (pa.int32(), pa.float64())],
)
def test_numeric_type_drift_is_read_per_schema(spark, lake, first, second):
    from tidewater.plans.bronze import normalized_landing
    from tidewater.sources.landing import list_landing_files, read_landing

    for month, kind in ((1, first), (2, second)):
        _write(lake.landing, f"yellow_tripdata_2026-0{month}.parquet", _trips(3, month, count_type=kind))
    files = list_landing_files(spark, lake.landing)
    assert len(read_landing(spark, files)) == 2
    counts = sorted(r["passenger_count"] for r in normalized_landing(spark, files, "b").collect())
    assert counts == [1, 1, 2, 2, 3, 3]


def test_month_failing_every_rule_is_not_reprocessed(spark, lake):
    from tidewater.plans import silver

    _write(lake.landing, "yellow_tripdata_2026-10.parquet", _trips(3, 10, passenger=[0, 0, 0]))
    _write(lake.landing, "yellow_tripdata_2026-11.parquet", _trips(3, 11))
    bronze.ingest(spark, lake)
    first = silver.transform(spark, lake)
    assert first.periods == [(2026, 10), (2026, 11)] and first.rows_written == 3
    assert read_table(spark, lake.silver).select("month").distinct().count() == 1
    again = silver.transform(spark, lake)
    assert again.partitions_processed == 0 and again.skipped == [(2026, 10), (2026, 11)]


def test_run_log_has_one_row_per_stage_and_month(spark, lake):
    from tidewater.sinks.writers import log_run
    from tidewater.sources.tables import run_log_summary

    for turn in range(3):
        log_run(spark, lake.run_log, "silver", {(2025, m): (m + turn, 0) for m in (1, 2)}, f"b{turn}", {(2025, 1): "src"})
        log_run(spark, lake.run_log, "gold", {(2025, 1): (None, None)}, f"g{turn}")
    assert read_table(spark, lake.run_log).count() == 3
    summary = run_log_summary(spark, lake.run_log)
    one = summary["silver"][(2025, 1)]
    assert (one.rows_written, one.batch_id, one.source_batch_id) == (3, "b2", "src")
    assert summary["silver"][(2025, 2)].source_batch_id is None and summary["gold"][(2025, 1)].rows_written is None
