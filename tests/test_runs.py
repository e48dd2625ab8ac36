"""Months that are replaced without a hole, runs side by side, counts made in the
write, and stages that are tried again."""

from __future__ import annotations

import os
import threading
import time

import pytest

from test_ingest import _drifting_landing, _trips, _write
from tidewater.operators.periods import PERIOD
from tidewater.plans import bronze, claims, gold, orchestrate, reports, silver
from tidewater.plans.orchestrate import RunConfig, run
from tidewater.sinks import publish
from tidewater.sinks.writers import counted, laid_out
from tidewater.sources.tables import period_dirs, read_table


def _months(spark, root):
    table = read_table(spark, root)
    return {} if table is None else {(r["year"], r["month"]): r["count"] for r in table.groupBy(*PERIOD).count().collect()}


def _frame(spark, rows):
    return spark.createDataFrame(rows, "v int, year int, month int")


def test_publish_replaces_whole_months_and_only_these(spark, tmp_path):
    root = str(tmp_path / "t")
    first = publish.stage_months(_frame(spark, [(1, 2031, 1), (2, 2031, 2), (3, 2031, 3)]), root, [(2031, 1), (2031, 2), (2031, 3)])
    assert period_dirs(spark, root) == set() and first.rows == {(2031, 1): 1, (2031, 2): 1, (2031, 3): 1}
    publish.publish(spark, first)
    again = publish.stage_months(_frame(spark, [(4, 2031, 1), (5, 2031, 1)]), root, [(2031, 1), (2031, 2)])
    assert _months(spark, root) == {(2031, 1): 1, (2031, 2): 1, (2031, 3): 1}  # until it is published
    assert again.rows == {(2031, 1): 2, (2031, 2): 0}
    publish.publish(spark, again)
    assert _months(spark, root) == {(2031, 1): 2, (2031, 3): 1}  # month 2 came out empty
    assert sorted(os.listdir(root)) == ["year=2031"]


def test_lost_driver_between_the_renames(spark, tmp_path, monkeypatch):
    root, month = str(tmp_path / "t"), [(2031, 1)]
    publish.publish(spark, publish.stage_months(_frame(spark, [(1, 2031, 1)]), root, month))
    new = publish.stage_months(_frame(spark, [(2, 2031, 1)]), root, month)
    moves, real = [], publish._move

    def one_move_only(fs, source, target):
        if moves:
            raise RuntimeError("lost the driver")
        moves.append(source)
        real(fs, source, target)

    with monkeypatch.context() as m:
        m.setattr(publish, "_move", one_move_only)
        with pytest.raises(RuntimeError):
            publish.publish(spark, new)
    assert publish.recover(spark, root, [(2031, 2)]) == []  # not its month
    assert publish.recover(spark, root, month) == month
    assert [r["v"] for r in read_table(spark, root).collect()] == [1]
    assert publish.recover(spark, root, month) == []
    publish.publish(spark, publish.stage_months(_frame(spark, [(3, 2031, 1)]), root, month))
    assert [r["v"] for r in read_table(spark, root).collect()] == [3]


@pytest.mark.parametrize("stage", [bronze, silver])
def test_a_redo_that_fails_keeps_the_old_month_readable(spark, lake, monkeypatch, stage):
    _drifting_landing(lake.landing)
    bronze.ingest(spark, lake, batch_id="old")
    silver.transform(spark, lake, batch_id="old")
    root = lake.bronze if stage is bronze else lake.silver
    before = _months(spark, root)

    def crash(*_):
        raise RuntimeError("lost the driver before the exchange")

    redo = bronze.ingest if stage is bronze else silver.transform
    with monkeypatch.context() as m:
        m.setattr(stage, "publish", crash)
        with pytest.raises(RuntimeError):
            redo(spark, lake, batch_id="new", force=True)
    assert _months(spark, root) == before
    assert {r["batch_id"] for r in read_table(spark, root).select("batch_id").distinct().collect()} == {"old"}
    redo(spark, lake, batch_id="newer", force=True)
    assert _months(spark, root) == before
    assert {r["batch_id"] for r in read_table(spark, root).select("batch_id").distinct().collect()} == {"newer"}


def test_a_reader_finds_every_month_while_it_is_redone(spark, lake):
    _drifting_landing(lake.landing)
    bronze.ingest(spark, lake)
    seen, done = [], threading.Event()

    def look():
        while not done.is_set():
            seen.append(len(period_dirs(spark, lake.bronze)))

    reader = threading.Thread(target=look)
    reader.start()
    bronze.ingest(spark, lake, force=True)
    done.set()
    reader.join()
    # an exchange is two renames; a look between them may miss the one month
    assert len(seen) > 20 and min(seen) >= 3


def test_concurrent_ingests_do_each_month_once(spark, lake):
    for month in range(1, 7):
        _write(lake.landing, f"yellow_tripdata_2026-0{month}.parquet", _trips(month + 2, month))
    results, start = {}, threading.Barrier(2)

    def ingest(name):
        start.wait()
        results[name] = bronze.ingest(spark, lake, batch_id=name)

    threads = [threading.Thread(target=ingest, args=(n,)) for n in ("a", "b")]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    done = sorted(results["a"].periods + results["b"].periods)
    assert done == [(2026, m) for m in range(1, 7)]
    assert results["a"].records_processed + results["b"].records_processed == sum(range(3, 9))
    assert _months(spark, lake.bronze) == {(2026, m): m + 2 for m in range(1, 7)}
    table = read_table(spark, lake.bronze).select(*PERIOD, "batch_id").distinct().collect()
    assert len(table) == 6  # one batch for each month
    assert not any(files for _, _, files in os.walk(lake.claims))


def test_months_of_another_run_are_left_to_it(spark, lake, monkeypatch):
    _drifting_landing(lake.landing)
    with claims.claimed(spark, lake, "bronze", [(2026, 1), (2026, 2)], "other") as others:
        assert others == [(2026, 1), (2026, 2)]
        result = bronze.ingest(spark, lake)
        assert result.busy == others and result.periods == [(2026, 3), (2026, 4)]
        with claims.claimed(spark, lake, "silver", [(2026, 3)], "other"):
            transformed = silver.transform(spark, lake)
            assert transformed.busy == [(2026, 3)] and transformed.periods == [(2026, 4)]
    assert bronze.ingest(spark, lake).periods == [(2026, 1), (2026, 2)]
    # the claim of a run that was lost expires
    holder = claims.claimed(spark, lake, "silver", [(2026, 3)], "lost")
    holder.__enter__()
    time.sleep(1.1)
    assert silver.transform(spark, lake, year=2026, month=3).busy == [(2026, 3)]
    monkeypatch.setattr(claims, "CLAIM_HOURS", 1 / 3600)
    assert silver.transform(spark, lake, year=2026, month=3).periods == [(2026, 3)]


@pytest.mark.parametrize("layout", ["scan", "rebalance"])
@pytest.mark.parametrize("n_months", [0, 1, 150])
def test_counts_are_made_in_the_write(spark, tmp_path, layout, n_months):
    rows = [(k, 1900 + k // 12, k % 12 + 1) for k in range(n_months) for _ in range(1 + k % 5)]
    frame, read = counted(laid_out(_frame(spark, rows).repartition(6), layout), n_months)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("count", "one write")
    try:
        frame.write.partitionBy(*PERIOD).parquet(str(tmp_path / "t"))
        jobs = len(tracker.getJobIdsForGroup("count"))
        assert read() == {(1900 + k // 12, k % 12 + 1): 1 + k % 5 for k in range(n_months)}
        assert len(tracker.getJobIdsForGroup("count")) == jobs
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_years_of_a_stored_fact_start_no_scan(spark, lake):
    _drifting_landing(lake.landing)
    _write(lake.landing, "yellow_tripdata_2024-12.parquet", _trips(3, 12))
    run(spark, RunConfig(paths=lake))
    years = reports.report_years(spark, lake)
    fact, _ = reports.load_gold(spark, lake)
    assert [r["year"] for r in years.collect()] == [r["year"] for r in reports.available_years(fact).collect()] == [2026, 2024]
    assert "FileScan" not in years._jdf.queryExecution().executedPlan().toString()
    assert years.schema == reports.available_years(fact).schema


def test_a_stage_that_fails_once_completes_the_run(spark, lake, monkeypatch):
    _drifting_landing(lake.landing)
    calls, waits, real = [], [], silver.transform

    def flaky(*args, **kw):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("executors lost")
        return real(*args, **kw)

    monkeypatch.setattr(orchestrate, "sleep", waits.append)
    monkeypatch.setattr(silver, "transform", flaky)
    done = run(spark, RunConfig(paths=lake, retry_delay_sec=7))
    assert len(calls) == 2 and waits == [7]
    assert done["silver"].partitions_processed == 4 and done["gold"].partitions_processed == 4
    with pytest.raises(RuntimeError):  # no attempt left
        calls.clear()
        run(spark, RunConfig(paths=lake, retries=0))


def test_wrong_input_is_not_tried_again(spark, lake, monkeypatch):
    monkeypatch.setattr(orchestrate, "sleep", lambda s: pytest.fail("waited"))
    with pytest.raises(FileNotFoundError):
        run(spark, RunConfig(paths=lake))
    _write(lake.landing, "yellow_tripdata_26-1.parquet", _trips(2, 1))
    with pytest.raises(ValueError):
        run(spark, RunConfig(paths=lake))


def test_attempts_end_with_the_last_error(monkeypatch):
    monkeypatch.setattr(orchestrate, "sleep", lambda s: None)
    calls = []

    def failing():
        calls.append(1)
        raise OSError(len(calls))

    with pytest.raises(OSError, match="3"):
        orchestrate.attempted("stage", failing, 2, 0.0)
    assert orchestrate.attempted("stage", lambda: "ok", 0, 0.0) == "ok"


def test_gold_after_concurrent_silver_is_whole(spark, lake):
    _drifting_landing(lake.landing)
    bronze.ingest(spark, lake)
    threads = [threading.Thread(target=silver.transform, args=(spark, lake)) for _ in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert _months(spark, lake.silver) == {(2026, 1): 10, (2026, 2): 10, (2026, 3): 10, (2026, 4): 2}
    assert gold.transform(spark, lake).partitions_processed == 4
