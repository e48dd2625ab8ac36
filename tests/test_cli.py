"""The command line runs the stages and prints JSON results."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from test_ingest import _trips, _write

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_cli_run_then_report(tmp_path):
    root = tmp_path / "lake"
    landing = root / "landing" / "trip"
    landing.mkdir(parents=True)
    _write(str(landing), "yellow_tripdata_2026-01.parquet", _trips(6, 1))
    env = dict(os.environ, PYTHONPATH=REPO)
    base = [sys.executable, "-m", "tidewater"]
    common = ["--root", str(root), "--year", "2026", "--month", "None"]
    out = subprocess.run(base + ["run"] + common, capture_output=True, text=True, env=env, timeout=600, cwd=REPO)
    assert out.returncode == 0, out.stderr[-2000:]
    result = json.loads(out.stdout.strip().splitlines()[-1])
    assert result["ingest"]["records_processed"] == 6
    assert result["gold"]["partitions_processed"] == 1
    rep = subprocess.run(base + ["report"] + common, capture_output=True, text=True, env=env, timeout=600, cwd=REPO)
    assert rep.returncode == 0, rep.stderr[-2000:]
    lines = [json.loads(line) for line in rep.stdout.strip().splitlines()]
    kpis = [line["kpis"] for line in lines if "kpis" in line][0][0]
    assert kpis["total_trips"] == 6


def test_cli_stream_ingests_available_files(tmp_path):
    root = tmp_path / "lake"
    landing = root / "landing" / "trip"
    landing.mkdir(parents=True)
    _write(str(landing), "yellow_tripdata_2026-02.parquet", _trips(4, 2))
    env = dict(os.environ, PYTHONPATH=REPO)
    out = subprocess.run(
        [sys.executable, "-m", "tidewater", "stream", "--root", str(root)],
        capture_output=True, text=True, env=env, timeout=600, cwd=REPO,
    )
    assert out.returncode == 0, out.stderr[-2000:]
    result = json.loads(out.stdout.strip().splitlines()[-1])
    assert result == {"records_processed": 4, "batches": 1}
    assert (root / "_checkpoints" / "landing_stream").is_dir()
