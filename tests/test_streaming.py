"""Landing ingestion driven by a file stream (availableNow trigger)."""

from __future__ import annotations

import os

from test_ingest import _trips, _write

from tidewater.sources.tables import read_table
from tidewater.streaming.landing_stream import ingest_stream


def test_stream_ingests_new_files_once(spark, lake, tmp_path):
    ckpt = str(tmp_path / "stream-ckpt")
    _write(lake.landing, "yellow_tripdata_2026-01.parquet", _trips(5, 1))
    _write(lake.landing, "yellow_tripdata_2026-02.parquet", _trips(4, 2))
    query, progress = ingest_stream(spark, lake, ckpt, max_files_per_trigger=1)
    query.awaitTermination()
    assert progress.records_processed == 9
    assert progress.batches == 2 and progress.last.landing_files == 1
    assert read_table(spark, lake.bronze).count() == 9

    _write(lake.landing, "yellow_tripdata_2026-03.parquet", _trips(3, 3))
    query, progress = ingest_stream(spark, lake, ckpt)
    query.awaitTermination()
    assert progress.records_processed == 3  # only the new file is offered
    assert read_table(spark, lake.bronze).count() == 12
    assert os.path.isdir(ckpt)
