"""Run configuration from scheduler-templated strings (blank / "None" = unset)."""

from __future__ import annotations

from tidewater.plans.common import LakePaths
from tidewater.plans.orchestrate import RunConfig, optional_int, optional_str


def test_blank_and_none_strings_are_unset():
    assert optional_int("") is None and optional_int("None") is None and optional_int(None) is None
    assert optional_int(" 2024 ") == 2024
    assert optional_str("  ") is None and optional_str("None") is None
    assert optional_str("batch-7") == "batch-7"


def test_run_config_from_strings():
    paths = LakePaths.under("/lake")
    cfg = RunConfig.from_strings(paths, batch_id="None", year="2024", month="", dedup=True)
    assert cfg.batch_id is None and cfg.year == 2024 and cfg.month is None and cfg.dedup
    assert paths.quarantine == "/lake/quarantine/trip" and paths.fact == "/lake/gold/fact_trip_summary"
    assert paths.lookup == "/lake/reference/taxi_zone_lookup.csv"
