"""Column expressions: every function here returns a ``Column`` built from
``pyspark.sql.functions`` so it stays inside whole-stage codegen."""

from tidewater.functions.casts import resolve_source_columns, safe_value, typed_null
from tidewater.functions.quality import (
    all_required_present,
    any_required_missing,
    cleansing_rules,
    passes_cleansing,
    violation_reason,
)
from tidewater.functions.ratios import guarded_ratio, zero_if_null
from tidewater.functions.time import (
    day_of_week,
    duration_minutes,
    epoch_seconds,
    hour_of_day,
    weekend_flag,
)

__all__ = [
    "all_required_present",
    "any_required_missing",
    "cleansing_rules",
    "day_of_week",
    "duration_minutes",
    "epoch_seconds",
    "guarded_ratio",
    "hour_of_day",
    "passes_cleansing",
    "resolve_source_columns",
    "safe_value",
    "typed_null",
    "violation_reason",
    "weekend_flag",
    "zero_if_null",
]
