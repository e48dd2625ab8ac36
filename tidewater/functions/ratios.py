"""NULL-safe arithmetic for report measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zero_if_null(value: Column, zero: float | int = 0) -> Column:
    return F.coalesce(value, F.lit(zero))


def guarded_ratio(numerator: Column, denominator: Column, when_zero: float | None = None) -> Column:
    """numerator / denominator; ``when_zero`` (NULL by default) for a zero or
    NULL denominator instead of an error or an infinity."""
    ratio = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    if when_zero is None:
        return ratio
    return F.when(denominator > 0, ratio).otherwise(F.lit(float(when_zero)))
