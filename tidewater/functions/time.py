"""Duration and calendar features of a trip.

Calendar features follow the session time zone; pin
``spark.sql.session.timeZone`` (UTC in this project's sessions) so results do
not depend on the machine the driver runs on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since the epoch; the fraction of a second is dropped."""
    return F.unix_seconds(ts)


def duration_minutes(pickup: Column, dropoff: Column) -> Column:
    """(drop-off − pickup) in minutes, from whole-second epochs, as double."""
    return (epoch_seconds(dropoff) - epoch_seconds(pickup)) / F.lit(60.0)


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def day_of_week(ts: Column) -> Column:
    """1 = Sunday … 7 = Saturday."""
    return F.dayofweek(ts)


# --- fixed values: weekend days, Sunday and Saturday --------------------------
WEEKEND = (1, 7)


def weekend_flag(dow: Column) -> Column:
    """True on Sunday and Saturday; an unknown day is no weekend day."""
    return F.coalesce(dow.isin(*WEEKEND), F.lit(False))
