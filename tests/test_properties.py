"""Property tests: the Spark stages against a plain-Python model on random
small inputs (NULLs, malformed text, fractions, negative and zero values)."""

from __future__ import annotations

import math
from collections import defaultdict
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.enrich import clean_and_enrich
from tidewater.operators.fact import aggregate_fact
from tidewater.operators.normalize import normalize_trips
from tidewater.operators.split import invalid_rows, valid_rows
from tidewater.schemas import REQUIRED_COLUMNS

LANDING = T.StructType(
    [
        T.StructField("VendorID", T.LongType()),
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("passenger_count", T.StringType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("PULocationID", T.LongType()),
        T.StructField("DOLocationID", T.LongType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
    ]
)

BASE = datetime(2026, 7, 1)
maybe = lambda s: st.one_of(st.none(), s)
money = st.sampled_from([-3.5, 0.0, 0.01, 2.5, 10.0, 99.99])
rows = st.lists(
    st.tuples(
        maybe(st.integers(1, 2)),
        maybe(st.integers(0, 60 * 24 * 6)),  # pickup offset, minutes
        st.integers(-30, 90),  # duration, minutes
        maybe(st.sampled_from(["0", "1", "2", "3.7", "abc", " 4 "])),
        maybe(st.sampled_from([0.0, 0.5, 3.0, 12.25])),
        maybe(st.integers(0, 3)),
        maybe(st.integers(0, 3)),
        maybe(money),
        maybe(money),
        maybe(money),
    ),
    min_size=0,
    max_size=25,
)


def _as_int(text):
    try:
        return int(math.trunc(float(text.strip())))
    except (AttributeError, ValueError):
        return None


def _model(raw):
    """(bronze rows, reasons) by plain Python."""
    out, reasons = [], []
    for vendor, start, minutes, pax, dist, pu, do, fare, tip, total in raw:
        pick = None if start is None else BASE + timedelta(minutes=start)
        drop = None if start is None else pick + timedelta(minutes=minutes)
        rec = {
            "vendor_id": vendor, "pickup_datetime": pick, "dropoff_datetime": drop,
            "passenger_count": _as_int(pax), "trip_distance": dist, "pulocationid": pu,
            "dolocationid": do, "fare_amount": fare, "tip_amount": tip, "total_amount": total,
        }
        reasons.append(", ".join(c for c in REQUIRED_COLUMNS if rec[c] is None))
        out.append(rec)
    return out, reasons


def _spark_rows(raw):
    data = []
    for vendor, start, minutes, pax, dist, pu, do, fare, tip, total in raw:
        pick = None if start is None else BASE + timedelta(minutes=start)
        drop = None if start is None else pick + timedelta(minutes=minutes)
        data.append((vendor, pick, drop, pax, dist, pu, do, fare, tip, total))
    return data


def _normalized(spark, raw):
    frame = spark.createDataFrame(_spark_rows(raw), LANDING)
    return normalize_trips(
        frame, period_year=F.lit(2026), period_month=F.lit(7), source_file=F.lit("f"), batch_id="b"
    )


SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(raw=rows)
def test_reason_and_split_match_model(spark, raw):
    norm = _normalized(spark, raw)
    _, reasons = _model(raw)
    got = sorted(r["schema_violation_reason"] for r in norm.collect())
    assert got == sorted(reasons)
    assert valid_rows(norm).count() == sum(1 for r in reasons if r == "")
    assert invalid_rows(norm).count() == sum(1 for r in reasons if r != "")


@SETTINGS
@given(raw=rows)
def test_silver_and_fact_match_model(spark, raw):
    recs, reasons = _model(raw)
    kept = []
    for rec, reason in zip(recs, reasons):
        if reason:
            continue
        ok = (rec["passenger_count"] > 0 and rec["trip_distance"] > 0 and rec["fare_amount"] >= 0
              and rec["total_amount"] >= 0 and rec["pulocationid"] > 0 and rec["dolocationid"] > 0)
        minutes = (rec["dropoff_datetime"] - rec["pickup_datetime"]).total_seconds() / 60.0
        if ok and minutes > 0:
            kept.append({**rec, "minutes": minutes})
    silver = clean_and_enrich(valid_rows(_normalized(spark, raw)))
    assert silver.count() == len(kept)

    groups = defaultdict(list)
    for rec in kept:
        pick = rec["pickup_datetime"]
        dow = (pick.weekday() + 1) % 7 + 1  # Sunday = 1
        key = (pick.hour, dow, dow in (1, 7), rec["pulocationid"], rec["dolocationid"])
        groups[key].append(rec)
    fact = {
        (r["pickup_hour"], r["pickup_day_of_week"], r["is_weekend"], r["pulocationid"], r["dolocationid"]): r
        for r in aggregate_fact(silver).collect()
    }
    assert set(fact) == set(groups)
    for key, members in groups.items():
        row = fact[key]
        assert row["total_trips"] == sum(1 for m in members if m["vendor_id"] is not None)
        assert row["total_passengers"] == sum(m["passenger_count"] for m in members)
        assert math.isclose(row["total_revenue"], sum(m["total_amount"] for m in members), abs_tol=1e-9)
        assert math.isclose(row["avg_duration_minutes"], sum(m["minutes"] for m in members) / len(members))
        tips = [m["tip_amount"] for m in members if m["tip_amount"] is not None]
        if tips:
            assert math.isclose(row["total_tip_amount"], sum(tips), abs_tol=1e-9)
        else:
            assert row["total_tip_amount"] is None
