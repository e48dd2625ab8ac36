"""Zone dimension from the lookup CSV, and the fact ⟕ zone join (FIXTURES A4)."""

from __future__ import annotations

import pytest

from tidewater.operators.zones import with_pickup_zone, zone_dimension
from tidewater.plans import gold
from tidewater.sources.tables import read_table, read_zone_lookup


def _csv(tmp_path, lines, header="LocationID,Borough,Zone,service_zone"):
    path = tmp_path / "taxi_zone_lookup.csv"
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


def test_dimension_from_lookup_csv(spark, tmp_path):
    csv = _csv(tmp_path, ["1,Manhattan,EWR,Yellow", "2,Queens,Astoria,Boro"])
    dim = zone_dimension(read_zone_lookup(spark, csv))
    assert dim.columns == ["location_id", "borough", "zone", "service_zone"]
    assert dim.count() == 2
    out = str(tmp_path / "gold" / "dim_taxi_zone")
    assert gold.build_dimension(spark, csv, out)
    written = read_table(spark, out)
    assert sorted(tuple(r) for r in written.collect()) == [
        (1, "Manhattan", "EWR", "Yellow"),
        (2, "Queens", "Astoria", "Boro"),
    ]


def test_empty_field_is_null_and_na_stays_text(spark, tmp_path):
    csv = _csv(tmp_path, ["264,Unknown,N/A,N/A", "265,,Outside the area,"])
    rows = {r["location_id"]: r for r in zone_dimension(read_zone_lookup(spark, csv)).collect()}
    assert rows[264]["zone"] == "N/A"
    assert rows[265]["borough"] is None and rows[265]["service_zone"] is None


def test_duplicate_location_id_is_rejected(spark, tmp_path):
    csv = _csv(tmp_path, ["1,Manhattan,EWR,Yellow", "1,Queens,Astoria,Boro"])
    with pytest.raises(ValueError):
        gold.build_dimension(spark, csv, str(tmp_path / "dim"))


def test_unmatched_zone_keeps_fact_row(spark):
    fact = spark.createDataFrame([(1, 10, 5.0), (99, 3, 1.0)], "pulocationid int, total_trips long, total_revenue double")
    dim = spark.createDataFrame([(1, "Manhattan", "EWR", "Yellow")], "location_id int, borough string, zone string, service_zone string")
    joined = with_pickup_zone(fact, dim)
    assert "location_id" not in joined.columns
    rows = {r["pulocationid"]: r for r in joined.collect()}
    assert rows[1]["pickup_borough"] == "Manhattan" and rows[1]["pickup_service_zone"] == "Yellow"
    assert rows[99]["pickup_borough"] is None
    assert joined.count() == 2


def test_columns_are_found_by_name_and_blank_ids_are_tolerated(spark, tmp_path):
    path = _csv(tmp_path, [
        "1,Yellow Zone,7,Harbour,Westside", "2,Boro Zone,,Nowhere,Unknown", "3,Boro Zone,,Elsewhere,", "4,EWR,x9,Odd,Eastside",
    ], header="extra,service_zone,LocationID,Zone,Borough")
    assert gold.build_dimension(spark, path, str(tmp_path / "dim"))
    dim = read_table(spark, str(tmp_path / "dim"))
    assert [(f.name, f.dataType.simpleString()) for f in dim.schema.fields] == [
        ("location_id", "int"), ("borough", "string"), ("zone", "string"), ("service_zone", "string")
    ]
    rows = {r["zone"]: (r["location_id"], r["borough"], r["service_zone"]) for r in dim.collect()}
    assert rows["Harbour"] == (7, "Westside", "Yellow Zone") and rows["Odd"][0] is None
    assert rows["Nowhere"][0] is None and rows["Elsewhere"] == (None, None, "Boro Zone")
    assert len(dim.inputFiles()) == 1


def test_absent_column_is_named(spark, tmp_path):
    path = _csv(tmp_path, ["1,Harbour,Yellow Zone"], header="LocationID,Zone,service_zone")
    with pytest.raises(ValueError, match="Borough"):
        gold.build_dimension(spark, path, str(tmp_path / "dim"))


def test_reports_need_a_gold_fact(spark, tmp_path):
    from tidewater.plans import reports
    from tidewater.plans.common import LakePaths

    with pytest.raises(FileNotFoundError):
        reports.load_gold(spark, LakePaths.under(str(tmp_path / "empty")))
