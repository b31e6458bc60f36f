"""Shipments from events told as hours after a start; a parcel's fields follow from its number."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shipyard import schemas
from shipyard.operators.quality import DataQualityError
from shipyard.plans import gates, gold, silver
from shipyard.sources.reference import ReferenceDataError
from tests.conftest import write_jsonl

START = datetime(2025, 3, 10, 5, 20)
SLA = {"carrier_a": 30, "carrier_c": 90}


def at(hours):
    return START + timedelta(hours=hours)


def story(spark, wh, tmp_path, *, life=(), scans=(), carriers=None):
    """Writes silver and the dimensions. ``life``: (parcel, event, hours); ``scans``:
    (parcel, status, hours, place in the file, further fields)."""
    carriers = carriers or [{"carrier_code": c, "carrier_name": c.upper(), "sla_hours": h, "countries_served": ["BE", "LU"]} for c, h in SLA.items()]
    write_jsonl(tmp_path / "ref" / "carriers.json", carriers)
    write_jsonl(tmp_path / "ref" / "organisations.json", [{"organisation_id": 12, "name": "Kiosk", "country": "LU", "plan": "basic", "created_at": "2024-06-30T22:15:00+02:00"}])
    gold.build_dimensions(spark, wh, str(tmp_path / "ref"))
    events = [(f"{p}:{kind}", kind, p, f"K{p}", 12, "carrier_a" if p % 2 else "carrier_c", "day", "LU", None, at(h), "life", k, START) for k, (p, kind, h) in enumerate(life)]
    df = spark.createDataFrame(events, schemas.PARCEL_EVENTS)
    wh.overwrite(df.withColumn("occurred_day", F.to_date("occurred_at")), silver.PARCEL_TABLE, ["occurred_day"])
    rows = []
    for p, status, h, place, more in scans:
        row = dict(tracking_number=f"K{p}", carrier_code="carrier_a" if p % 2 else "carrier_c", status=status, event_time=at(h), weight_kg=None, facility_code=None, raw_status=status.lower(), source_file="scans", source_line_no=place, _silver_loaded_at=START)
        rows.append(tuple((row | more)[f] for f in schemas.TRACKING_EVENTS.names))
    df = spark.createDataFrame(rows, schemas.TRACKING_EVENTS)
    wh.overwrite(df.withColumn("event_day", F.to_date("event_time")), silver.TRACKING_TABLE, ["event_day"])
    loaded = gold.build_shipments(spark, wh).rows_loaded
    built = {r.parcel_id: r for r in gold.shipments(spark, wh).collect()}
    assert loaded == len(built)
    return built


def both(p, created=0, handed=2):
    return [(p, "parcel_created", created), (p, "parcel_handed_over", handed)]


def test_transit_runs_from_hand_over(spark, wh, tmp_path):
    life = both(1) + both(3) + both(4) + both(5)
    scans = [
        (1, "ACCEPTED", 3, 1, {"weight_kg": 7.75}), (1, "DELIVERED", 32, 2, {"facility_code": "door"}),  # just in time
        (3, "DELIVERED", 32.25, 3, {}),  # late, never accepted
        (4, "ACCEPTED", 4, 4, {}), (4, "DELIVERED", 60, 5, {}),  # the slower carrier promises less
    ]
    got = story(spark, wh, tmp_path, life=life, scans=scans)
    assert [(p, got[p].transit_hours, got[p].is_on_time) for p in (1, 3, 4, 5)] == [(1, 30.0, True), (3, 30.25, False), (4, 58.0, True), (5, None, None)]
    assert (got[1].accepted_at, got[1].created_at, got[1].handed_over_at, got[1].sla_hours) == (at(3), at(0), at(2), 30)
    assert got[1].facility_code == "door" and got[1].weight_kg == 7.75 and got[3].accepted_at is None
    assert got[5].latest_carrier_status is None and not got[5].is_delivered and not got[5].is_lost


def test_lost_and_returned(spark, wh, tmp_path):
    life = [(1, "parcel_created", 0), *both(2), *both(3)]
    scans = [(1, "LOST", 50, 1, {}), (2, "AT_HUB", 9, 2, {}), (2, "RETURNED", 70, 3, {}), (3, "LOST", 20, 4, {}), (3, "IN_TRANSIT", 21, 5, {})]
    got = story(spark, wh, tmp_path, life=life, scans=scans)
    flags = {p: (r.is_lost, r.is_returned, r.is_delivered, r.transit_hours, r.is_on_time) for p, r in got.items()}
    assert flags == {1: (True, False, False, None, None), 2: (False, True, False, None, None), 3: (False, False, False, None, None)}
    assert got[1].handed_over_at is None


def test_a_tie_goes_to_the_line_seen_first(spark, wh, tmp_path):
    scans = [(1, "OUT_FOR_DELIVERY", 8, 9, {"facility_code": "van"}), (1, "AT_HUB", 8, 4, {}), (1, "ACCEPTED", 7, 11, {"weight_kg": 0.5})]
    got = story(spark, wh, tmp_path, life=both(1), scans=scans)[1]
    assert (got.latest_carrier_status, got.facility_code, got.weight_kg) == ("AT_HUB", None, 0.5)


def test_repeated_carriers_do_not_multiply_parcels(spark, wh, tmp_path):
    carriers = [{"carrier_code": "carrier_a", "carrier_name": n, "sla_hours": h, "countries_served": None} for n, h in (("old", 10), ("new", 33))]
    got = story(spark, wh, tmp_path, life=both(1), scans=[(1, "DELIVERED", 34, 1, {})], carriers=carriers)
    assert len(got) == 1 and got[1].sla_hours == 33 and got[1].is_on_time and gold.dim_carriers(spark, wh).count() == 2
    assert gold.build_shipments(spark, wh).rows_loaded == 1


def test_dimensions(spark, wh, tmp_path):
    story(spark, wh, tmp_path)
    assert {(r.carrier_code, r.sla_hours, tuple(r.countries_served)) for r in gold.dim_carriers(spark, wh).collect()} == {(c, h, ("BE", "LU")) for c, h in SLA.items()}
    org = gold.dim_organisations(spark, wh).first()
    assert (org.organisation_id, org.plan, org.created_at) == (12, "basic", datetime(2024, 6, 30, 20, 15))


@pytest.mark.parametrize(
    ("name", "build", "text"),
    [
        ("carriers.json", gold.build_carriers, '{"carrier_code": "q", "carrier_name": "Q", "sla_hours": 4}\n{"carrier_code": '),
        ("carriers.json", gold.build_carriers, '{"carrier_code": "q", "carrier_name": "Q"}'),
        ("organisations.json", gold.build_organisations, '{"organisation_id": 3, "created_at": "last spring"}'),
    ],
)
def test_bad_reference_lines_raise(spark, wh, tmp_path, name, build, text):
    (tmp_path / name).write_text(text)
    with pytest.raises(ReferenceDataError):
        build(spark, wh, str(tmp_path))


def test_gate(spark, wh, tmp_path):
    story(spark, wh, tmp_path, life=both(1) + both(2), scans=[(1, "DELIVERED", 5, 1, {})])
    assert gates.check_gold_shipments(spark, wh) == {"row_count": 2}
    story(spark, wh, tmp_path, life=both(7, handed=6), scans=[(7, "DELIVERED", 1, 1, {}), (7, "RETURNED", 9, 2, {})])
    with pytest.raises(DataQualityError, match=r"earlier than hand-over in 1 rows \(first parcel 7\).*lost or returned in 1 rows"):
        gates.check_gold_shipments(spark, wh)
    story(spark, wh, tmp_path)
    with pytest.raises(DataQualityError, match="no rows"):
        gates.check_gold_shipments(spark, wh)


def test_columns_added_later_read_as_null(spark, wh):
    old = StructType([f for f in gold.SHIPMENTS_STORED.fields if f.name in ("parcel_id", "tracking_number", "is_delivered", "handed_over_month")])
    wh.overwrite(spark.createDataFrame([(6, "K6", True, None)], old), gold.SHIPMENTS_TABLE, ["handed_over_month"])
    row = gold.shipments(spark, wh).first()
    assert (row.parcel_id, row.is_delivered, row.is_lost, row.sla_hours) == (6, True, None, None)


def test_no_silver(spark, wh):
    with pytest.raises(FileNotFoundError):
        gold.build_shipments(spark, wh)
