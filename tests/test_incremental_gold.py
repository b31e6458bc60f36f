"""Shipments kept up to date by day equal shipments built from all of silver."""

import random
from datetime import datetime, timedelta

import pytest

from shipyard import schemas
from shipyard.operators.milestones import carrier_milestones, day_milestones, day_parcels, merged_milestones, merged_parcels, parcel_rows
from shipyard.plans import gold, silver
from shipyard.warehouse import Warehouse

START = datetime(2025, 3, 28, 22)
CARRIERS = [("north", "North", 30, None, 1), ("south", "South", 50, None, 2)]


def scan(n, hours, status, weight=None, facility=None, file="m", line=1, carrier="north"):
    return {"carrier_code": carrier, "tracking_number": f"K{n}", "status": status, "event_time": START + timedelta(hours=hours),
            "weight_kg": weight, "facility_code": facility, "raw_status": status, "source_file": file, "source_line_no": line}


def event(n, hours, kind="parcel_created", file="m", line=1, carrier="north", number=None):
    return {"event_id": f"{n}/{kind}", "event_type": kind, "parcel_id": n, "tracking_number": number or f"K{n}", "organisation_id": 4,
            "carrier_code": carrier, "service_level": "day", "destination_country": "BE", "destination_postcode": None,
            "occurred_at": START + timedelta(hours=hours), "source_file": file, "source_line_no": line}


def frames(spark, scans, events, at):
    def rows(items, schema):
        return spark.createDataFrame([tuple((x | {"_silver_loaded_at": at}).get(c) for c in schema.names) for x in items], schema)

    a = rows(scans, schemas.TRACKING_EVENTS).selectExpr("*", "to_date(event_time) AS event_day")
    b = rows(events, schemas.PARCEL_EVENTS).selectExpr("*", "to_date(occurred_at) AS occurred_day")
    return a.select(*silver.TRACKING_STORED.names), b.select(*silver.PARCEL_STORED.names)


def stored(spark, wh):
    return sorted(map(str, gold.shipments(spark, wh).drop("_gold_loaded_at").collect()))


def expected(spark, wh):
    carriers = wh.read(spark, gold.CARRIERS_TABLE, gold.CARRIERS_STORED)
    full = gold.shipments_frame(silver.tracking_events(spark, wh), silver.parcel_events(spark, wh), carriers)
    return sorted(map(str, full.select([c for c in gold.SHIPMENT_COLUMNS if c != "_gold_loaded_at"]).collect()))


def set_hours(spark, wh, carriers):
    wh.overwrite(spark.createDataFrame(carriers, gold.CARRIERS_STORED), gold.CARRIERS_TABLE)


def test_days_merge_to_the_rows_of_all_events(spark):
    r = random.Random(2)
    scans = [
        scan(r.randrange(5), r.randrange(60), r.choice(["ACCEPTED", "IN_TRANSIT", "DELIVERED"]), r.choice([None, 1.5, 2.5]), r.choice([None, "F", "G"]), r.choice("xyz"), k)
        for k in range(300)
    ]
    events = [event(r.randrange(6), r.randrange(60), r.choice(["parcel_created", "parcel_handed_over"]), r.choice("xyz"), k, number=r.choice("PQ")) for k in range(200)]
    tracking, parcels = frames(spark, scans, events, START)
    for merged, full in (
        (merged_milestones(day_milestones(tracking)), carrier_milestones(tracking)),
        (merged_parcels(day_parcels(parcels)), parcel_rows(parcels)),
    ):
        assert merged.columns == full.columns and sorted(map(str, merged.collect())) == sorted(map(str, full.collect()))


def test_changed_days_give_the_full_result(spark, wh):
    set_hours(spark, wh, CARRIERS)
    scans = [
        scan(1, 0, "ACCEPTED", 2.0, "A"), scan(1, 20, "DELIVERED", 2.5, "B", line=2), scan(2, 1, "ACCEPTED", 1.0, "A", line=3),
        scan(3, 5, "LOST", line=4), scan(4, 300, "ACCEPTED", 9.0, "Z", line=5),
    ]
    events = [event(n, n) for n in (1, 2, 3, 4)] + [event(n, 40, "parcel_handed_over", line=n) for n in (1, 3)] + [event(7, 900, line=9)]
    a, b = frames(spark, scans, events, START)
    wh.overwrite(a, silver.TRACKING_TABLE, ["event_day"])
    wh.overwrite(b, silver.PARCEL_TABLE, ["occurred_day"])
    gold.build_shipments_incremental(spark, wh, START + timedelta(days=1))
    assert stored(spark, wh) == expected(spark, wh)
    untouched = gold.shipments(spark, wh).where("parcel_id = 4").first()._gold_loaded_at

    # The day of hour 20: another copy takes the place of a scan and knows no weight; a late scan of parcel 2.
    at = START + timedelta(days=2)
    a, _ = frames(spark, [scan(1, 20, "DELIVERED", None, "C", file="a", line=1), scan(2, 21, "DELIVERED", 1.0, "D", file="n")], [], at)
    wh.replace_partitions(a, silver.TRACKING_TABLE, "event_day")
    # Parcel 3 was handed over in another month, parcel 7 is gone with its day, parcel 8 is new and not handed over.
    _, b = frames(spark, [], [event(3, 100, "parcel_handed_over", file="b"), event(1, 40, "parcel_handed_over"), event(8, 101)], at)
    wh.replace_partitions(b, silver.PARCEL_TABLE, "occurred_day", [(START + timedelta(hours=900)).date().isoformat()])
    kept = b.where("event_type = 'parcel_handed_over' AND parcel_id = 3")
    assert kept.count() == 1
    gold.build_shipments_incremental(spark, wh, at)
    assert stored(spark, wh) == expected(spark, wh)
    rows = {r.parcel_id: r for r in gold.shipments(spark, wh).collect()}
    assert rows[1].weight_kg == 2.0 and rows[1].facility_code == "C" and rows[2].delivered_at and 7 not in rows and 8 in rows
    assert rows[4]._gold_loaded_at == untouched or rows[4].handed_over_at is None

    before = stored(spark, wh)
    gold.build_shipments_incremental(spark, wh, at + timedelta(hours=1))  # nothing new
    assert stored(spark, wh) == before

    set_hours(spark, wh, [("north", "North", 10, None, 1), CARRIERS[1]])
    gold.build_shipments_incremental(spark, wh, at + timedelta(hours=2))
    assert stored(spark, wh) == expected(spark, wh) != before


def test_an_interrupted_build_starts_afresh(spark, tmp_path, monkeypatch):
    wh = Warehouse(str(tmp_path / "wh"))
    set_hours(spark, wh, CARRIERS)
    a, b = frames(spark, [scan(1, 0, "ACCEPTED")], [event(1, 0)], START)
    wh.overwrite(a, silver.TRACKING_TABLE, ["event_day"])
    wh.overwrite(b, silver.PARCEL_TABLE, ["occurred_day"])
    gold.build_shipments_incremental(spark, wh, START + timedelta(days=1))
    a, _ = frames(spark, [scan(1, 30, "DELIVERED", 4.0)], [], START + timedelta(days=2))
    wh.replace_partitions(a, silver.TRACKING_TABLE, "event_day")
    with monkeypatch.context() as m:
        m.setattr(gold, "assemble", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            gold.build_shipments_incremental(spark, wh, START + timedelta(days=2))
    assert not wh.exists(spark, gold.STATE_TABLE)
    gold.build_shipments_incremental(spark, wh, START + timedelta(days=3))
    assert stored(spark, wh) == expected(spark, wh) and gold.shipments(spark, wh).first().weight_kg == 4.0


def test_changed_keys_come_from_one_aggregation(spark, wh, monkeypatch):
    """Rows that either side has more often give their keys; equal rows, nulls included, do not."""
    from pyspark.sql.classic.dataframe import DataFrame

    def two_ways(self, other):
        raise AssertionError("each direction would aggregate all rows")

    monkeypatch.setattr(DataFrame, "exceptAll", two_ways)
    schema = "day string, k long, v string"
    old = spark.createDataFrame([("d1", 1, "a"), ("d1", 2, None), ("d1", 3, "a"), ("d1", 4, "a"), ("d1", 4, "a"), ("d2", 9, "a")], schema)
    new = spark.createDataFrame([("d1", 1, "a"), ("d1", 2, None), ("d1", 3, "b"), ("d1", 4, "a"), ("d1", 5, None)], schema)
    days = spark.createDataFrame([("d1",)], "day string")
    wh.overwrite(old, "gold.parts", ["day"])
    changed = gold._replaced(wh, days, old, new, "gold.parts", "day", ["k"])
    assert sorted(r.k for r in changed.collect()) == [3, 4, 5]


def test_long_generated_methods_are_not_fused(spark):
    """HotSpot would only interpret them."""
    from shipyard.session import prepare

    assert int(prepare(spark).conf.get("spark.sql.codegen.hugeMethodLimit")) == 8000


def test_held_tables_have_a_known_size(spark):
    """Days and keys between the steps are small tables to the planner, so that joins with them can broadcast."""
    from shipyard.session import held

    days = held(spark.range(5).selectExpr("DATE '2026-01-01' + CAST(id AS INT) AS event_day"))
    assert days.count() == 5 and days.schema["event_day"].dataType.simpleString() == "date"
    scans = spark.range(1000).selectExpr("DATE '2026-01-01' + CAST(id AS INT) AS event_day", "id")
    plan = scans.join(days, "event_day", "left_semi")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
