"""A key holding a third of all rows: results stay exact."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from shipyard import schemas
from shipyard.operators.dedup import keep_first
from shipyard.operators.milestones import carrier_milestones, parcel_rows
from shipyard.plans.gold import shipments_frame

T0 = datetime(2026, 7, 1)


def test_hot_tracking_number_and_hot_parcel(spark):
    n = 3000
    scans = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("T"), F.col("id").cast("string"))).alias("tracking_number"),
        F.lit("carrier_a").alias("carrier_code"),
        F.when(F.col("id") == 0, F.lit("ACCEPTED")).when(F.col("id") == 2997, F.lit("DELIVERED")).otherwise(F.lit("IN_TRANSIT")).alias("status"),
        (F.lit(T0).cast("timestamp_ntz") + F.make_interval(mins=F.col("id").cast("int"))).alias("event_time"),
        F.col("id").cast("double").alias("weight_kg"),
        F.concat(F.lit("F"), F.col("id").cast("string")).alias("facility_code"),
        F.lit("x").alias("raw_status"),
        F.lit("f").alias("source_file"),
        F.col("id").cast("int").alias("source_line_no"),
    ).repartition(8)
    m = {r.tracking_number: r for r in carrier_milestones(scans).collect()}
    hot = m["HOT"]
    assert hot.accepted_at == T0 and hot.delivered_at == T0 + timedelta(minutes=2997)
    assert hot.weight_kg == 2997.0 and hot.latest_carrier_status == "DELIVERED" and hot.facility_code == "F2997"
    assert len(m) == 1 + 2000

    dup = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("o"))
    first = {r.k: r.o for r in keep_first(dup.repartition(8), ["k"], ["o"]).collect()}
    assert first[0] == 0 and len(first) == 2001

    events = spark.range(n).select(
        F.concat(F.lit("e"), F.col("id").cast("string")).alias("event_id"),
        F.when(F.col("id") == 5, F.lit("parcel_created")).when(F.col("id") == 6, F.lit("parcel_handed_over")).otherwise(F.lit("other")).alias("event_type"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).cast("int").alias("parcel_id"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("T"), F.col("id").cast("string"))).alias("tracking_number"),
        F.lit(1).alias("organisation_id"),
        F.lit("carrier_a").alias("carrier_code"),
        F.lit(None).cast("string").alias("service_level"),
        F.lit(None).cast("string").alias("destination_country"),
        F.lit(None).cast("string").alias("destination_postcode"),
        (F.lit(T0).cast("timestamp_ntz") + F.make_interval(mins=F.col("id").cast("int"))).alias("occurred_at"),
        F.lit("p").alias("source_file"),
        F.col("id").cast("int").alias("source_line_no"),
    ).repartition(8)
    p = {r.parcel_id: r for r in parcel_rows(events).collect()}
    assert p[0].tracking_number == "HOT" and p[0].created_at is None
    carriers = spark.createDataFrame([("carrier_a", "A", 24, None, 1)], "carrier_code string, carrier_name string, sla_hours int, countries_served array<string>, source_line_no int")
    ships = shipments_frame(scans, events, carriers)
    assert ships.count() == len(p)
    assert ships.where("parcel_id = 0").first().delivered_at == T0 + timedelta(minutes=2997)
    assert set(ships.columns) == set(schemas.SHIPMENTS.names) - {"_gold_loaded_at"}
