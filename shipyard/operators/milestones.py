"""Per-key milestones: one aggregation each, combined map-side.

* ``carrier_milestones`` - per (carrier_code, tracking_number): first ACCEPTED
  time, first DELIVERED time, last non-null weight, and the latest status with
  the facility of that same row (greatest event time; a tie goes to the first
  row in lineage order; a null facility is kept).
* ``parcel_rows`` - per parcel_id: attributes of the parcel's first event (by
  event time, then lineage), time of ``parcel_created`` and of
  ``parcel_handed_over`` (the earliest of each).

Both also come in two steps that give the same rows: partial rows per key and day
(``day_milestones``, ``day_parcels``), and any number of partial rows merged per key
(``merged_milestones``, ``merged_parcels``). Minima and maxima of ordered structs
merge, so a stored partial row stands for the events of its day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARCEL_ATTRIBUTES = [
    "tracking_number",
    "organisation_id",
    "carrier_code",
    "service_level",
    "destination_country",
    "destination_postcode",
]


def first_time_of(status_col: str, status: str, time_col: str) -> F.Column:
    return F.min(F.when(F.col(status_col) == status, F.col(time_col)))


def carrier_milestones(tracking: DataFrame) -> DataFrame:
    t, w = F.col("event_time"), F.col("weight_kg")
    lineage = [F.col("source_file"), F.col("source_line_no")]
    latest_first = F.struct((-F.unix_micros(t.cast("timestamp"))).alias("t"), *lineage)
    return (
        tracking.groupBy("carrier_code", "tracking_number")
        .agg(
            first_time_of("status", "ACCEPTED", "event_time").alias("accepted_at"),
            first_time_of("status", "DELIVERED", "event_time").alias("delivered_at"),
            F.max_by(w, F.when(w.isNotNull(), F.struct(t, *lineage))).alias("weight_kg"),
            F.min_by(F.struct("status", "facility_code"), latest_first).alias("_latest"),
        )
        .select(
            "carrier_code",
            "tracking_number",
            "accepted_at",
            "delivered_at",
            "weight_kg",
            F.col("_latest.status").alias("latest_carrier_status"),
            F.col("_latest.facility_code").alias("facility_code"),
        )
    )


def parcel_rows(parcel_events: DataFrame) -> DataFrame:
    order = F.struct("occurred_at", "source_file", "source_line_no")
    return (
        parcel_events.groupBy("parcel_id")
        .agg(
            F.min_by(F.struct(*PARCEL_ATTRIBUTES), order).alias("_first"),
            first_time_of("event_type", "parcel_created", "occurred_at").alias("created_at"),
            first_time_of("event_type", "parcel_handed_over", "occurred_at").alias("handed_over_at"),
        )
        .select("parcel_id", *[F.col("_first." + c).alias(c) for c in PARCEL_ATTRIBUTES], "created_at", "handed_over_at")
    )


# ------------------------------------------------------------- per day, then merged
def day_milestones(tracking: DataFrame) -> DataFrame:
    """What a day's scans say about a tracking number: one row per ``event_day``,
    carrier and tracking number."""
    t, w = F.col("event_time"), F.col("weight_kg")
    lineage = [F.col("source_file"), F.col("source_line_no")]
    newest = F.struct((-F.unix_micros(t.cast("timestamp"))).alias("t"), *lineage, "status", "facility_code")
    return tracking.groupBy(F.to_date("event_time").alias("event_day"), "carrier_code", "tracking_number").agg(
        first_time_of("status", "ACCEPTED", "event_time").alias("accepted_at"),
        first_time_of("status", "DELIVERED", "event_time").alias("delivered_at"),
        F.max(F.when(w.isNotNull(), F.struct(t, *lineage, w))).alias("weighed"),
        F.min(newest).alias("newest"),
    )


def merged_milestones(days: DataFrame) -> DataFrame:
    """``day_milestones`` of any days to the rows of ``carrier_milestones``."""
    merged = days.groupBy("carrier_code", "tracking_number").agg(
        F.min("accepted_at").alias("accepted_at"),
        F.min("delivered_at").alias("delivered_at"),
        F.max("weighed").alias("weighed"),
        F.min("newest").alias("newest"),
    )
    return merged.select(
        "carrier_code",
        "tracking_number",
        "accepted_at",
        "delivered_at",
        F.col("weighed.weight_kg").alias("weight_kg"),
        F.col("newest.status").alias("latest_carrier_status"),
        F.col("newest.facility_code").alias("facility_code"),
    )


def day_parcels(parcel_events: DataFrame) -> DataFrame:
    """What a day's events say about a parcel: one row per ``occurred_day`` and parcel."""
    return parcel_events.groupBy(F.to_date("occurred_at").alias("occurred_day"), "parcel_id").agg(
        F.min(F.struct("occurred_at", "source_file", "source_line_no", *PARCEL_ATTRIBUTES)).alias("first"),
        first_time_of("event_type", "parcel_created", "occurred_at").alias("created_at"),
        first_time_of("event_type", "parcel_handed_over", "occurred_at").alias("handed_over_at"),
    )


def merged_parcels(days: DataFrame) -> DataFrame:
    """``day_parcels`` of any days to the rows of ``parcel_rows``."""
    merged = days.groupBy("parcel_id").agg(
        F.min("first").alias("first"), F.min("created_at").alias("created_at"), F.min("handed_over_at").alias("handed_over_at")
    )
    return merged.select("parcel_id", *[F.col("first." + c).alias(c) for c in PARCEL_ATTRIBUTES], "created_at", "handed_over_at")
