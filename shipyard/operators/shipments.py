"""Assemble one shipment row per parcel.

parcels LEFT JOIN carrier milestones ON (carrier_code, tracking_number)
        LEFT JOIN SLA ON carrier_code

The milestones side is already hash-partitioned by its grouping key, so only
the parcels side is shuffled for the first join. The SLA lookup is one row
per carrier (made unique beforehand, so it never fans out); Catalyst and AQE
broadcast it when its size, known at run time, is below their threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipyard import schemas
from shipyard.functions.timestamps import hours_between


def transit_hours(handed_over_at: F.Column, delivered_at: F.Column) -> F.Column:
    return hours_between(handed_over_at, delivered_at)


def assemble(parcels: DataFrame, milestones: DataFrame, sla: DataFrame) -> DataFrame:
    """``sla`` must be unique on ``carrier_code`` with column ``sla_hours``."""
    joined = parcels.join(milestones, ["carrier_code", "tracking_number"], "left").join(sla, "carrier_code", "left")
    transit = transit_hours(F.col("handed_over_at"), F.col("delivered_at"))
    latest = F.col("latest_carrier_status")
    return joined.select(
        "parcel_id",
        "tracking_number",
        "organisation_id",
        "carrier_code",
        "service_level",
        "destination_country",
        "destination_postcode",
        "created_at",
        "handed_over_at",
        "accepted_at",
        "delivered_at",
        "latest_carrier_status",
        "weight_kg",
        "facility_code",
        "sla_hours",
        transit.alias("transit_hours"),
        F.col("delivered_at").isNotNull().alias("is_delivered"),
        (transit <= F.col("sla_hours")).alias("is_on_time"),
        latest.eqNullSafe(F.lit("LOST")).alias("is_lost"),
        latest.eqNullSafe(F.lit("RETURNED")).alias("is_returned"),
    )


SHIPMENT_COLUMNS = schemas.SHIPMENTS.names
