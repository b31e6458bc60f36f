"""Business questions over ``gold.shipments`` as DataFrame reports.

Rules from the gold documentation:

* Volume counts ("how many did X ship") count by ``handed_over_at`` or
  ``created_at``, never ``accepted_at``, and keep parcels that are not
  resolved yet.
* Rates exclude unresolved parcels: the on-time rate is over rows where
  ``is_on_time`` is not null.
* Lost and returned parcels never resolve to on-time or late, so delivery
  performance shows their rates beside the on-time rate.

All reports are single aggregations (partial aggregation before the shuffle).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BREAKDOWN = ["carrier_code", "service_level", "destination_country"]


def _rate(flag: str) -> F.Column:
    return F.avg(F.col(flag).cast("int"))


def _month(col: str = "handed_over_at") -> F.Column:
    return F.to_date(F.date_trunc("MONTH", F.col(col)))


def shipments_by_carrier(shipments: DataFrame, organisation_id: int, month: date, date_col: str = "handed_over_at") -> DataFrame:
    """Parcels one organisation shipped in one calendar month, per carrier."""
    start = F.lit(month.replace(day=1)).cast("timestamp_ntz")
    end = F.add_months(F.lit(month.replace(day=1)), 1).cast("timestamp_ntz")
    return (
        shipments.where((F.col("organisation_id") == organisation_id) & (F.col(date_col) >= start) & (F.col(date_col) < end))
        .groupBy("carrier_code")
        .agg(F.count(F.lit(1)).alias("parcels"))
    )


def worst_on_time(shipments: DataFrame, min_weight_kg: float = 5.0) -> DataFrame:
    """On-time rate per carrier for parcels heavier than ``min_weight_kg``, worst first."""
    return (
        shipments.where((F.col("weight_kg") > min_weight_kg) & F.col("is_on_time").isNotNull())
        .groupBy("carrier_code")
        .agg(F.count(F.lit(1)).alias("resolved_parcels"), _rate("is_on_time").alias("on_time_rate"))
        .orderBy(F.col("on_time_rate").asc(), F.col("carrier_code"))
    )


def monthly_performance(shipments: DataFrame) -> DataFrame:
    """Month over month per carrier, service level and country: on-time rate
    over resolved parcels and mean transit hours."""
    return shipments.groupBy(_month().alias("month"), *BREAKDOWN).agg(
        F.count(F.lit(1)).alias("parcels"),
        F.count("is_on_time").alias("resolved_parcels"),
        _rate("is_on_time").alias("on_time_rate"),
        F.avg("transit_hours").alias("mean_transit_hours"),
    )


def loss_rates(shipments: DataFrame) -> DataFrame:
    """Lost and returned rates beside the on-time rate, same breakdown."""
    return shipments.groupBy(_month().alias("month"), *BREAKDOWN).agg(
        F.count(F.lit(1)).alias("parcels"),
        _rate("is_on_time").alias("on_time_rate"),
        _rate("is_lost").alias("lost_rate"),
        _rate("is_returned").alias("returned_rate"),
    )


def volume_vs_resolved(shipments: DataFrame) -> DataFrame:
    """Volume keeps unresolved parcels; the rate excludes them. No month
    filter: parcels without a hand-over time stay in (month null)."""
    return shipments.groupBy(_month().alias("month"), "carrier_code").agg(
        F.count(F.lit(1)).alias("parcels"),
        F.count("is_on_time").alias("resolved_parcels"),
        (F.count(F.lit(1)) - F.count("is_on_time")).alias("unresolved_parcels"),
        _rate("is_on_time").alias("on_time_rate"),
    )
