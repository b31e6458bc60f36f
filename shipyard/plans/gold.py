"""Gold: carrier and organisation dimensions, and one shipment row per parcel.

``build_shipments`` computes all rows. ``build_shipments_incremental`` keeps what
each day of silver says about a tracking number and about a parcel as stored partial
rows (``operators.milestones``), and after a run

* re-reads the silver days written since the last one, and replaces the partial rows
  of these days; a comparison with the old ones gives the keys that changed;
* merges the partial rows of the parcels concerned, and of their tracking numbers,
  over all days, and joins them as the full build does;
* rewrites the months of ``gold.shipments`` that hold these parcels, before or after.

Partial rows are replaced by day, never added to, so a scan that another file's copy
took the place of leaves no trace, and the result equals the full build. A note says
up to when silver was applied, and with which SLA hours; it is dropped while gold is
written. Without it, or with other hours, everything is computed anew.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType

from shipyard import schemas
from shipyard.operators.dedup import keep_last
from shipyard.operators.milestones import (
    carrier_milestones,
    day_milestones,
    day_parcels,
    merged_milestones,
    merged_parcels,
    parcel_rows,
)
from shipyard.operators.shipments import SHIPMENT_COLUMNS, assemble
from shipyard.plans import silver
from shipyard.session import checkpoint_dir, held, prepare
from shipyard.sources.reference import load_carriers, load_organisations
from shipyard.warehouse import Warehouse, fixed_time

CARRIERS_TABLE = "gold.dim_carriers"
ORGANISATIONS_TABLE = "gold.dim_organisations"
SHIPMENTS_TABLE = "gold.shipments"

# Partial rows by day, and the note of what they were made of.
SCAN_DAYS_TABLE = "gold._scan_days"
PARCEL_DAYS_TABLE = "gold._parcel_days"
STATE_TABLE = "gold._applied"

CARRIERS_STORED = schemas.with_column(schemas.DIM_CARRIERS, "source_line_no", IntegerType())
ORGANISATIONS_STORED = schemas.with_column(schemas.DIM_ORGANISATIONS, "source_line_no", IntegerType())
SHIPMENTS_STORED = schemas.with_column(schemas.SHIPMENTS, "handed_over_month", DateType())


@dataclass
class TransformResult:
    rows_loaded: int


def build_carriers(spark: SparkSession, wh: Warehouse, reference_dir: str, file_name: str = "carriers.json") -> TransformResult:
    """``file_name`` may be a glob (e.g. ``*.json`` for a folder of part files)."""
    prepare(spark)
    return TransformResult(wh.overwrite(load_carriers(spark, reference_dir, file_name), CARRIERS_TABLE))


def build_organisations(
    spark: SparkSession, wh: Warehouse, reference_dir: str, file_name: str = "organisations.json"
) -> TransformResult:
    prepare(spark)
    return TransformResult(wh.overwrite(load_organisations(spark, reference_dir, file_name), ORGANISATIONS_TABLE))


def build_dimensions(spark: SparkSession, wh: Warehouse, reference_dir: str, files: dict | None = None) -> TransformResult:
    """``files`` optionally maps ``carriers`` / ``organisations`` to (folder, glob)."""
    files = files or {}
    c_dir, c_glob = files.get("carriers", (reference_dir, "carriers.json"))
    o_dir, o_glob = files.get("organisations", (reference_dir, "organisations.json"))
    c = build_carriers(spark, wh, c_dir, c_glob)
    o = build_organisations(spark, wh, o_dir, o_glob)
    return TransformResult(c.rows_loaded + o.rows_loaded)


def sla_lookup(carriers_with_lines: DataFrame) -> DataFrame:
    """One SLA per carrier: the last line of the reference file wins."""
    unique = keep_last(carriers_with_lines.select("carrier_code", "sla_hours", "source_line_no"), ["carrier_code"], ["source_line_no"])
    return unique.select("carrier_code", "sla_hours")


def shipments_frame(tracking: DataFrame, parcel_events: DataFrame, carriers_with_lines: DataFrame) -> DataFrame:
    return assemble(parcel_rows(parcel_events), carrier_milestones(tracking), sla_lookup(carriers_with_lines))


def build_shipments(spark: SparkSession, wh: Warehouse, loaded_at: datetime | None = None) -> TransformResult:
    prepare(spark)
    at = fixed_time(loaded_at or datetime.now(timezone.utc).replace(tzinfo=None))
    if not wh.exists(spark, silver.PARCEL_TABLE):
        raise FileNotFoundError(f"{silver.PARCEL_TABLE} does not exist")
    frame = shipments_frame(
        silver.tracking_events(spark, wh),
        silver.parcel_events(spark, wh),
        wh.read(spark, CARRIERS_TABLE, CARRIERS_STORED),
    )
    wh.drop(spark, STATE_TABLE)  # the partial rows, if any, are of another build
    rows = wh.overwrite(_stored_shipments(frame, at), SHIPMENTS_TABLE, partition_by=["handed_over_month"])
    return TransformResult(rows)


def _stored_shipments(frame: DataFrame, at) -> DataFrame:
    month = F.trunc(F.to_date("handed_over_at"), "MM")
    return frame.withColumn("_gold_loaded_at", at).withColumn("handed_over_month", month).select(*SHIPMENTS_STORED.names)


# ------------------------------------------------------- incremental (opt-in)
def build_shipments_incremental(spark: SparkSession, wh: Warehouse, loaded_at: datetime | None = None) -> TransformResult:
    """Shipments after the silver changes since the last call; everything on the
    first one, after a full build or an interrupted one, or with other SLA hours.
    ``loaded_at`` must not lie before the time at which silver was written."""
    prepare(spark)
    checkpoint_dir(spark)
    now = loaded_at or datetime.now(timezone.utc).replace(tzinfo=None)
    if not wh.exists(spark, silver.PARCEL_TABLE):
        raise FileNotFoundError(f"{silver.PARCEL_TABLE} does not exist")
    for name in (SCAN_DAYS_TABLE, PARCEL_DAYS_TABLE, SHIPMENTS_TABLE):
        wh.recover(spark, name)
    sla = sla_lookup(wh.read(spark, CARRIERS_TABLE, CARRIERS_STORED))
    since = _applied_since(spark, wh, sla)
    if since is None or not wh.exists(spark, SHIPMENTS_TABLE):
        _rebuild(spark, wh, sla, now)
    else:
        _apply(spark, wh, sla, now, since)
    note = sla.withColumn("applied_at", fixed_time(now))
    none = spark.range(1).select(fixed_time(now).alias("applied_at"), F.lit(None).cast("string").alias("carrier_code"), F.lit(None).cast("int").alias("sla_hours"))
    wh.overwrite(note.unionByName(none).select(*schemas.GOLD_STATE.names), STATE_TABLE)
    return TransformResult(shipments(spark, wh).count())


def _applied_since(spark: SparkSession, wh: Warehouse, sla: DataFrame):
    """Up to when silver is applied; None where that is unknown or the hours differ."""
    state = wh.read(spark, STATE_TABLE, schemas.GOLD_STATE)
    row = state.agg(F.max("applied_at").alias("at")).first()
    if row["at"] is None:
        return None
    before, now = state.where("carrier_code IS NOT NULL").select("carrier_code", "sla_hours"), sla.select("carrier_code", "sla_hours")
    return row["at"] if before.exceptAll(now).isEmpty() and now.exceptAll(before).isEmpty() else None


def _rebuild(spark: SparkSession, wh: Warehouse, sla: DataFrame, now: datetime) -> None:
    wh.drop(spark, STATE_TABLE)
    wh.overwrite(day_milestones(silver.tracking_events(spark, wh)).select(*schemas.DAY_MILESTONES.names), SCAN_DAYS_TABLE, ["event_day"])
    wh.overwrite(day_parcels(silver.parcel_events(spark, wh)).select(*schemas.DAY_PARCELS.names), PARCEL_DAYS_TABLE, ["occurred_day"])
    frame = assemble(merged_parcels(_parcel_days(spark, wh)), merged_milestones(_scan_days(spark, wh)), sla)
    wh.overwrite(_stored_shipments(frame, fixed_time(now)), SHIPMENTS_TABLE, ["handed_over_month"])


def _scan_days(spark: SparkSession, wh: Warehouse) -> DataFrame:
    return wh.read(spark, SCAN_DAYS_TABLE, schemas.DAY_MILESTONES)


def _parcel_days(spark: SparkSession, wh: Warehouse) -> DataFrame:
    return wh.read(spark, PARCEL_DAYS_TABLE, schemas.DAY_PARCELS)


def _changed_days(spark: SparkSession, wh: Warehouse, rows: DataFrame, table: str, days_table: str, day: str, since) -> DataFrame:
    """Days of silver written after ``since``, and those that silver no longer has."""
    written = rows.where(F.col("_silver_loaded_at") > F.lit(since)).select(day).distinct()
    gone = set(wh.partition_values(spark, days_table, day)) - set(wh.partition_values(spark, table, day))
    dropped = spark.createDataFrame([(d,) for d in sorted(gone)], f"{day} string").select(F.col(day).cast("date").alias(day))
    return held(written.unionByName(dropped).distinct())


def _replaced(wh: Warehouse, days: DataFrame, old: DataFrame, new: DataFrame, table: str, day: str, keys: list[str]) -> DataFrame:
    """Puts ``new`` in the place of the partial rows ``old`` of ``days``; the keys whose rows differ."""
    new = held(new.select(*old.columns))
    old = old.join(days, day, "left_semi").select(*old.columns)
    # Rows that one side has more often: one aggregation for both directions.
    signed = new.withColumn("_sign", F.lit(1)).unionByName(old.withColumn("_sign", F.lit(-1)))
    differing = signed.groupBy(*new.columns).agg(F.sum("_sign").alias("_sign")).where("_sign <> 0")
    changed = held(differing.select(*keys).distinct())
    stays = {r[0] for r in new.select(day).distinct().collect()}  # one row a day
    emptied = [r[0].isoformat() for r in days.collect() if r[0] not in stays]
    wh.replace_partitions(new.hint("rebalance", day), table, day, emptied)
    return changed


def _apply(spark: SparkSession, wh: Warehouse, sla: DataFrame, now: datetime, since) -> None:
    scans = wh.read(spark, silver.TRACKING_TABLE, silver.TRACKING_STORED)
    events = wh.read(spark, silver.PARCEL_TABLE, silver.PARCEL_STORED)
    scan_days = _changed_days(spark, wh, scans, silver.TRACKING_TABLE, SCAN_DAYS_TABLE, "event_day", since)
    event_days = _changed_days(spark, wh, events, silver.PARCEL_TABLE, PARCEL_DAYS_TABLE, "occurred_day", since)
    wh.drop(spark, STATE_TABLE)
    new_scans = day_milestones(scans.join(scan_days, "event_day", "left_semi"))
    numbers = _replaced(wh, scan_days, _scan_days(spark, wh), new_scans, SCAN_DAYS_TABLE, "event_day", ["carrier_code", "tracking_number"])
    new_events = day_parcels(events.join(event_days, "occurred_day", "left_semi"))
    ids = _replaced(wh, event_days, _parcel_days(spark, wh), new_events, PARCEL_DAYS_TABLE, "occurred_day", ["parcel_id"])

    current = wh.read(spark, SHIPMENTS_TABLE, SHIPMENTS_STORED)
    scanned = current.join(numbers, ["carrier_code", "tracking_number"], "left_semi").select("parcel_id")
    concerned = held(ids.unionByName(scanned).distinct())
    parcels = held(merged_parcels(_parcel_days(spark, wh).join(concerned, "parcel_id", "left_semi")))
    of_parcels = parcels.select("carrier_code", "tracking_number").distinct()
    milestones = merged_milestones(_scan_days(spark, wh).join(of_parcels, ["carrier_code", "tracking_number"], "left_semi"))
    fresh = held(_stored_shipments(assemble(parcels, milestones, sla), fixed_time(now)))

    month = "handed_over_month"
    before = current.join(concerned, "parcel_id", "left_semi").select(month)
    months = held(before.unionByName(fresh.select(month)).distinct().withColumnRenamed(month, "_month"))
    same_month = F.col(month).eqNullSafe(F.col("_month"))
    stay = current.join(months, same_month, "left_semi").join(concerned, "parcel_id", "left_anti").select(*SHIPMENTS_STORED.names)
    rows = stay.unionByName(fresh)
    filled = {r[0] for r in rows.select(month).distinct().collect()}  # one row a month
    emptied = [r[0] and r[0].isoformat() for r in months.collect() if r[0] not in filled]
    wh.replace_partitions(rows.hint("rebalance", month), SHIPMENTS_TABLE, month, emptied)


def dim_carriers(spark: SparkSession, wh: Warehouse) -> DataFrame:
    return wh.read(spark, CARRIERS_TABLE, CARRIERS_STORED).select(*schemas.DIM_CARRIERS.names)


def dim_organisations(spark: SparkSession, wh: Warehouse) -> DataFrame:
    return wh.read(spark, ORGANISATIONS_TABLE, ORGANISATIONS_STORED).select(*schemas.DIM_ORGANISATIONS.names)


def shipments(spark: SparkSession, wh: Warehouse) -> DataFrame:
    return wh.read(spark, SHIPMENTS_TABLE, SHIPMENTS_STORED).select(*SHIPMENT_COLUMNS)
