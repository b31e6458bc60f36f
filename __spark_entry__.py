"""

Every query runs the library's operators over whole driver tables re-shaped as
parcel data (see ``shipyard/analogues.py``); its oracle computes the expected
rows in DuckDB straight from the source columns. Doubles that come out of an
aggregation are rounded to 6 decimals on both sides; everything else is exact.

Four queries exercise the file-based paths: ``line_numbers``,
``reference_dims``, ``stream_bronze`` and ``end_to_end_run`` write files
derived from the tables into a fresh folder under the session's
``spark.checkpoint.dir`` and read them back through the library.
"""

from __future__ import annotations

import dataclasses
import os
import sys
import uuid
from collections.abc import Callable
from urllib.parse import unquote
from datetime import date, datetime

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from shipyard import analogues as an  # noqa: E402
from shipyard.analogues import DUCK, K, STATUS_OF_TYPE, select_sql  # noqa: E402
from shipyard import schemas  # noqa: E402
from shipyard.functions.codes import (  # noqa: E402
    CARRIER_B_STATUS_BY_CODE,
    CARRIER_C_STATUS_BY_CODE,
    is_known_status,
    python_text,
    status_from_code,
)
from shipyard.functions.timestamps import parse_epoch_millis, parse_iso8601_utc, parse_naive_utc  # noqa: E402
from shipyard.functions.weights import grams_to_kg, weight_kg_from_dims  # noqa: E402
from shipyard.operators.dedup import keep_first  # noqa: E402
from shipyard.operators.milestones import carrier_milestones, parcel_rows  # noqa: E402
from shipyard.operators.quality import DataQualityError, breach_details, quarantine_rates, shipment_checks  # noqa: E402
from shipyard.operators.validate import normalize_parcel_events  # noqa: E402
from shipyard.plans import gold, reports  # noqa: E402
from shipyard.plans.run import run_all  # noqa: E402
from shipyard.plans.gold import shipments_frame, sla_lookup  # noqa: E402
from shipyard.plans.silver import normalized_tracking, parcel_bad, parcel_good, tracking_bad, tracking_good  # noqa: E402
from shipyard.plans.sql_access import (  # noqa: E402
    QueryNotAllowedError,
    describe_view,
    first_rows,
    open_query_session,
    query_frame,
)
from shipyard.session import checkpoint_dir, prepare  # noqa: E402
from shipyard.sources import bronze  # noqa: E402
from shipyard.sources.bronze import parse_feed_lines  # noqa: E402
from shipyard.sources.bronze import table as bronze_table  # noqa: E402
from shipyard.streaming.incremental import start_bronze_stream  # noqa: E402
from shipyard.sources.feeds import CARRIER_A, FEEDS  # noqa: E402
from shipyard.sources.raw_files import file_name_of, list_raw_files, stage_lines  # noqa: E402
from shipyard.sources.reference import load_carriers, load_organisations  # noqa: E402
from shipyard.warehouse import Warehouse, fixed_time  # noqa: E402

FLAGSHIP_SF = "/root/testdata/sf0.001"
LOADED_AT = datetime(2026, 1, 1)
ROUND = 6

# Parameters of the parameterised reports.
ORG_ID, ORG_MONTH = 3, date(1997, 6, 1)
HEAVY_KG = 25.0
SQL_CAP = 200

# Days of ``events``: files up to the first are loaded by name, the second one is
# delivered again with blank lines only.
EARLY_DAY, BLANK_DAY = "20240105", "20240107"
# Delivered a third time: one with its first lines, one cut off in the middle of the gzip.
RESTORED_DAY, DAMAGED_DAY = "20240103", "20240104"
# An eighth of a quarter of the scans: over the gate's limit in three quarters of
# the lines, under it in all of them.
FAILED_GATE_NOISE = "((l_orderkey div 4 + l_linenumber) % 8 = 0)"


def _r(col: str) -> F.Column:
    return F.round(F.col(col), ROUND).alias(col)


# ======================================================================= Spark
def _bronze_rows(spark, sf):
    prepare(spark)
    lines = an.feed_a_lines(spark, sf).drop("event_id")
    return parse_feed_lines(lines, CARRIER_A, fixed_time(LOADED_AT))


def q_bronze_good(spark, sf):
    rows = _bronze_rows(spark, sf)
    return rows.where(F.col("error").isNull()).select(*CARRIER_A.payload_columns, "source_file", "source_line_no")


def q_bronze_quarantine(spark, sf):
    rows = _bronze_rows(spark, sf)
    return rows.where(F.col("error").isNotNull()).select("source_file", "source_line_no", "raw_line", "error")


def _fresh(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _feed_a_files(spark, sf, folder: str, second: bool = False, days: tuple = ()) -> None:
    """Carrier-A lines of ``events`` as one gzip file per day (of ``days``, if given).
    The second delivery of the same files lacks every third event, and one day holds
    blank lines only."""
    day = an.SPARK.day("ts")
    ev = an.table(spark, sf, "events")
    ev = ev.where(F.expr(day).isin(*days)) if days else ev
    columns = dict(an.feed_a_line_columns(an.SPARK))
    lines = ev.selectExpr(f"{day} AS day", "event_id AS place", f"{columns['line']} AS line")
    if second:
        lines = lines.where("place % 3 <> 0").withColumn("line", F.expr(f"CASE WHEN day = '{BLANK_DAY}' THEN '  ' ELSE line END"))
    an.write_named_files(lines.selectExpr("'feed_a_' || day || '.json.gz' AS name", "place", "line"), folder)


def q_skip_ingested(spark, sf):
    """SRC-11 through ``ingest``: some files are loaded by name, then a run over
    the whole folder loads the others; what that run loaded."""
    prepare(spark)
    root = _fresh(spark, "skip-ingested")
    _feed_a_files(spark, sf, f"{root}/raw")
    wh = Warehouse(f"{root}/warehouse")
    listed = list_raw_files(spark, f"{root}/raw", CARRIER_A.glob)
    early = [p for p in listed if file_name_of(p) <= f"feed_a_{EARLY_DAY}.json.gz"]
    bronze.ingest_paths(spark, wh, CARRIER_A, early)
    loaded = bronze.ingest(spark, wh, CARRIER_A, f"{root}/raw")
    return _load_results(spark, loaded)


def _load_results(spark, results) -> DataFrame:
    rows = [(r.source_file, r.rows_loaded, r.rows_quarantined) for r in results]
    return spark.createDataFrame(rows, "source_file string, rows_loaded long, rows_quarantined long")


def _reloaded(spark, sf, name: str):
    """The first delivery of all files loaded, then the second with ``force``."""
    prepare(spark)
    root = _fresh(spark, name)
    _feed_a_files(spark, sf, f"{root}/first")
    _feed_a_files(spark, sf, f"{root}/second", second=True)
    wh = Warehouse(f"{root}/warehouse")
    bronze.ingest(spark, wh, CARRIER_A, f"{root}/first")
    return wh, bronze.ingest(spark, wh, CARRIER_A, f"{root}/second", force=True)


def _line_text(d) -> str:
    return (
        "CASE WHEN event_id % 97 = 0 THEN '' WHEN event_id % 89 = 0 THEN '   ' "
        f"ELSE '{{\"id\": ' || CAST(event_id AS STRING) || ', \"at\": \"' || {d.iso('ts')} || '\"}}' END"
    )


def q_line_numbers(spark, sf):
    """SRC-2 on real gzip files: ``events`` written as one gzip file per day
    (rows in ``event_id`` order, some lines blank) into a fresh folder under
    the checkpoint dir, then read back, many files in a task, with 1-based
    physical line numbers."""
    out = f"{checkpoint_dir(spark).rstrip('/')}/line-numbers-{uuid.uuid4().hex}"
    ev = an.table(spark, sf, "events").selectExpr(f"{an.SPARK.day('ts')} AS day", "event_id", f"{_line_text(an.SPARK)} AS value")
    (
        ev.repartition("day")
        .sortWithinPartitions("day", "event_id")
        .select("day", "value")
        .write.partitionBy("day")
        .text(out, compression="gzip")
    )
    paths = [unquote(u) for u in spark.read.text(out).inputFiles()]
    lines = stage_lines(spark, paths, _fresh(spark, "line-numbers-staged"))
    day = F.regexp_extract(F.col("source_path"), r"day=(\d{8})/", 1)
    return lines.select(day.alias("day"), "source_line_no", "line")


def q_end_to_end_run(spark, sf):
    """PL-1 and the whole file path: gzipped feeds and reference files derived
    from the tables are written to a fresh folder under the checkpoint dir,
    then bronze x4, gate, silver x2, gate, dimensions, shipments, gate run on
    them; the result is the stored ``gold.shipments``."""
    scratch = f"{checkpoint_dir(spark).rstrip('/')}/end-to-end-{uuid.uuid4().hex}"
    raw = f"{scratch}/raw"
    an.write_raw_feeds(spark, sf, raw)
    feeds = [dataclasses.replace(f, glob="*.txt.gz") for f in FEEDS]
    refs = {"carriers": (f"{raw}/reference/carriers", "*.json"), "organisations": (f"{raw}/reference/organisations", "*.json")}
    wh = Warehouse(f"{scratch}/warehouse")
    run_all(spark, wh, raw, f"{raw}/reference", feeds=feeds, reference_files=refs)
    return gold.shipments(spark, wh).drop("_gold_loaded_at")


def q_reference_dims(spark, sf):
    """SRC-8/9 and the SLA rule of JN-2 on real files: a carriers file where
    codes repeat (the last line must win) and an organisations file with
    optional ISO ``created_at``, written from ``region`` / ``nation`` in a
    known line order, loaded by the reference loaders."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/reference-{uuid.uuid4().hex}"
    carriers = an.table(spark, sf, "region").selectExpr(
        "r_regionkey AS k",
        "to_json(named_struct('carrier_code', 'carrier_' || CAST(r_regionkey % 3 AS STRING), 'carrier_name', r_name, "
        "'sla_hours', CAST((r_regionkey + 1) * 10 AS INT), 'countries_served', array('NL'))) AS value",
    )
    orgs = an.table(spark, sf, "nation").selectExpr(
        "n_nationkey AS k",
        "to_json(named_struct('organisation_id', n_nationkey, 'name', n_name, 'plan', 'growth', 'created_at', "
        "CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE '2020-01-' || lpad(CAST(n_nationkey + 1 AS STRING), 2, '0') || 'T06:30:00Z' END)) AS value",
    )
    for name, df in (("carriers", carriers), ("organisations", orgs)):
        df.orderBy("k").coalesce(1).select("value").write.text(f"{root}/{name}")
    sla = sla_lookup(load_carriers(spark, f"{root}/carriers", "part-*"))
    org = load_organisations(spark, f"{root}/organisations", "part-*")
    return org.join(F.broadcast(sla), org["organisation_id"] % 3 == F.substring(sla["carrier_code"], 9, 1).cast("int"), "left").select(
        "organisation_id", "name", "plan", "created_at", "carrier_code", "sla_hours"
    )


def q_stream_bronze(spark, sf):
    """The Structured Streaming bronze load on real files: carrier-A lines built
    from ``events`` (bad and blank lines included) written as one gzip file per
    day into a folder with pattern characters in its name, loaded by ``start_bronze_stream`` with an availableNow trigger into a
    fresh warehouse; the good rows with their line numbers."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/stream-bronze-{uuid.uuid4().hex}"
    lines = an.table(spark, sf, "events").selectExpr(f"{an.SPARK.day('ts')} AS day", *[f"{e} AS {n}" for n, e in an.feed_a_line_columns(an.SPARK)])
    (
        lines.repartition("day")
        .sortWithinPartitions("day", "event_id")
        .selectExpr("day", "line AS value")
        .write.partitionBy("day")
        .text(f"{root}/raw[1]", compression="gzip")
    )
    wh = Warehouse(f"{root}/warehouse")
    feed = dataclasses.replace(CARRIER_A, glob="*.txt.gz")
    start_bronze_stream(spark, wh, feed, f"{root}/raw[1]", checkpoint_location=f"{root}/checkpoint").awaitTermination()
    return bronze_table(spark, wh, feed).select(*CARRIER_A.payload_columns, "source_line_no")


def q_partition_replace(spark, sf):
    """SNK-1 through ``ingest(force=True)``: the stored rows, good and bad, after
    every file was delivered again with other lines, one with blank lines only, and
    two a third time: one whole, and one cut off, which keeps its old rows."""
    wh, _ = _reloaded(spark, sf, "partition-replace")
    root = _fresh(spark, "third-delivery")
    _feed_a_files(spark, sf, f"{root}/whole", days=(RESTORED_DAY, DAMAGED_DAY))
    an.copy_file(spark, f"{root}/whole/feed_a_{RESTORED_DAY}.json.gz", f"{root}/third/feed_a_{RESTORED_DAY}.json.gz")
    an.copy_file(spark, f"{root}/whole/feed_a_{DAMAGED_DAY}.json.gz", f"{root}/third/feed_a_{DAMAGED_DAY}.json.gz", share=0.5)
    results = bronze.ingest(spark, wh, CARRIER_A, f"{root}/third", force=True)
    if [r.source_file for r in results if r.error] != [f"feed_a_{DAMAGED_DAY}.json.gz"]:
        raise AssertionError("the cut-off file was not reported")
    return bronze.stored(spark, wh, CARRIER_A).select(
        "source_file", "source_line_no", "tracking_no", "weight_kg", "raw_line", "error"
    )


def q_load_totals(spark, sf):
    """SNK-7: the row counts that the forced reload returned."""
    return _load_results(spark, _reloaded(spark, sf, "load-totals")[1])


def q_raw_records(spark, sf):
    """SNK-6, FN-10 and PRJ-3: the records kept of rejected lifecycle rows. Their
    keys (all columns, nulls kept, without the personal one) and some values."""
    prepare(spark)
    bad = parcel_bad(normalize_parcel_events(an.lifecycle_rows(spark, sf)))
    record = F.col("raw_record")
    return bad.select(
        "source_file",
        "source_line_no",
        "reason",
        F.array_join(F.array_sort(F.json_object_keys(record)), ",").alias("keys"),
        F.get_json_object(record, "$.service_level").alias("service_level"),
        F.get_json_object(record, "$.organisation_id").cast("int").alias("organisation_id"),
        F.get_json_object(record, "$.occurred_at").alias("occurred_at"),
    )


def q_schema_evolution(spark, sf):
    """SNK-4 and SRC-13: shipments written before two columns were declared read
    back with these null; a table never written reads as empty."""
    prepare(spark)
    wh = Warehouse(_fresh(spark, "evolution[1]"))
    old = an.table(spark, sf, "orders").selectExpr(
        "CAST(o_orderkey AS INT) AS parcel_id", "'T' || CAST(o_orderkey AS STRING) AS tracking_number", "o_orderstatus = 'F' AS is_delivered"
    )
    wh.overwrite(old, gold.SHIPMENTS_TABLE)
    kept = wh.read(spark, gold.SHIPMENTS_TABLE, gold.SHIPMENTS_STORED)
    absent = wh.read(spark, "gold.never_written", gold.SHIPMENTS_STORED)
    return kept.unionByName(absent).select("parcel_id", "tracking_number", "is_delivered", "is_lost", "is_returned", "sla_hours")


def q_incremental_after_failed_gate(spark, sf):
    """PL-1 with ``incremental_silver``: half of the orders; a delivery whose
    garbage breaches the bronze gate and stops the run; the rest, which dilutes
    the garbage. The last run must take in the files of the stopped one, too."""
    scratch = _fresh(spark, "failed-gate")
    raw, wh = f"{scratch}/raw", Warehouse(f"{scratch}/warehouse")
    feeds = [dataclasses.replace(f, glob="*.txt.gz") for f in FEEDS]
    refs = {"carriers": (f"{raw}/reference/carriers", "*.json"), "organisations": (f"{raw}/reference/organisations", "*.json")}

    def run():
        return run_all(spark, wh, raw, f"{raw}/reference", feeds=feeds, reference_files=refs, incremental_silver=True)

    an.write_raw_feeds(spark, sf, raw, orders_where="o_orderkey % 4 < 2")
    run()
    an.write_raw_feeds(spark, sf, raw, orders_where="o_orderkey % 4 = 2", noise=FAILED_GATE_NOISE, reference=False)
    try:
        run()
        raise AssertionError("the bronze gate let the garbage through")
    except DataQualityError:
        pass
    an.write_raw_feeds(spark, sf, raw, orders_where="o_orderkey % 4 = 3", reference=False)
    run()
    return gold.shipments(spark, wh).drop("_gold_loaded_at")


def q_incremental_gold(spark, sf):
    """AGG-1 to AGG-4 and SNK-3 with ``incremental_gold``: three deliveries. The first
    holds the lifecycle events of all orders and the scans of a half; scans of the
    others come late, for parcels of all months, in the second and the third."""
    scratch = _fresh(spark, "incremental-gold")
    raw, wh = f"{scratch}/raw", Warehouse(f"{scratch}/warehouse")
    feeds = [dataclasses.replace(f, glob="*.txt.gz") for f in FEEDS]
    refs = {"carriers": (f"{raw}/reference/carriers", "*.json"), "organisations": (f"{raw}/reference/organisations", "*.json")}
    for k, late in enumerate(("l_orderkey % 4 < 2", "l_orderkey % 4 = 2", "l_orderkey % 4 = 3")):
        an.write_raw_feeds(spark, sf, raw, scans_where=late, life=k == 0, reference=k == 0)
        run_all(spark, wh, raw, f"{raw}/reference", feeds=feeds, reference_files=refs, incremental_silver=True, incremental_gold=True)
    return gold.shipments(spark, wh).drop("_gold_loaded_at")


def _iso_text():
    d = an.SPARK
    return (
        f"CASE WHEN event_id % 40 = 0 THEN {d.iso('ts')} || 'Q' "
        f"WHEN event_id % 41 = 0 THEN {d.iso('ts')} || '999Z' "
        f"WHEN event_id % 42 = 0 THEN lower({d.iso('ts')}) || '+00:00:00' "
        f"WHEN event_id % 43 = 0 THEN {d.iso(d.add_minutes('ts', '-61'))} || '-01:01:00' "
        f"WHEN event_id % 44 = 0 THEN replace(replace({d.iso('ts')}, '-', ''), ':', '') || 'Z' "
        f"WHEN event_id % 45 = 0 THEN {d.iso_date('ts')} "
        f"WHEN event_id % 5 = 0 THEN {d.iso('ts')} || 'Z' "
        f"WHEN event_id % 5 = 1 THEN {d.iso(d.add_minutes('ts', '120'))} || '+02:00' "
        f"WHEN event_id % 5 = 2 THEN replace({d.iso('ts')}, 'T', ' ') "
        f"WHEN event_id % 5 = 3 THEN {d.iso_minutes('ts')} || 'Z' "
        f"ELSE {d.iso(d.add_minutes('ts', '-330'))} || '-0530' END"
    )


def q_parse_iso(spark, sf):
    prepare(spark)
    ev = an.table(spark, sf, "events").selectExpr("event_id", f"{_iso_text()} AS text")
    return ev.select("event_id", parse_iso8601_utc(F.col("text")).alias("parsed_at"))


def q_parse_naive(spark, sf):
    prepare(spark)
    d = an.SPARK
    text = (
        f"CASE WHEN event_id % 40 = 0 THEN {d.naive('ts')} || 'x' "
        f"WHEN event_id % 3 = 0 THEN {d.naive('ts', sep='  ')} "
        f"WHEN event_id % 2 = 0 THEN {d.naive('ts', unpadded=True)} ELSE {d.naive('ts')} END"
    )
    ev = an.table(spark, sf, "events").selectExpr("event_id", f"{text} AS text")
    return ev.select("event_id", parse_naive_utc(F.col("text")).alias("parsed_at"))


def q_parse_millis(spark, sf):
    prepare(spark)
    t = (
        "CASE WHEN event_id % 40 = 0 THEN CAST(300000000000000 AS BIGINT) "
        "WHEN event_id % 41 = 0 THEN CAST(-62135596800001 AS BIGINT) "
        f"ELSE {an.SPARK.millis('ts')} END"
    )
    ev = an.table(spark, sf, "events").selectExpr("event_id", f"{t} AS t")
    return ev.select("event_id", parse_epoch_millis(F.col("t")).alias("parsed_at"))


def q_status_map(spark, sf):
    ev = an.table(spark, sf, "events").selectExpr(
        "event_id",
        f"{K} AS k",
        "CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS descr",
        "upper(event_type) AS up",
    )
    mapped = ev.select(
        "event_id",
        "up",
        status_from_code(F.col("k"), CARRIER_B_STATUS_BY_CODE).alias("b_status"),
        status_from_code(F.col("k") % 10, CARRIER_C_STATUS_BY_CODE).alias("c_status"),
        F.concat(python_text(F.col("k")), F.lit(":"), python_text(F.col("descr"))).alias("raw_status_b"),
    )
    probe = F.when(F.col("event_id") % 3 == 0, F.col("up")).when(F.col("event_id") % 3 == 1, F.col("b_status"))
    return mapped.select("event_id", "b_status", "c_status", "raw_status_b", is_known_status(probe).alias("known"))


def _dims_text():
    return (
        "CASE WHEN event_id % 40 = 0 THEN 'not json' "
        f"WHEN event_id % 5 = 0 THEN '{{\"weight\": ' || CAST({K} AS STRING) || '}}' "
        f"WHEN event_id % 5 = 1 THEN '{{\"weight\": {{\"v\": ' || CAST({K} AS STRING) || '.5, \"u\": \"kg\"}}}}' "
        f"WHEN event_id % 5 = 2 THEN '{{\"weight\": {{\"v\": ' || CAST({K} AS STRING) || ', \"u\": \"g\"}}}}' "
        f"WHEN event_id % 5 = 3 THEN '{{\"weight\": \"' || CAST({K} AS STRING) || '\"}}' "
        "ELSE '{\"size\": 1}' END"
    )


def q_weight_poly(spark, sf):
    ev = an.table(spark, sf, "events").selectExpr("event_id", f"{_dims_text()} AS dims", f"CAST({K} * 10 AS DOUBLE) AS grams")
    return ev.select(
        "event_id",
        weight_kg_from_dims(F.col("dims")).alias("weight_kg"),
        grams_to_kg(F.col("grams")).alias("kg_from_grams"),
    )


def _normalized_feeds(spark, sf):
    prepare(spark)
    return normalized_tracking(an.carrier_feeds(spark, sf))


def q_union_feeds(spark, sf):
    norm = _normalized_feeds(spark, sf)
    good = F.col("reason").isNull()
    payload = ["tracking_number", "status", "event_time", "weight_kg", "facility_code", "raw_status"]
    return norm.select(
        "carrier_code",
        "source_file",
        "source_line_no",
        "reason",
        *[F.when(good, F.round(F.col(c), ROUND) if c == "weight_kg" else F.col(c)).alias(c) for c in payload],
    )


def q_validate_reason(spark, sf):
    prepare(spark)
    norm = normalize_parcel_events(an.lifecycle_rows(spark, sf))
    return norm.select(
        "source_file", "source_line_no", "reason", F.when(F.col("reason").isNull(), F.col("occurred_at")).alias("occurred_at")
    )


def q_dedup_keep_first(spark, sf):
    ev = an.table(spark, sf, "events").withColumn("hour", F.date_trunc("HOUR", "ts").cast("timestamp_ntz"))
    return keep_first(ev, ["user_id", "event_type", "hour"], ["event_id"])


LINEITEM_ORDER = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
    "l_shipdate",
]


def q_dedup_id(spark, sf):
    # Every other column orders the copies, so "first" is total (identical rows are interchangeable).
    return keep_first(an.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], LINEITEM_ORDER)


def q_milestones(spark, sf):
    return carrier_milestones(an.event_scans(spark, sf))


def q_parcels(spark, sf):
    return parcel_rows(an.lineitem_lifecycle(spark, sf))


def _shipments(spark, sf) -> DataFrame:
    prepare(spark)
    return shipments_frame(an.lineitem_scans(spark, sf), an.order_parcel_events(spark, sf), an.carriers(spark, sf))


def q_shipments(spark, sf):
    return _shipments(spark, sf)


def _rate_pairs(spark, sf):
    rows = _bronze_rows(spark, sf)
    norm = _normalized_feeds(spark, sf)
    life = normalize_parcel_events(an.lifecycle_rows(spark, sf))
    return [
        ("bronze.carrier_a", rows, F.col("error").isNotNull()),
        ("silver.tracking_events", tracking_good(norm), tracking_bad(norm)),
        ("silver.parcel_events", parcel_good(life), parcel_bad(life)),
    ]


def q_quarantine_rate(spark, sf):
    rates = quarantine_rates(_rate_pairs(spark, sf))
    return rates.select("table", "rows_loaded", "rows_quarantined", _r("rate"))


def q_gate_breach(spark, sf):
    return breach_details(quarantine_rates(_rate_pairs(spark, sf)))


def q_gold_checks(spark, sf):
    return shipment_checks(_shipments(spark, sf))


def q_org_month_by_carrier(spark, sf):
    return reports.shipments_by_carrier(_shipments(spark, sf), ORG_ID, ORG_MONTH)


def q_worst_on_time(spark, sf):
    return reports.worst_on_time(_shipments(spark, sf), HEAVY_KG).select("carrier_code", "resolved_parcels", _r("on_time_rate"))


def q_monthly_performance(spark, sf):
    out = reports.monthly_performance(_shipments(spark, sf))
    return out.select("month", *reports.BREAKDOWN, "parcels", "resolved_parcels", _r("on_time_rate"), _r("mean_transit_hours"))


def q_loss_rates(spark, sf):
    out = reports.loss_rates(_shipments(spark, sf))
    return out.select("month", *reports.BREAKDOWN, "parcels", _r("on_time_rate"), _r("lost_rate"), _r("returned_rate"))


def q_volume_vs_resolved(spark, sf):
    out = reports.volume_vs_resolved(_shipments(spark, sf))
    return out.select("month", "carrier_code", "parcels", "resolved_parcels", "unresolved_parcels", _r("on_time_rate"))


SQL_CAPPED = (
    "SELECT parcel_id, carrier_code, transit_hours FROM shipments WHERE is_delivered "
    "ORDER BY transit_hours DESC, parcel_id"
)
SQL_JOIN = (
    "SELECT s.carrier_code, c.carrier_name, o.name AS organisation, COUNT(*) AS parcels "
    "FROM shipments s JOIN dim_carriers c ON s.carrier_code = c.carrier_code "
    "JOIN dim_organisations o ON s.organisation_id = o.organisation_id "
    "GROUP BY s.carrier_code, c.carrier_name, o.name ORDER BY parcels DESC, s.carrier_code, organisation"
)
SQL_UNION = (
    "SELECT carrier_code AS code, 'lost' AS kind, COUNT(*) AS n FROM shipments WHERE is_lost GROUP BY carrier_code "
    "UNION ALL SELECT carrier_code, 'returned', COUNT(*) FROM shipments WHERE is_returned GROUP BY carrier_code "
    "UNION SELECT carrier_code, 'sla', sla_hours FROM dim_carriers ORDER BY code, kind"
)


def _gold_session(spark, sf) -> SparkSession:
    prepare(spark)
    return open_query_session(
        spark,
        {
            "shipments": lambda s: _shipments(s, sf),
            "dim_carriers": lambda s: an.carriers(s, sf).drop("source_line_no"),
            "dim_organisations": lambda s: an.organisations(s, sf),
        },
    )


def q_sql_capped(spark, sf):
    """LIM-1: the rows that a reader gets, and whether there are more."""
    return first_rows(_gold_session(spark, sf), SQL_CAPPED, SQL_CAP)


def q_sql_join(spark, sf):
    return query_frame(_gold_session(spark, sf), SQL_JOIN)


def q_sql_union(spark, sf):
    return query_frame(_gold_session(spark, sf), SQL_UNION)


# QRY-2: statements, and the columns of those that may run.
SQL_VERDICTS = [
    ("SELECT carrier_code, count(*) AS n, count(DISTINCT organisation_id) AS senders FROM shipments GROUP BY carrier_code", ["carrier_code", "n", "senders"]),
    ("SELECT count(*) AS n FROM shipments WHERE destination_country <> ';' OR destination_country = 'DROP VIEW shipments;'", ["n"]),
    (
        "WITH late AS (SELECT * FROM shipments WHERE NOT is_on_time), per AS (SELECT organisation_id, count(*) AS n FROM late GROUP BY organisation_id) "
        "SELECT o.name, per.n FROM per JOIN dim_organisations o ON o.organisation_id = per.organisation_id",
        ["name", "n"],
    ),
    ("WITH shipments AS (SELECT * FROM shipments WHERE is_lost) SELECT carrier_code, count(*) AS n FROM shipments GROUP BY carrier_code", ["carrier_code", "n"]),
    ("SELECT count(*) AS n, max(parcel_id) AS newest FROM shipments s WHERE EXISTS (SELECT 1 FROM dim_carriers c WHERE c.carrier_code = s.carrier_code)", ["n", "newest"]),
    ("WITH RECURSIVE t(n) AS (SELECT 1 UNION ALL SELECT n + 1 FROM t WHERE n < 3) SELECT n, (SELECT count(*) FROM shipments WHERE is_returned) AS m FROM t", ["n", "m"]),
    ("WITH hidden AS (SELECT * FROM hidden) SELECT * FROM hidden", None),
    ("SELECT (WITH i AS (SELECT 1 AS x) SELECT max(x) FROM i), * FROM i", None),
    ("WITH a AS (SELECT * FROM b), b AS (SELECT 1 AS n) SELECT * FROM a", None),
    ("SELECT * FROM orders", None),
    ("SELECT count(*) FROM shipments; SELECT 2", None),
    ("DROP VIEW shipments", None),
    ("CREATE TEMPORARY VIEW v AS SELECT * FROM shipments", None),
    ("SELECT java_method('java.lang.System', 'getProperty', carrier_code) FROM shipments", None),
    ("SELECT * FROM csv.`/tmp`", None),
    ("", None),
]


def q_sql_verdicts(spark, sf):
    """QRY-2: what each statement gives over the whole gold tables, one row per
    result row with its values as text; one row without text for a refused one."""
    session = _gold_session(spark, sf)
    refused, out = [], None
    for k, (sql, _) in enumerate(SQL_VERDICTS):
        try:
            found = query_frame(session, sql)
        except QueryNotAllowedError:
            refused.append((k, False, None))
            continue
        rows = found.select(F.lit(k).alias("statement"), F.lit(True).alias("allowed"), F.concat_ws("|", *[F.col(c).cast("string") for c in found.columns]).alias("figures"))
        out = rows if out is None else out.unionByName(rows)
    return out.unionByName(session.createDataFrame(refused, "statement int, allowed boolean, figures string"))


def q_schema_document(spark, sf):
    """QRY-9: the documented columns of the shipments view, each with its number of values."""
    session = _gold_session(spark, sf)
    text = {f.name: f.metadata.get("comment") for f in schemas.SHIPMENTS.fields}
    documented = [(k, name, kind, bool(text[name])) for k, (name, kind, _) in enumerate(describe_view(session, "shipments"))]
    counts = session.table("shipments").agg(*[F.count(name).alias(name) for _, name, _, _ in documented])
    columns = ", ".join(f"named_struct('place', {k}, 'column', '{name}', 'type', '{kind}', 'has_text', {str(text).lower()}, 'n', `{name}`)" for k, name, kind, text in documented)
    return counts.selectExpr(f"inline(array({columns}))").withColumnRenamed("n", "n_values")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_good": q_bronze_good,
    "bronze_quarantine": q_bronze_quarantine,
    "skip_ingested": q_skip_ingested,
    "line_numbers": q_line_numbers,
    "end_to_end_run": q_end_to_end_run,
    "reference_dims": q_reference_dims,
    "stream_bronze": q_stream_bronze,
    "partition_replace": q_partition_replace,
    "load_totals": q_load_totals,
    "raw_records": q_raw_records,
    "schema_evolution": q_schema_evolution,
    "incremental_after_failed_gate": q_incremental_after_failed_gate,
    "incremental_gold": q_incremental_gold,
    "parse_iso": q_parse_iso,
    "parse_naive": q_parse_naive,
    "parse_millis": q_parse_millis,
    "status_map": q_status_map,
    "weight_poly": q_weight_poly,
    "union_feeds": q_union_feeds,
    "validate_reason": q_validate_reason,
    "dedup_keep_first": q_dedup_keep_first,
    "dedup_id": q_dedup_id,
    "milestones": q_milestones,
    "parcels": q_parcels,
    "shipments": q_shipments,
    "quarantine_rate": q_quarantine_rate,
    "gate_breach": q_gate_breach,
    "gold_checks": q_gold_checks,
    "org_month_by_carrier": q_org_month_by_carrier,
    "worst_on_time": q_worst_on_time,
    "monthly_performance": q_monthly_performance,
    "loss_rates": q_loss_rates,
    "volume_vs_resolved": q_volume_vs_resolved,
    "sql_capped": q_sql_capped,
    "sql_join": q_sql_join,
    "sql_union": q_sql_union,
    "sql_verdicts": q_sql_verdicts,
    "schema_document": q_schema_document,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: on-time rate per carrier for heavy parcels (gold shipments
    built from the sf0.001 tables, then the report)."""
    return queries()["worst_on_time"](spark, FLAGSHIP_SF)


def _prepared(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Apply the session settings the library relies on (UTC session zone,
    variant duplicate keys) to whatever session the caller passes in."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _added() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and oracles of the ``llm`` subpackage and of ``corpus_pipeline``;
    none of them where these, or what they import, are not installed."""
    try:
        from shipyard.llm import queries as llm
    except ImportError:
        return {}, {}
    found, oracles = dict(llm.QUERIES), dict(llm.ORACLES)
    try:
        import corpus_pipeline
    except ImportError:
        return found, oracles
    found["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        oracles["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, oracles


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _prepared(fn) for name, fn in {**QUERIES, **_added()[0]}.items()}


# ====================================================================== oracle
D = DUCK
ISO = D.iso("ts")


def _lines_cte() -> str:
    return select_sql(an.feed_a_line_columns(D) + [("user_id", "user_id"), ("event_type", "event_type"), ("ts", "ts"), ("props", "props")], "events")


GOOD_A = "NOT (event_id % 50 = 0 OR event_id % 97 = 0 OR event_id % 61 = 0 OR event_id % 71 = 0)"
BAD_A = "(event_id % 50 = 0 OR (event_id % 97 <> 0 AND (event_id % 61 = 0 OR event_id % 71 = 0)))"
ERROR_A = "CASE WHEN event_id % 50 = 0 THEN 'invalid_json' WHEN event_id % 61 = 0 THEN 'not_an_object' ELSE 'type_mismatch:weight_kg' END"


def o_bronze_good() -> str:
    return f"""
WITH l AS ({_lines_cte()})
SELECT CAST(user_id AS VARCHAR) AS tracking_no, upper(event_type) AS status, {ISO} || 'Z' AS ts,
       CAST({K} AS DOUBLE) + 0.25 AS weight_kg, 'H' || CAST(event_id % 7 AS VARCHAR) AS hub,
       {ISO} || 'Z' AS source_ingested_at, source_file, source_line_no
FROM l WHERE {GOOD_A}"""


def o_bronze_quarantine() -> str:
    return f"""
WITH l AS ({_lines_cte()})
SELECT source_file, source_line_no, line AS raw_line, {ERROR_A} AS error FROM l WHERE {BAD_A}"""


FILE_A = f"'feed_a_' || {D.day('ts')} || '.json.gz'"


def o_skip_ingested() -> str:
    return f"""
SELECT {FILE_A} AS source_file, count(*) FILTER (WHERE {GOOD_A}) AS rows_loaded, count(*) FILTER (WHERE {BAD_A}) AS rows_quarantined
FROM events WHERE {D.day('ts')} > '{EARLY_DAY}' GROUP BY 1"""


def o_line_numbers() -> str:
    return f"""
SELECT {D.day('ts')} AS day, CAST(row_number() OVER (PARTITION BY {D.day('ts')} ORDER BY event_id) AS INT) AS source_line_no,
       {_line_text(D)} AS line
FROM events"""


def o_end_to_end_run() -> str:
    created = (
        "(TIMESTAMP '2026-01-01 00:00:00' + to_days(CAST(o_orderkey % 182 AS INTEGER)) "
        "+ to_minutes(CAST(o_orderkey % 1440 AS BIGINT)))"
    )
    carrier = an.CARRIER_OF_KEY.format(k="l_orderkey")
    facility = (
        f"CASE {carrier} WHEN 'carrier_a' THEN 'H' || CAST(l_linenumber AS VARCHAR) "
        "WHEN 'carrier_b' THEN 'D' || CAST(l_linenumber AS VARCHAR) END"
    )
    return f"""
WITH o AS (SELECT o_orderkey, o_orderpriority, o_custkey, {created} AS created FROM orders),
li AS (SELECT l_orderkey, l_linenumber, created, max(l_linenumber) OVER (PARTITION BY l_orderkey) AS last_line
       FROM lineitem JOIN o ON l_orderkey = o_orderkey),
t AS (SELECT DISTINCT {carrier} AS carrier_code, 'T' || CAST(l_orderkey AS VARCHAR) AS tracking_number,
             {an.E2E_STATUS} AS status, created + to_minutes(CAST(360 + 60 * l_linenumber AS BIGINT)) AS event_time,
             {an.E2E_WEIGHT} AS weight_kg, {facility} AS facility_code, l_linenumber
      FROM li WHERE NOT {an.E2E_BROKEN}),
m AS (SELECT carrier_code, tracking_number,
             min(event_time) FILTER (WHERE status = 'ACCEPTED') AS accepted_at,
             min(event_time) FILTER (WHERE status = 'DELIVERED') AS delivered_at,
             arg_max(weight_kg, event_time) AS weight_kg,
             arg_max(status, event_time) AS latest_carrier_status,
             arg_max(facility_code, event_time) AS facility_code
      FROM t GROUP BY carrier_code, tracking_number),
p AS (SELECT CAST(o_orderkey AS INTEGER) AS parcel_id, 'T' || CAST(o_orderkey AS VARCHAR) AS tracking_number,
             CAST(c_nationkey AS INTEGER) AS organisation_id, {an.CARRIER_OF_KEY.format(k='o_orderkey')} AS carrier_code,
             o_orderpriority AS service_level, c_mktsegment AS destination_country,
             CAST(NULL AS VARCHAR) AS destination_postcode, created AS created_at,
             created + to_minutes(360) AS handed_over_at
      FROM o JOIN customer ON o_custkey = c_custkey),
sla AS (SELECT {an.E2E_CARRIER_OF_REGION} AS carrier_code, arg_max({an.E2E_SLA}, r_regionkey) AS sla_hours FROM region GROUP BY 1),
sj AS (SELECT p.*, m.accepted_at, m.delivered_at, m.latest_carrier_status, m.weight_kg, m.facility_code, sla.sla_hours,
              CASE WHEN m.delivered_at IS NOT NULL
                   THEN (epoch_us(m.delivered_at) - epoch_us(p.handed_over_at)) / 1000000.0 / 3600 END AS transit_hours
       FROM p LEFT JOIN m ON p.carrier_code = m.carrier_code AND p.tracking_number = m.tracking_number
              LEFT JOIN sla ON p.carrier_code = sla.carrier_code)
SELECT parcel_id, tracking_number, organisation_id, carrier_code, service_level, destination_country,
       destination_postcode, created_at, handed_over_at, accepted_at, delivered_at, latest_carrier_status,
       weight_kg, facility_code, sla_hours, transit_hours, delivered_at IS NOT NULL AS is_delivered,
       transit_hours <= sla_hours AS is_on_time,
       coalesce(latest_carrier_status = 'LOST', false) AS is_lost,
       coalesce(latest_carrier_status = 'RETURNED', false) AS is_returned
FROM sj"""


def o_reference_dims() -> str:
    return """
WITH sla AS (SELECT 'carrier_' || CAST(r_regionkey % 3 AS VARCHAR) AS carrier_code,
                    arg_max(CAST((r_regionkey + 1) * 10 AS INTEGER), r_regionkey) AS sla_hours
             FROM region GROUP BY 1)
SELECT CAST(n_nationkey AS INTEGER) AS organisation_id, n_name AS name, 'growth' AS plan,
       CASE WHEN n_nationkey % 5 = 0 THEN NULL
            ELSE TIMESTAMP '2020-01-01 06:30:00' + to_days(CAST(n_nationkey AS INTEGER)) END AS created_at,
       sla.carrier_code, sla.sla_hours
FROM nation LEFT JOIN sla ON n_nationkey % 3 = CAST(substring(sla.carrier_code, 9, 1) AS INTEGER)"""


def o_stream_bronze() -> str:
    return f"""
WITH l AS (SELECT *, CAST(row_number() OVER (PARTITION BY {D.day('ts')} ORDER BY event_id) AS INT) AS n FROM events)
SELECT CAST(user_id AS VARCHAR) AS tracking_no, upper(event_type) AS status, {ISO} || 'Z' AS ts,
       CAST({K} AS DOUBLE) + 0.25 AS weight_kg, 'H' || CAST(event_id % 7 AS VARCHAR) AS hub,
       {ISO} || 'Z' AS source_ingested_at, n AS source_line_no
FROM l WHERE {GOOD_A}"""


def _second_delivery() -> str:
    return f"""
WITH l AS ({_lines_cte()}),
d AS (SELECT *, {FILE_A} AS file, {D.day('ts')} = '{BLANK_DAY}' AS blank FROM l WHERE event_id % 3 <> 0),
n AS (SELECT *, CAST(row_number() OVER (PARTITION BY file ORDER BY event_id) AS INT) AS line_no FROM d)"""


def o_partition_replace() -> str:
    return _second_delivery() + f""",
first AS (SELECT *, {FILE_A} AS file, CAST(row_number() OVER (PARTITION BY {FILE_A} ORDER BY event_id) AS INT) AS line_no
          FROM l WHERE {D.day('ts')} = '{RESTORED_DAY}'),
stored AS (SELECT * EXCLUDE (blank) FROM n WHERE NOT blank AND {D.day('ts')} <> '{RESTORED_DAY}' UNION ALL BY NAME SELECT * FROM first)
SELECT file AS source_file, line_no AS source_line_no,
       CASE WHEN {GOOD_A} THEN CAST(user_id AS VARCHAR) END AS tracking_no,
       CASE WHEN {GOOD_A} THEN CAST({K} AS DOUBLE) + 0.25 END AS weight_kg,
       CASE WHEN {BAD_A} THEN line END AS raw_line, CASE WHEN {BAD_A} THEN {ERROR_A} END AS error
FROM stored WHERE {GOOD_A} OR {BAD_A}"""


def o_load_totals() -> str:
    return _second_delivery() + f"""
SELECT file AS source_file, count(*) FILTER (WHERE NOT blank AND {GOOD_A}) AS rows_loaded,
       count(*) FILTER (WHERE NOT blank AND {BAD_A}) AS rows_quarantined
FROM n GROUP BY file"""


def o_raw_records() -> str:
    keys = sorted(c for c, _ in an.lifecycle_columns(D) if c != "recipient_email")
    return f"""
WITH e AS ({_lifecycle_expected()}), p AS ({select_sql(an.lifecycle_columns(D), "events")})
SELECT e.source_file, e.source_line_no, reason, '{",".join(keys)}' AS keys, service_level, organisation_id, occurred_at
FROM e JOIN p ON e.source_file = p.source_file AND e.source_line_no = p.source_line_no WHERE reason IS NOT NULL"""


def o_schema_evolution() -> str:
    return """
SELECT CAST(o_orderkey AS INTEGER) AS parcel_id, 'T' || CAST(o_orderkey AS VARCHAR) AS tracking_number, o_orderstatus = 'F' AS is_delivered,
       CAST(NULL AS BOOLEAN) AS is_lost, CAST(NULL AS BOOLEAN) AS is_returned, CAST(NULL AS INTEGER) AS sla_hours FROM orders"""


def o_parse_iso() -> str:
    return """
SELECT event_id, CASE WHEN event_id % 40 = 0 THEN NULL WHEN event_id % 41 = 0 OR event_id % 42 = 0 OR event_id % 43 = 0 OR event_id % 44 = 0 THEN ts
  WHEN event_id % 45 = 0 THEN date_trunc('day', ts)
  WHEN event_id % 5 = 3 THEN date_trunc('minute', ts) ELSE ts END AS parsed_at
FROM events"""


def o_parse_naive() -> str:
    return "SELECT event_id, CASE WHEN event_id % 40 = 0 THEN NULL ELSE date_trunc('second', ts) END AS parsed_at FROM events"


def o_parse_millis() -> str:
    return """
SELECT event_id, CASE WHEN event_id % 40 = 0 OR event_id % 41 = 0 THEN NULL ELSE date_trunc('millisecond', ts) END AS parsed_at
FROM events"""


def o_status_map() -> str:
    # The code lists, written out: not taken from the library.
    b = (
        f"CASE {K} WHEN 10 THEN 'ACCEPTED' WHEN 20 THEN 'IN_TRANSIT' WHEN 30 THEN 'AT_HUB' WHEN 40 THEN 'OUT_FOR_DELIVERY' "
        "WHEN 45 THEN 'DELIVERED' WHEN 50 THEN 'DELIVERY_FAILED' WHEN 60 THEN 'RETURNED' WHEN 99 THEN 'LOST' END"
    )
    c = (
        f"CASE {K} % 10 WHEN 0 THEN 'ACCEPTED' WHEN 1 THEN 'IN_TRANSIT' WHEN 2 THEN 'OUT_FOR_DELIVERY' WHEN 3 THEN 'DELIVERED' "
        "WHEN 4 THEN 'DELIVERY_FAILED' WHEN 5 THEN 'RETURNED' WHEN 9 THEN 'LOST' END"
    )
    return f"""
SELECT event_id, {b} AS b_status, {c} AS c_status,
       CAST({K} AS VARCHAR) || ':' || CASE WHEN event_type = 'error' THEN 'None' ELSE event_type END AS raw_status_b,
       (event_id % 3 = 1 AND {b} IS NOT NULL) AS known
FROM events"""


def o_weight_poly() -> str:
    return f"""
SELECT event_id,
       CASE WHEN event_id % 40 = 0 THEN NULL WHEN event_id % 5 = 0 THEN CAST({K} AS DOUBLE)
            WHEN event_id % 5 = 1 THEN CAST({K} AS DOUBLE) + 0.5 END AS weight_kg,
       CAST({K} * 10 AS DOUBLE) / 1000.0 AS kg_from_grams
FROM events"""


def _feeds_expected() -> str:
    """Expected normalised rows of the three carrier thirds of ``events``."""
    a_reason = (
        "CASE WHEN event_id % 29 = 0 THEN 'missing_tracking_number' "
        "WHEN event_id % 31 = 0 THEN 'unrecognized_status:UNKNOWN_' || upper(event_type) "
        f"WHEN event_id % 37 = 0 THEN 'unparseable_event_time:bad-' || {ISO} END"
    )
    b_reason = (
        "CASE WHEN event_id % 29 = 0 THEN 'missing_tracking_number' "
        "WHEN event_id % 31 = 0 THEN 'unrecognized_status_code:77' "
        "WHEN event_id % 37 = 0 THEN 'unparseable_event_time:bad' END"
    )
    c_reason = (
        "CASE WHEN event_id % 29 = 0 THEN 'missing_tracking_number' "
        "WHEN event_id % 31 = 0 THEN 'unrecognized_status_code:7' "
        "WHEN event_id % 37 = 0 THEN 'unparseable_event_time:999999999999999999' END"
    )
    c_status = "CASE event_type WHEN 'signup' THEN 'ACCEPTED' WHEN 'purchase' THEN 'DELIVERED' WHEN 'view' THEN 'IN_TRANSIT' WHEN 'click' THEN 'DELIVERY_FAILED' ELSE 'LOST' END"
    c_code = an.C_CODE_OF_TYPE
    b_code = an.B_CODE_OF_TYPE
    tn = "'U' || CAST(user_id AS VARCHAR)"
    return f"""
SELECT 'carrier_a' AS carrier_code, 'a_' || {D.day('ts')} AS source_file, CAST(event_id + 1 AS INT) AS source_line_no,
       {a_reason} AS reason, {tn} AS tracking_number, {STATUS_OF_TYPE} AS status, ts AS event_time,
       round(value, {ROUND}) AS weight_kg, 'H' || CAST(event_id % 7 AS VARCHAR) AS facility_code, {STATUS_OF_TYPE} AS raw_status
FROM events WHERE event_id % 3 = 0
UNION ALL
SELECT 'carrier_b', 'b_' || {D.day('ts')}, CAST(event_id + 1 AS INT), {b_reason}, {tn}, {STATUS_OF_TYPE},
       date_trunc('second', ts), round(value * 1000.0 / 1000.0, {ROUND}), 'D' || CAST(event_id % 5 AS VARCHAR),
       CAST({b_code} AS VARCHAR) || ':' || CASE WHEN event_id % 4 = 0 THEN 'None' ELSE event_type END
FROM events WHERE event_id % 3 = 1
UNION ALL
SELECT 'carrier_c', 'c_' || {D.day('ts')}, CAST(event_id + 1 AS INT), {c_reason}, {tn}, {c_status},
       date_trunc('millisecond', ts), round(CAST({K} AS DOUBLE), {ROUND}), NULL, CAST({c_code} AS VARCHAR)
FROM events WHERE event_id % 3 = 2"""


def o_union_feeds() -> str:
    payload = ["tracking_number", "status", "event_time", "weight_kg", "facility_code", "raw_status"]
    cols = ", ".join(f"CASE WHEN reason IS NULL THEN {c} END AS {c}" for c in payload)
    return f"WITH f AS ({_feeds_expected()})\nSELECT carrier_code, source_file, source_line_no, reason, {cols} FROM f"


def _lifecycle_expected() -> str:
    missing = (
        "concat_ws(',', CASE WHEN event_id % 11 = 0 THEN 'event_id' END, CASE WHEN event_id % 13 = 0 THEN 'event_type' END, "
        "CASE WHEN event_id % 17 = 0 THEN 'parcel_id' END, CASE WHEN event_id % 19 = 0 THEN 'tracking_number' END, "
        "CASE WHEN event_id % 23 = 0 THEN 'organisation_id' END, CASE WHEN event_id % 43 = 0 THEN 'carrier_code' END)"
    )
    return f"""
SELECT 'p_' || {D.day('ts')} AS source_file, CAST(event_id + 1 AS INT) AS source_line_no, ts,
       CASE WHEN {missing} <> '' THEN 'missing_fields:' || {missing}
            WHEN event_id % 47 = 0 THEN 'unparseable_occurred_at:not-a-timestamp' END AS reason
FROM events"""


def o_validate_reason() -> str:
    return f"""
WITH e AS ({_lifecycle_expected()})
SELECT source_file, source_line_no, reason, CASE WHEN reason IS NULL THEN ts END AS occurred_at FROM e"""


def o_dedup_keep_first() -> str:
    return """
SELECT event_id, ts, user_id, event_type, value, props, hour FROM (
  SELECT *, date_trunc('hour', ts) AS hour,
         row_number() OVER (PARTITION BY user_id, event_type, date_trunc('hour', ts) ORDER BY event_id) AS rn
  FROM events) WHERE rn = 1"""


def o_dedup_id() -> str:
    return f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {", ".join(LINEITEM_ORDER)}) AS rn
  FROM lineitem) WHERE rn = 1"""


def _milestones_sql(scans: str) -> str:
    key = "carrier_code, tracking_number"
    return f"""
t AS ({scans}),
m AS (SELECT {key},
             min(event_time) FILTER (WHERE status = 'ACCEPTED') AS accepted_at,
             min(event_time) FILTER (WHERE status = 'DELIVERED') AS delivered_at
      FROM t GROUP BY {key}),
w AS (SELECT {key}, weight_kg FROM (
        SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY event_time DESC, source_file DESC, source_line_no DESC) AS rn
        FROM t WHERE weight_kg IS NOT NULL) WHERE rn = 1),
l AS (SELECT {key}, status AS latest_carrier_status, facility_code FROM (
        SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY event_time DESC, source_file, source_line_no) AS rn
        FROM t) WHERE rn = 1),
ms AS (SELECT m.carrier_code, m.tracking_number, m.accepted_at, m.delivered_at, w.weight_kg,
              l.latest_carrier_status, l.facility_code
       FROM m LEFT JOIN w ON m.carrier_code = w.carrier_code AND m.tracking_number = w.tracking_number
              LEFT JOIN l ON m.carrier_code = l.carrier_code AND m.tracking_number = l.tracking_number)"""


def o_milestones() -> str:
    return "WITH " + _milestones_sql(select_sql(an.event_scan_columns(D), "events")) + "\nSELECT * FROM ms"


def _parcels_sql(events: str) -> str:
    attrs = "tracking_number, organisation_id, carrier_code, service_level, destination_country, destination_postcode"
    return f"""
pe AS ({events}),
pf AS (SELECT parcel_id, {attrs} FROM (
         SELECT *, row_number() OVER (PARTITION BY parcel_id ORDER BY occurred_at, source_file, source_line_no) AS rn
         FROM pe) WHERE rn = 1),
pt AS (SELECT parcel_id,
              min(occurred_at) FILTER (WHERE event_type = 'parcel_created') AS created_at,
              min(occurred_at) FILTER (WHERE event_type = 'parcel_handed_over') AS handed_over_at
       FROM pe GROUP BY parcel_id),
parcels AS (SELECT pf.parcel_id, {", ".join("pf." + a for a in attrs.split(", "))}, pt.created_at, pt.handed_over_at
            FROM pf JOIN pt ON pf.parcel_id = pt.parcel_id)"""


def o_parcels() -> str:
    return "WITH " + _parcels_sql(select_sql(an.lineitem_lifecycle_columns(D), "lineitem")) + "\nSELECT * FROM parcels"


def _shipments_ctes() -> str:
    order_events = (
        select_sql(an.order_parcel_columns(D, "created"), an.ORDER_SOURCE)
        + "\nUNION ALL\n"
        + select_sql(an.order_parcel_columns(D, "handed"), an.ORDER_SOURCE, an.HANDED_OVER_FILTER)
    )
    return f"""
{_milestones_sql(select_sql(an.lineitem_scan_columns(D), "lineitem"))},
{_parcels_sql(order_events)},
car AS ({select_sql(an.carrier_columns(), "region")}),
sla AS (SELECT carrier_code, sla_hours FROM (
          SELECT *, row_number() OVER (PARTITION BY carrier_code ORDER BY source_line_no DESC) AS rn FROM car) WHERE rn = 1),
sj AS (SELECT p.*, ms.accepted_at, ms.delivered_at, ms.latest_carrier_status, ms.weight_kg, ms.facility_code, sla.sla_hours,
              CASE WHEN p.handed_over_at IS NOT NULL AND ms.delivered_at IS NOT NULL
                   THEN (epoch_us(ms.delivered_at) - epoch_us(p.handed_over_at)) / 1000000.0 / 3600 END AS transit_hours
       FROM parcels p
       LEFT JOIN ms ON p.carrier_code = ms.carrier_code AND p.tracking_number = ms.tracking_number
       LEFT JOIN sla ON p.carrier_code = sla.carrier_code),
shipments AS (
  SELECT parcel_id, tracking_number, organisation_id, carrier_code, service_level, destination_country,
         destination_postcode, created_at, handed_over_at, accepted_at, delivered_at, latest_carrier_status,
         weight_kg, facility_code, sla_hours, transit_hours, delivered_at IS NOT NULL AS is_delivered,
         transit_hours <= sla_hours AS is_on_time,
         coalesce(latest_carrier_status = 'LOST', false) AS is_lost,
         coalesce(latest_carrier_status = 'RETURNED', false) AS is_returned
  FROM sj)"""


def _with_shipments(body: str) -> str:
    return "WITH " + _shipments_ctes() + "\n" + body


def o_shipments() -> str:
    return _with_shipments("SELECT * FROM shipments")


def _rates_sql() -> str:
    return f"""
WITH l AS ({_lines_cte()}),
f AS ({_feeds_expected()}),
e AS ({_lifecycle_expected()}),
counts AS (
  SELECT 'bronze.carrier_a' AS "table", count(*) FILTER (WHERE {GOOD_A}) AS rows_loaded,
         count(*) FILTER (WHERE {BAD_A}) AS rows_quarantined FROM l
  UNION ALL
  SELECT 'silver.tracking_events',
         (SELECT count(*) FROM (SELECT DISTINCT carrier_code, tracking_number, status, event_time FROM f WHERE reason IS NULL)),
         count(*) FILTER (WHERE reason IS NOT NULL) FROM f
  UNION ALL
  SELECT 'silver.parcel_events', count(*) FILTER (WHERE reason IS NULL), count(*) FILTER (WHERE reason IS NOT NULL) FROM e),
rates AS (
  SELECT "table", rows_loaded, rows_quarantined,
         CASE WHEN rows_loaded + rows_quarantined = 0 THEN 0.0
              ELSE CAST(rows_quarantined AS DOUBLE) / CAST(rows_loaded + rows_quarantined AS DOUBLE) END AS rate
  FROM counts)"""


def o_quarantine_rate() -> str:
    return _rates_sql() + f'\nSELECT "table", rows_loaded, rows_quarantined, round(rate, {ROUND}) AS rate FROM rates'


def o_gate_breach() -> str:
    return (
        _rates_sql()
        + """
SELECT "table", printf('%s: %d of %d rows rejected, %s', "table", rows_quarantined, rows_loaded + rows_quarantined,
       printf('%.1f%%', rate * 100.0)) AS detail
FROM rates WHERE rate > 0.05"""
    )


def o_gold_checks() -> str:
    contra = "is_delivered AND (coalesce(is_lost, false) OR coalesce(is_returned, false))"
    return _with_shipments(f"""
SELECT count(*) AS row_count, count(*) - count(DISTINCT parcel_id) AS duplicate_rows,
       count(*) FILTER (WHERE transit_hours < 0) AS negative_transit_rows,
       min(CASE WHEN transit_hours < 0 THEN parcel_id END) AS negative_transit_example,
       count(*) FILTER (WHERE {contra}) AS contradictory_rows,
       min(CASE WHEN {contra} THEN parcel_id END) AS contradictory_example,
       count(*) FILTER (WHERE created_at IS NULL) AS missing_created_rows,
       min(CASE WHEN created_at IS NULL THEN parcel_id END) AS missing_created_example
FROM shipments""")


def o_org_month_by_carrier() -> str:
    m = ORG_MONTH
    nxt = date(m.year + (m.month == 12), m.month % 12 + 1, 1)
    return _with_shipments(f"""
SELECT carrier_code, count(*) AS parcels FROM shipments
WHERE organisation_id = {ORG_ID} AND handed_over_at >= TIMESTAMP '{m.isoformat()} 00:00:00'
  AND handed_over_at < TIMESTAMP '{nxt.isoformat()} 00:00:00'
GROUP BY carrier_code""")


def o_worst_on_time() -> str:
    return _with_shipments(f"""
SELECT carrier_code, count(*) AS resolved_parcels, round(avg(CAST(is_on_time AS INT)), {ROUND}) AS on_time_rate
FROM shipments WHERE weight_kg > {HEAVY_KG} AND is_on_time IS NOT NULL GROUP BY carrier_code""")


_MONTH = "CAST(date_trunc('month', handed_over_at) AS DATE)"


def o_monthly_performance() -> str:
    return _with_shipments(f"""
SELECT {_MONTH} AS month, carrier_code, service_level, destination_country, count(*) AS parcels,
       count(is_on_time) AS resolved_parcels, round(avg(CAST(is_on_time AS INT)), {ROUND}) AS on_time_rate,
       round(avg(transit_hours), {ROUND}) AS mean_transit_hours
FROM shipments GROUP BY 1, 2, 3, 4""")


def o_loss_rates() -> str:
    return _with_shipments(f"""
SELECT {_MONTH} AS month, carrier_code, service_level, destination_country, count(*) AS parcels,
       round(avg(CAST(is_on_time AS INT)), {ROUND}) AS on_time_rate,
       round(avg(CAST(is_lost AS INT)), {ROUND}) AS lost_rate,
       round(avg(CAST(is_returned AS INT)), {ROUND}) AS returned_rate
FROM shipments GROUP BY 1, 2, 3, 4""")


def o_volume_vs_resolved() -> str:
    return _with_shipments(f"""
SELECT {_MONTH} AS month, carrier_code, count(*) AS parcels, count(is_on_time) AS resolved_parcels,
       count(*) - count(is_on_time) AS unresolved_parcels, round(avg(CAST(is_on_time AS INT)), {ROUND}) AS on_time_rate
FROM shipments GROUP BY 1, 2""")


def _with_views(sql: str) -> str:
    views = f"""
dim_carriers AS (SELECT carrier_code, carrier_name, sla_hours, ['NL'] AS countries_served FROM car),
dim_organisations AS ({select_sql(an.organisation_columns(), "nation")})"""
    return "WITH " + _shipments_ctes() + "," + views + "\n" + sql


def o_sql_capped() -> str:
    return _with_views(f"SELECT *, (SELECT count(*) FROM ({SQL_CAPPED})) > {SQL_CAP} AS truncated FROM ({SQL_CAPPED} LIMIT {SQL_CAP})")


def o_sql_verdicts() -> str:
    parts = []
    for k, (sql, columns) in enumerate(SQL_VERDICTS):
        if columns:
            text = ", ".join(f"CAST({c} AS VARCHAR)" for c in columns)
            parts.append(f"SELECT CAST({k} AS INTEGER) AS statement, true AS allowed, concat_ws('|', {text}) AS figures FROM ({sql})")
        else:
            parts.append(f"SELECT CAST({k} AS INTEGER), false, NULL")
    return _with_views(" UNION ALL ".join(parts))


def o_schema_document() -> str:
    kinds = (
        "parcel_id int, tracking_number string, organisation_id int, carrier_code string, service_level string, "
        "destination_country string, destination_postcode string, created_at timestamp_ntz, handed_over_at timestamp_ntz, "
        "accepted_at timestamp_ntz, delivered_at timestamp_ntz, latest_carrier_status string, weight_kg double, facility_code string, "
        "sla_hours int, transit_hours double, is_delivered boolean, is_on_time boolean, is_lost boolean, is_returned boolean"
    )
    plain = {"destination_country", "destination_postcode", "weight_kg"}
    parts = [
        f"SELECT {k} AS place, '{n}' AS \"column\", '{t}' AS type, {str(n not in plain).lower()} AS has_text, count({n}) AS n_values FROM shipments"
        for k, (n, t) in enumerate(x.split() for x in kinds.split(", "))
    ]
    return _with_shipments("\nUNION ALL ".join(parts))


ORACLES: dict[str, Callable[[], str]] = {
    "bronze_good": o_bronze_good,
    "bronze_quarantine": o_bronze_quarantine,
    "skip_ingested": o_skip_ingested,
    "line_numbers": o_line_numbers,
    "end_to_end_run": o_end_to_end_run,
    "reference_dims": o_reference_dims,
    "stream_bronze": o_stream_bronze,
    "partition_replace": o_partition_replace,
    "load_totals": o_load_totals,
    "raw_records": o_raw_records,
    "schema_evolution": o_schema_evolution,
    "incremental_after_failed_gate": o_end_to_end_run,
    "incremental_gold": o_end_to_end_run,
    "parse_iso": o_parse_iso,
    "parse_naive": o_parse_naive,
    "parse_millis": o_parse_millis,
    "status_map": o_status_map,
    "weight_poly": o_weight_poly,
    "union_feeds": o_union_feeds,
    "validate_reason": o_validate_reason,
    "dedup_keep_first": o_dedup_keep_first,
    "dedup_id": o_dedup_id,
    "milestones": o_milestones,
    "parcels": o_parcels,
    "shipments": o_shipments,
    "quarantine_rate": o_quarantine_rate,
    "gate_breach": o_gate_breach,
    "gold_checks": o_gold_checks,
    "org_month_by_carrier": o_org_month_by_carrier,
    "worst_on_time": o_worst_on_time,
    "monthly_performance": o_monthly_performance,
    "loss_rates": o_loss_rates,
    "volume_vs_resolved": o_volume_vs_resolved,
    "sql_capped": o_sql_capped,
    "sql_join": lambda: _with_views(SQL_JOIN),
    "sql_union": lambda: _with_views(SQL_UNION),
    "sql_verdicts": o_sql_verdicts,
    "schema_document": o_schema_document,
}


def oracle_sql() -> dict[str, str]:
    return {k: f() for k, f in ORACLES.items()} | _added()[1]
