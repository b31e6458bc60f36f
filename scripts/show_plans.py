"""Print the physical plans of the production jobs over file-based feeds.

Usage: python scripts/show_plans.py [sf_dir] [--no-broadcast]
Writes raw feeds derived from the test tables to a scratch folder under the
session's checkpoint dir, loads bronze once, then prints the operator trees of
the bronze ingest, both silver builds, the shipments build and the gates.
With --no-broadcast, automatic broadcast is off, as it would be for tables far
larger than the broadcast threshold.
"""

import dataclasses
import io
import os
import sys
import uuid
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from shipyard import analogues  # noqa: E402
from shipyard.operators.quality import rates_of_counts, shipment_checks  # noqa: E402
from shipyard.plans import gates, gold, silver  # noqa: E402
from shipyard.session import build_session, checkpoint_dir  # noqa: E402
from shipyard.sources import bronze  # noqa: E402
from shipyard.sources.feeds import FEEDS  # noqa: E402
from shipyard.sources.raw_files import list_raw_files, stage_lines  # noqa: E402
from shipyard.warehouse import Warehouse, fixed_time  # noqa: E402


def tree(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    return text.split("\n\n\n")[0]


def main():
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf = args[0] if args else "/root/testdata/sf0.1"
    extra = {"spark.sql.shuffle.partitions": "16"}
    if "--no-broadcast" in sys.argv:
        extra["spark.sql.autoBroadcastJoinThreshold"] = "-1"
        extra["spark.sql.adaptive.autoBroadcastJoinThreshold"] = "-1"
    spark = build_session("local[8]", "plans", extra)
    spark.sparkContext.setLogLevel("ERROR")
    scratch = f"{checkpoint_dir(spark).rstrip('/')}/plans-{uuid.uuid4().hex}"
    raw = f"{scratch}/raw"
    analogues.write_raw_feeds(spark, sf, raw)
    feeds = [dataclasses.replace(f, glob="*.txt.gz") for f in FEEDS]
    wh = Warehouse(f"{scratch}/wh")
    from datetime import datetime

    a = feeds[0]
    paths = list_raw_files(spark, f"{raw}/{a.name}", a.glob)
    print("### bronze ingest (carrier_a): number, parse the staged lines\n")
    print(tree(bronze.parse_feed_lines(stage_lines(spark, paths, f"{scratch}/lines"), a, fixed_time(datetime(2026, 1, 1)))))
    for f in feeds:
        bronze.ingest(spark, wh, f, f"{raw}/{f.name}")
    print("\n### bronze gate\n")
    print(tree(rates_of_counts(gates.bronze_counts(spark, wh), [f.table for f in FEEDS])))
    feeds_df = {c: bronze.table(spark, wh, dataclasses.replace(FEEDS[i], glob="*")) for i, c in enumerate(["carrier_a", "carrier_b", "carrier_c"])}
    norm = silver.normalized_tracking(feeds_df)
    print("\n### silver tracking_events (good side, as written)\n")
    good = silver.tracking_good(norm).withColumn("event_day", F.to_date("event_time")).hint("rebalance", "event_day")
    print(tree(good))
    silver.build_tracking_events(spark, wh)
    silver.build_parcel_events(spark, wh)
    refs = {"carriers": (f"{raw}/reference/carriers", "*.json"), "organisations": (f"{raw}/reference/organisations", "*.json")}
    gold.build_dimensions(spark, wh, raw, refs)
    print("\n### gold shipments\n")
    frame = gold.shipments_frame(
        silver.tracking_events(spark, wh), silver.parcel_events(spark, wh), wh.read(spark, gold.CARRIERS_TABLE, gold.CARRIERS_STORED)
    )
    print(tree(frame))
    gold.build_shipments(spark, wh)
    print("\n### gold gate\n")
    print(tree(shipment_checks(gold.shipments(spark, wh))))


if __name__ == "__main__":
    main()
