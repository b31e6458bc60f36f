"""The driver's test tables re-shaped as the library's inputs.

The test tables hold no parcel data, so each operator runs on a table of the
same shape built from them (whole tables, every row):

* ``events``   -> raw feed lines, carrier scans, lifecycle events
* ``lineitem`` -> carrier scans of a parcel (order), or lifecycle events
* ``orders`` + ``customer`` -> parcels; ``region`` -> carriers with an SLA;
  ``nation`` -> organisations

Input columns are built with SQL expressions that read the same in Spark and
DuckDB, except a few date and time helpers given per dialect. The Spark side
then runs the library's operators; the DuckDB oracle (``__spark_entry__``)
computes the expected result directly from the source columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from shipyard import schemas


@dataclass(frozen=True)
class Dialect:
    name: str

    def iso(self, ts: str) -> str:
        if self.name == "spark":
            return f"date_format({ts}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"
        return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f')"

    def iso_minutes(self, ts: str) -> str:
        if self.name == "spark":
            return f"date_format({ts}, \"yyyy-MM-dd'T'HH:mm\")"
        return f"strftime({ts}, '%Y-%m-%dT%H:%M')"

    def iso_date(self, ts: str) -> str:
        if self.name == "spark":
            return f"date_format({ts}, 'yyyy-MM-dd')"
        return f"strftime({ts}, '%Y-%m-%d')"

    def day(self, ts: str) -> str:
        if self.name == "spark":
            return f"date_format({ts}, 'yyyyMMdd')"
        return f"strftime({ts}, '%Y%m%d')"

    def naive(self, ts: str, unpadded: bool = False, sep: str = " ") -> str:
        if self.name == "spark":
            fmt = "yyyy-M-d" + sep + "H:m:s" if unpadded else "yyyy-MM-dd" + sep + "HH:mm:ss"
            return f"date_format({ts}, '{fmt}')"
        fmt = "%Y-%-m-%-d" + sep + "%-H:%-M:%-S" if unpadded else "%Y-%m-%d" + sep + "%H:%M:%S"
        return f"strftime({ts}, '{fmt}')"

    def millis(self, ts: str) -> str:
        if self.name == "spark":
            return f"unix_millis(cast({ts} AS timestamp))"
        return f"epoch_ms({ts})"

    def add_minutes(self, ts: str, n: str) -> str:
        if self.name == "spark":
            return f"timestampadd(MINUTE, {n}, {ts})"
        return f"({ts} + to_minutes(CAST({n} AS BIGINT)))"

    def trunc(self, unit: str, ts: str) -> str:
        if self.name == "spark":
            return f"CAST(date_trunc('{unit}', {ts}) AS timestamp_ntz)"
        return f"date_trunc('{unit.lower()}', {ts})"


SPARK = Dialect("spark")
DUCK = Dialect("duckdb")

K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"
STATUS_OF_TYPE = (
    "CASE event_type WHEN 'signup' THEN 'ACCEPTED' WHEN 'purchase' THEN 'DELIVERED' "
    "WHEN 'view' THEN 'IN_TRANSIT' WHEN 'click' THEN 'AT_HUB' ELSE 'LOST' END"
)
B_CODE_OF_TYPE = "CASE event_type WHEN 'signup' THEN 10 WHEN 'purchase' THEN 45 WHEN 'view' THEN 20 WHEN 'click' THEN 30 ELSE 99 END"
C_CODE_OF_TYPE = "CASE event_type WHEN 'signup' THEN 0 WHEN 'purchase' THEN 3 WHEN 'view' THEN 1 WHEN 'click' THEN 4 ELSE 9 END"


# Lineage file name of a lineitem-derived row: every column the derived
# payloads read, so rows that tie on (time, file, line) carry equal payloads.
LINEITEM_FILE = (
    "'li_' || lpad(CAST(l_partkey AS STRING), 8, '0') || '_' || l_returnflag || l_linestatus "
    "|| '_' || lpad(CAST(CAST(l_quantity AS INT) AS STRING), 3, '0')"
)


def select_sql(cols: list[tuple[str, str]], source: str, where: str | None = None) -> str:
    body = ",\n       ".join(f"{expr} AS {name}" for name, expr in cols)
    return f"SELECT {body}\nFROM {source}" + (f"\nWHERE {where}" if where else "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def project(df: DataFrame, cols: list[tuple[str, str]]) -> DataFrame:
    return df.selectExpr(*[f"{expr} AS {name}" for name, expr in cols])


# ------------------------------------------------------------ raw feed lines
def feed_a_line_columns(d: Dialect) -> list[tuple[str, str]]:
    """Carrier-A JSON lines from ``events``; some are cut short (invalid), blank,
    wrapped in an array (not an object) or carry a text weight (type mismatch)."""
    iso = d.iso("ts")
    core = (
        "'{\"tracking_no\": \"' || CAST(user_id AS STRING) || '\", \"status\": \"' || upper(event_type) || "
        f"'\", \"ts\": \"' || {iso} || 'Z\", \"weight_kg\": ' || "
        f"CASE WHEN event_id % 71 = 0 THEN '\"' || CAST({K} AS STRING) || '\"' ELSE CAST({K} AS STRING) || '.25' END || "
        "', \"hub\": \"H' || CAST(event_id % 7 AS STRING) || "
        f"'\", \"_ingested_at\": \"' || {iso} || 'Z\"}}'"
    )
    wrap = "(event_id % 61 = 0 AND event_id % 50 <> 0)"
    line = (
        "CASE WHEN event_id % 97 = 0 AND event_id % 50 <> 0 THEN '   ' "
        f"ELSE CASE WHEN {wrap} THEN '[' ELSE '' END "
        f"|| CASE WHEN event_id % 50 = 0 THEN substring({core}, 1, 30) ELSE {core} END "
        f"|| CASE WHEN {wrap} THEN ']' ELSE '' END END"
    )
    return [
        ("event_id", "event_id"),
        ("source_file", f"'carrier_a_' || {d.day('ts')} || '.json.gz'"),
        ("source_line_no", "CAST(event_id + 1 AS INT)"),
        ("line", line),
    ]


def feed_a_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    # As in the ingest: AQE sizes the parse by file from the actual volume.
    return project(table(spark, sf_dir, "events"), feed_a_line_columns(SPARK)).hint("rebalance", "source_file")


# ------------------------------------------------------- carrier feed shapes
def _tn(prefix_null: bool) -> str:
    missing = "NULL" if prefix_null else "''"
    return f"CASE WHEN event_id % 29 = 0 THEN {missing} ELSE 'U' || CAST(user_id AS STRING) END"


def carrier_a_rows(d: Dialect) -> list[tuple[str, str]]:
    iso = d.iso("ts")
    return [
        ("tracking_no", _tn(prefix_null=False)),
        ("status", f"CASE WHEN event_id % 31 = 0 THEN 'UNKNOWN_' || upper(event_type) ELSE {STATUS_OF_TYPE} END"),
        ("ts", f"CASE WHEN event_id % 37 = 0 THEN 'bad-' || {iso} ELSE {iso} || 'Z' END"),
        ("weight_kg", "value"),
        ("hub", "'H' || CAST(event_id % 7 AS STRING)"),
        ("source_ingested_at", "'x'"),
        ("source_file", f"'a_' || {d.day('ts')}"),
        ("source_line_no", "CAST(event_id + 1 AS INT)"),
    ]


def carrier_b_rows(d: Dialect) -> list[tuple[str, str]]:
    return [
        ("barcode", _tn(prefix_null=True)),
        ("code", f"CAST(CASE WHEN event_id % 31 = 0 THEN 77 ELSE {B_CODE_OF_TYPE} END AS INT)"),
        ("descr", "CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_type END"),
        ("event_time", f"CASE WHEN event_id % 37 = 0 THEN 'bad' ELSE {d.naive('ts')} END"),
        ("weight_g", "value * 1000.0"),
        ("depot", "'D' || CAST(event_id % 5 AS STRING)"),
        ("source_ingested_at", "'x'"),
        ("source_file", f"'b_' || {d.day('ts')}"),
        ("source_line_no", "CAST(event_id + 1 AS INT)"),
    ]


def carrier_c_rows(d: Dialect) -> list[tuple[str, str]]:
    return [
        ("ref", _tn(prefix_null=True)),
        ("st", f"CAST(CASE WHEN event_id % 31 = 0 THEN 7 ELSE {C_CODE_OF_TYPE} END AS INT)"),
        ("t", f"CASE WHEN event_id % 37 = 0 THEN CAST(999999999999999999 AS BIGINT) ELSE {d.millis('ts')} END"),
        (
            "dims",
            f"CASE WHEN event_id % 2 = 0 THEN '{{\"weight\": ' || CAST({K} AS STRING) || '}}' "
            f"ELSE '{{\"weight\": {{\"v\": ' || CAST({K} AS STRING) || ', \"u\": \"kg\"}}}}' END",
        ),
        ("source_ingested_at", "'x'"),
        ("source_file", f"'c_' || {d.day('ts')}"),
        ("source_line_no", "CAST(event_id + 1 AS INT)"),
    ]


def carrier_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Three bronze-shaped carrier tables from the three thirds of ``events``."""
    ev = table(spark, sf_dir, "events")
    a = project(ev.where("event_id % 3 = 0"), carrier_a_rows(SPARK))
    b = project(ev.where("event_id % 3 = 1"), carrier_b_rows(SPARK)).selectExpr(
        "barcode", "named_struct('code', code, 'desc', descr) AS event", "event_time", "weight_g", "depot",
        "source_ingested_at", "source_file", "source_line_no",
    )
    c = project(ev.where("event_id % 3 = 2"), carrier_c_rows(SPARK))
    return {k: rows.hint("rebalance", "source_file") for k, rows in (("carrier_a", a), ("carrier_b", b), ("carrier_c", c))}


# ------------------------------------------------------------ lifecycle rows
def lifecycle_columns(d: Dialect) -> list[tuple[str, str]]:
    return [
        ("event_id", "CASE WHEN event_id % 11 = 0 THEN NULL ELSE 'ev-' || CAST(event_id AS STRING) END"),
        ("event_type", "CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_type END"),
        ("parcel_id", "CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(user_id AS INT) END"),
        (
            "tracking_number",
            "CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 7 = 0 THEN '' ELSE 'U' || CAST(user_id AS STRING) END",
        ),
        ("organisation_id", "CASE WHEN event_id % 23 = 0 THEN NULL ELSE CAST(user_id % 10 AS INT) END"),
        ("carrier_code", "CASE WHEN event_id % 43 = 0 THEN NULL ELSE 'carrier_' || CAST(event_id % 3 AS STRING) END"),
        ("service_level", "event_type"),
        ("destination_country", "'NL'"),
        ("destination_postcode", "CAST(NULL AS STRING)"),
        ("recipient_email", "'u' || CAST(user_id AS STRING) || '@example.com'"),
        ("occurred_at", f"CASE WHEN event_id % 47 = 0 THEN 'not-a-timestamp' ELSE {d.iso('ts')} || 'Z' END"),
        ("source_ingested_at", "'x'"),
        ("source_file", f"'p_' || {d.day('ts')}"),
        ("source_line_no", "CAST(event_id + 1 AS INT)"),
    ]


def lifecycle_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(table(spark, sf_dir, "events"), lifecycle_columns(SPARK)).hint("rebalance", "source_file")


# ---------------------------------------------------- silver-shaped analogues
def event_scan_columns(d: Dialect) -> list[tuple[str, str]]:
    """``events`` as carrier scans: one tracking number per user."""
    return [
        ("tracking_number", "CAST(user_id AS STRING)"),
        ("carrier_code", "'c' || CAST(user_id % 2 AS STRING)"),
        ("status", STATUS_OF_TYPE),
        ("event_time", d.trunc("HOUR", "ts")),
        ("weight_kg", "CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END"),
        ("facility_code", "CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'F' || CAST(event_id % 9 AS STRING) END"),
        ("raw_status", "event_type"),
        ("source_file", f"'ev_' || {d.day('ts')}"),
        ("source_line_no", "CAST(event_id + 1 AS INT)"),
    ]


def lineitem_scan_columns(d: Dialect) -> list[tuple[str, str]]:
    """``lineitem`` as carrier scans of the parcel (order) ``l_orderkey``."""
    status = (
        "CASE WHEN l_linenumber = 1 THEN 'ACCEPTED' WHEN l_returnflag = 'A' THEN 'DELIVERED' "
        "WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'RETURNED' WHEN l_returnflag = 'R' THEN 'LOST' "
        "ELSE 'IN_TRANSIT' END"
    )
    return [
        ("tracking_number", "CAST(l_orderkey AS STRING)"),
        ("carrier_code", "'carrier_' || CAST(l_orderkey % 6 AS STRING)"),
        ("status", status),
        ("event_time", d.add_minutes("l_shipdate", "l_linenumber * 60")),
        ("weight_kg", "CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE l_quantity END"),
        ("facility_code", "CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE 'F' || CAST(l_suppkey AS STRING) END"),
        ("raw_status", "l_returnflag"),
        ("source_file", LINEITEM_FILE),
        ("source_line_no", "CAST(l_suppkey * 1000 + l_linenumber AS INT)"),
    ]


def lineitem_lifecycle_columns(d: Dialect) -> list[tuple[str, str]]:
    """``lineitem`` as lifecycle events of parcel ``l_orderkey``."""
    return [
        ("event_id", "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING)"),
        ("event_type", "CASE l_linestatus WHEN 'F' THEN 'parcel_created' ELSE 'parcel_handed_over' END"),
        ("parcel_id", "CAST(l_orderkey AS INT)"),
        ("tracking_number", "'T' || CAST(l_partkey AS STRING)"),
        ("organisation_id", "CAST(l_suppkey AS INT)"),
        ("carrier_code", "'carrier_' || l_returnflag"),
        ("service_level", "l_linestatus"),
        ("destination_country", "'N' || CAST(l_linenumber AS STRING)"),
        ("destination_postcode", "'P' || CAST(l_suppkey AS STRING)"),
        ("occurred_at", "l_shipdate"),
        ("source_file", LINEITEM_FILE),
        ("source_line_no", "CAST(l_suppkey * 1000 + l_linenumber AS INT)"),
    ]


def order_parcel_columns(d: Dialect, kind: str) -> list[tuple[str, str]]:
    """``orders`` joined to ``customer`` as two lifecycle events per parcel:
    created at the order date, handed over 6 hours later (not for every 8th)."""
    created = kind == "created"
    return [
        ("event_id", ("'c-'" if created else "'h-'") + " || CAST(o_orderkey AS STRING)"),
        ("event_type", "'parcel_created'" if created else "'parcel_handed_over'"),
        ("parcel_id", "CAST(o_orderkey AS INT)"),
        ("tracking_number", "CAST(o_orderkey AS STRING)"),
        ("organisation_id", "CAST(c_nationkey AS INT)"),
        ("carrier_code", "'carrier_' || CAST(o_orderkey % 6 AS STRING)"),
        ("service_level", "o_orderpriority"),
        ("destination_country", "c_mktsegment"),
        ("destination_postcode", "o_orderstatus"),
        ("occurred_at", "o_orderdate" if created else d.add_minutes("o_orderdate", "360")),
        ("source_file", "'orders_created'" if created else "'orders_handed_over'"),
        ("source_line_no", "CAST(o_orderkey + 1 AS INT)"),
    ]


ORDER_SOURCE = "orders JOIN customer ON o_custkey = c_custkey"
HANDED_OVER_FILTER = "o_orderkey % 8 <> 0"


def carrier_columns() -> list[tuple[str, str]]:
    """``region`` as the carriers reference: SLA 2400 hours per region step."""
    return [
        ("carrier_code", "'carrier_' || CAST(r_regionkey AS STRING)"),
        ("carrier_name", "r_name"),
        ("sla_hours", "CAST((r_regionkey + 1) * 2400 AS INT)"),
        ("source_line_no", "CAST(r_regionkey + 1 AS INT)"),
    ]


def organisation_columns() -> list[tuple[str, str]]:
    return [
        ("organisation_id", "CAST(n_nationkey AS INT)"),
        ("name", "n_name"),
        ("country", "'R' || CAST(n_regionkey AS STRING)"),
    ]


def event_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(table(spark, sf_dir, "events"), event_scan_columns(SPARK))


def lineitem_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(table(spark, sf_dir, "lineitem"), lineitem_scan_columns(SPARK))


def lineitem_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(table(spark, sf_dir, "lineitem"), lineitem_lifecycle_columns(SPARK))


def order_parcel_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both lifecycle events of each order from one scan and one join: the
    order row is exploded into its created / handed-over events."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    joined = orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
    created = dict(order_parcel_columns(SPARK, "created"))
    handed = dict(order_parcel_columns(SPARK, "handed"))
    varying = ["event_id", "event_type", "occurred_at", "source_file"]

    def event(cols: dict[str, str]) -> str:
        return "named_struct(" + ", ".join(f"'{k}', {cols[k]}" for k in varying) + ")"

    both = f"CASE WHEN {HANDED_OVER_FILTER} THEN array({event(created)}, {event(handed)}) ELSE array({event(created)}) END"
    names = [n for n, _ in order_parcel_columns(SPARK, "created")]
    return joined.selectExpr(f"explode({both}) AS _e", *[f"{created[n]} AS {n}" for n in names if n not in varying]).select(
        *[f"_e.{n}" if n in varying else n for n in names]
    )


def carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carrier dimension with line numbers (``gold.dim_carriers`` stored shape)."""
    base = project(table(spark, sf_dir, "region"), carrier_columns())
    return base.selectExpr(
        "carrier_code", "carrier_name", "sla_hours", "array('NL') AS countries_served", "source_line_no"
    )


def organisations(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = project(table(spark, sf_dir, "nation"), organisation_columns())
    return base.selectExpr(
        "organisation_id", "name", "country", "CAST(NULL AS STRING) AS plan", "CAST(NULL AS timestamp_ntz) AS created_at"
    ).select(*schemas.DIM_ORGANISATIONS.names)


# ------------------------------------------------------- raw files, end to end
CARRIER_OF_KEY = "CASE {k} % 3 WHEN 0 THEN 'carrier_a' WHEN 1 THEN 'carrier_b' ELSE 'carrier_c' END"


def write_named_files(lines: DataFrame, folder: str) -> None:
    """``lines`` (``name``, ``place``, ``line``) as one gzip file per name, its
    lines by place: a folder per name as Spark writes it, then one rename each."""
    spark = lines.sparkSession
    staged = f"{folder.rstrip('/')}/_staged"
    ordered = lines.repartition("name").sortWithinPartitions("name", "place")
    ordered.selectExpr("name", "line AS value").write.partitionBy("name").text(staged, compression="gzip")
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(staged)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for part in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{staged}/name=*/*.gz")):
        name = part.getPath().getParent().getName().split("=", 1)[1]
        fs.rename(part.getPath(), jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{name}"))


def copy_file(spark: SparkSession, source: str, target: str, share: float = 1.0) -> None:
    """The first ``share`` of the bytes of a file, as another file."""
    jvm = spark.sparkContext._jvm
    old, new = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    fs = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(new.getParent())
    size = int(fs.getFileStatus(old).getLen() * share)
    reader, writer = fs.open(old), fs.create(new)
    jvm.org.apache.commons.io.IOUtils.copyLarge(reader, writer, 0, size)
    writer.close()
    reader.close()


def write_raw_feeds(
    spark: SparkSession, sf_dir: str, out_root: str, orders_where: str = "true", noise: str = "false", reference: bool = True,
    scans_where: str = "true", life: bool = True,
) -> None:
    """Write the four raw feeds (gzipped JSON lines) and the two reference
    files derived from the test tables, for a file-based end-to-end run.

    Orders are parcels (carrier by order key), created within one half-year
    (parcel data spans months, not the seven years of the order dates).
    Lineitems are their carrier scans after hand-over: line 1 ACCEPTED, later
    lines IN_TRANSIT, the last line terminal (DELIVERED, or LOST / RETURNED
    for some orders), one hour per line number. Scan contents depend only on
    (order, line number), so repeated lineitem rows become webhook retries and
    the result does not depend on how rows fall into files. Scans for which
    ``E2E_BROKEN`` holds are cut short and so are lost to quarantine; too few
    for a gate. Where ``noise`` holds, a scan is followed by a line of garbage.
    ``orders_where`` picks the orders that this delivery holds, ``scans_where`` the
    scans of these, and ``life`` says whether it has lifecycle events. The number of
    files follows the amount of data; they are Spark's part files
    (``*.txt.gz``), added to what the folders hold.
    """
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    orders = table(spark, sf_dir, "orders").where(orders_where).withColumn("created", F.expr(E2E_CREATED))
    customer = table(spark, sf_dir, "customer")
    lineitem = table(spark, sf_dir, "lineitem")
    root = out_root.rstrip("/")

    parcels = orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).selectExpr(
        "o_orderkey", "created", "c_nationkey", "c_mktsegment", "o_orderpriority",
        f"{CARRIER_OF_KEY.format(k='o_orderkey')} AS carrier_code",
    )
    lifecycle = parcels.selectExpr(
        "explode(array(named_struct('t', 'parcel_created', 'at', created), "
        "named_struct('t', 'parcel_handed_over', 'at', timestampadd(MINUTE, 360, created)))) AS e",
        "o_orderkey", "c_nationkey", "c_mktsegment", "o_orderpriority", "carrier_code",
    ).selectExpr(
        "to_json(named_struct("
        "'event_id', e.t || '-' || CAST(o_orderkey AS STRING), 'event_type', e.t, 'parcel_id', CAST(o_orderkey AS INT), "
        "'tracking_number', 'T' || CAST(o_orderkey AS STRING), 'organisation_id', c_nationkey, 'carrier_code', carrier_code, "
        "'service_level', o_orderpriority, 'destination_country', c_mktsegment, 'destination_postcode', CAST(NULL AS STRING), "
        "'recipient_email', 'p' || CAST(o_orderkey AS STRING) || '@example.com', "
        f"'occurred_at', {SPARK.iso('e.at')} || 'Z', '_ingested_at', {SPARK.iso('e.at')} || 'Z')) AS value"
    )

    last = Window.partitionBy("l_orderkey")
    scans = (
        lineitem.join(orders.select("o_orderkey", "created"), lineitem["l_orderkey"] == orders["o_orderkey"])
        .withColumn("last_line", F.max("l_linenumber").over(last))
        .selectExpr(
            "l_linenumber", f"{CARRIER_OF_KEY.format(k='l_orderkey')} AS carrier_code",
            "'T' || CAST(l_orderkey AS STRING) AS tn", f"{E2E_STATUS} AS status", f"{E2E_SCAN_TIME} AS at",
            f"{E2E_WEIGHT} AS weight", f"{E2E_BROKEN} AS broken", f"{noise} AS noise", f"{scans_where} AS wanted",
        )
        .where("wanted")
    )

    def lines(feed: DataFrame) -> DataFrame:
        """Broken scans lose their second half; noise adds a line."""
        cut = "CASE WHEN broken THEN substring(value, 1, length(value) div 2) ELSE value END"
        return feed.selectExpr(f"explode(CASE WHEN noise THEN array({cut}, '{{garbage') ELSE array({cut}) END) AS value")

    a = scans.where("carrier_code = 'carrier_a'").selectExpr(
        "to_json(named_struct('tracking_no', tn, 'status', status, "
        f"'ts', {SPARK.iso('at')} || 'Z', 'weight_kg', weight, 'hub', 'H' || CAST(l_linenumber AS STRING), '_ingested_at', 'x')) AS value", "broken", "noise"
    )
    b_code = "CASE status WHEN 'ACCEPTED' THEN 10 WHEN 'IN_TRANSIT' THEN 20 WHEN 'DELIVERED' THEN 45 WHEN 'RETURNED' THEN 60 ELSE 99 END"
    b = scans.where("carrier_code = 'carrier_b'").selectExpr(
        f"to_json(named_struct('barcode', tn, 'event', named_struct('code', {b_code}, 'desc', lower(status)), "
        f"'event_time', {SPARK.naive('at')}, 'weight_g', weight * 1000, 'depot', 'D' || CAST(l_linenumber AS STRING), "
        "'_ingested_at', 'x')) AS value", "broken", "noise",
    )
    c_code = "CASE status WHEN 'ACCEPTED' THEN 0 WHEN 'IN_TRANSIT' THEN 1 WHEN 'DELIVERED' THEN 3 WHEN 'RETURNED' THEN 5 ELSE 9 END"
    c_head = f"to_json(named_struct('ref', tn, 'st', {c_code}, 't', {SPARK.millis('at')}, '_ingested_at', 'x'))"
    dims = (
        "CASE WHEN l_linenumber % 2 = 0 THEN '{\"weight\": ' || CAST(weight AS STRING) || '}' "
        "ELSE '{\"weight\": {\"v\": ' || CAST(weight AS STRING) || ', \"u\": \"kg\"}}' END"
    )
    c = scans.where("carrier_code = 'carrier_c'").selectExpr(
        f"substring({c_head}, 1, length({c_head}) - 1) || ', \"dims\": ' || {dims} || '}}' AS value", "broken", "noise"
    )
    from concurrent.futures import ThreadPoolExecutor

    def write_feed(item):
        name, df = item
        df.hint("rebalance").write.mode("append").text(f"{root}/{name}", compression="gzip")

    with ThreadPoolExecutor(max_workers=4) as pool:
        feeds = [("carrier_a", lines(a)), ("carrier_b", lines(b)), ("carrier_c", lines(c)), *([("parcel_events", lifecycle)] if life else [])]
        list(pool.map(write_feed, feeds))

    if reference:
        # One ordered file: where a carrier occurs again, its last line counts.
        table(spark, sf_dir, "region").orderBy("r_regionkey").selectExpr(
            f"{E2E_CARRIER_OF_REGION} AS carrier_code", "r_name AS carrier_name", f"{E2E_SLA} AS sla_hours",
            "array('NL', 'DE') AS countries_served",
        ).coalesce(1).write.mode("overwrite").json(f"{root}/reference/carriers")
        table(spark, sf_dir, "nation").selectExpr(
            "CAST(n_nationkey AS INT) AS organisation_id", "n_name AS name", "'NL' AS country", "'growth' AS plan",
        ).write.mode("overwrite").json(f"{root}/reference/organisations")


# Fixed shapes of the end-to-end feeds (also read by the oracle).
E2E_CREATED = (
    "timestampadd(MINUTE, CAST(o_orderkey % 1440 AS INT), "
    "timestampadd(DAY, CAST(o_orderkey % 182 AS INT), TIMESTAMP '2026-01-01 00:00:00'))"
)
E2E_STATUS = (
    "CASE WHEN l_linenumber = 1 THEN 'ACCEPTED' WHEN l_linenumber < last_line THEN 'IN_TRANSIT' "
    "WHEN l_orderkey % 50 = 0 THEN 'LOST' WHEN l_orderkey % 70 = 0 THEN 'RETURNED' ELSE 'DELIVERED' END"
)
E2E_SCAN_TIME = "timestampadd(MINUTE, 360 + 60 * l_linenumber, created)"
E2E_WEIGHT = "CAST(l_orderkey % 40 AS DOUBLE) + l_linenumber / 4.0"
E2E_BROKEN = "((l_orderkey * 7 + l_linenumber) % 61 = 0)"
E2E_CARRIER_OF_REGION = "CASE r_regionkey % 3 WHEN 0 THEN 'carrier_a' WHEN 1 THEN 'carrier_b' ELSE 'carrier_c' END"
E2E_SLA = "CAST(r_regionkey + 3 AS INT)"
