"""Session settings the library relies on, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job needs. Timestamps are UTC wall-clock values
# (TIMESTAMP_NTZ); parsing strings with offsets goes through the session zone,
# so the zone must be UTC.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Python's json module keeps the last of repeated keys; so does Spark's
    # variant parser with this switch on.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # HotSpot only interprets methods of more than 8,000 bytes; a line's parsing is
    # longer when fused. Beyond that Spark runs the operators one by one, compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Settings tuned for scale; applied when a session is built by this module.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "shipyard", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings jobs depend on to an existing session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment must set it to storage that all executors share;
    without it this raises, as a local folder would scatter the files over their
    disks. A local master (tests, one machine) gets a scratch folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not is_local_master(spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="shipyard-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    spark.sparkContext.setCheckpointDir(configured)
    return configured


def held(df: DataFrame) -> DataFrame:
    """``df`` computed now, as a table of its own in the checkpoint folder: like a
    checkpoint, but compressed, of a known size, and read by columns."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/held-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_local_master(master: str) -> bool:
    """Driver and executors in one process (not ``local-cluster[...]``)."""
    return master == "local" or master.startswith("local[")


def one_file_per_task(spark: SparkSession) -> SparkSession:
    """A copy of the session in which a file scan never splits a file and never
    puts two into one task, as line numbers need it. The catalog and all other
    settings are those of ``spark``."""
    copy = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        copy.conf.set(key, str(1 << 50))
    return copy


def few_scan_tasks(spark: SparkSession) -> SparkSession:
    """A copy of the session for scans that read no content: as many tasks as cores,
    however large the files are."""
    copy = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    copy.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 60))
    copy.conf.set("spark.sql.files.openCostInBytes", "1")
    return copy
