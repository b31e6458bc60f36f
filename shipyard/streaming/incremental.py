"""Bronze as a Structured Streaming job.

The batch ingest finds new files by comparing the listing with the file names
already stored. Here the stream's checkpoint remembers which files were
processed instead. Each trigger takes the files that arrived since, and
``trigger(availableNow=True)`` processes everything present and then stops,
which gives a scheduled, incremental, exactly-once load. Each micro-batch goes
through the same line numbering, parsing and publishing as the batch job, the
ledger's entries included, so a micro-batch that fails changes nothing and is run again.

The stream's file log remembers paths, so a corrected file re-delivered under
the same name is not read again; reload such a file with the batch
``sources.bronze.ingest_paths`` (or ``ingest(..., force=True)``), which
replaces its rows the same way.

The data has no event-time state: silver and gold recompute from bronze, so
there is no watermark or stateful operator here.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shipyard.session import checkpoint_dir, prepare
from shipyard.sources.bronze import load_lines
from shipyard.sources.feeds import Feed
from shipyard.sources.raw_files import staged_with_numbers, tagged_lines
from shipyard.warehouse import Warehouse, literal_path


def raw_line_stream(spark: SparkSession, raw_dir: str, glob_pattern: str, max_files_per_trigger: int | None = None) -> DataFrame:
    # An escaped path counts as a pattern, for which Spark does not look for partition folders by itself.
    reader = spark.readStream.format("text").option("pathGlobFilter", glob_pattern).option("basePath", raw_dir)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return tagged_lines(reader.load(literal_path(raw_dir)))


def start_bronze_stream(
    spark: SparkSession,
    wh: Warehouse,
    feed: Feed,
    raw_dir: str,
    checkpoint_location: str | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the incremental bronze load of ``feed``; returns the running query."""
    prepare(spark)
    location = checkpoint_location or f"{checkpoint_dir(spark).rstrip('/')}/bronze_stream/{feed.name}"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        at = datetime.now(timezone.utc).replace(tzinfo=None)
        wh.recover(spark, feed.table)
        aside = wh.aside(feed.table)
        lines = staged_with_numbers(batch.withColumn("row", F.monotonically_increasing_id()), f"{aside}/lines")
        names = [r[0] for r in lines.select("source_file").distinct().collect()]  # files of this trigger
        load_lines(spark, wh, feed, lines, aside, names, at)

    writer = (
        raw_line_stream(spark, raw_dir, feed.glob, max_files_per_trigger)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", location)
        .queryName(f"bronze_{feed.name}")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
