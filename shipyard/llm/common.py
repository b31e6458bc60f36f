"""Session set-up, shared scratch tables and Arrow batch handling of the operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from shipyard.session import checkpoint_dir

#: Text bytes a Python worker handles at once; numpy work arrays are a few dozen times that.
CHUNK_BYTES = 2 << 20
#: Bytes of an Arrow batch: documents can be long, so a number of rows alone bounds nothing.
BATCH_BYTES = "4m"


def ready(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, and this package on the Python path of the workers."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder, read back: cuts
    the lineage, survives lost executors, and has a known size."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.Table]:
    """The batches as tables of about ``limit`` bytes of text each; a longer text
    stands alone. Every row comes exactly once, in order."""
    held: list[pa.Table] = []
    size = 0
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        lengths = pc.fill_null(pc.binary_length(rows[column]), 0).to_pylist()
        begin = 0
        for i, n in enumerate(lengths):
            if size and size + n > limit:
                if i > begin:
                    held.append(rows.slice(begin, i - begin))
                yield pa.concat_tables(held)
                held, size, begin = [], 0, i
            size += n
        if len(lengths) > begin:
            held.append(rows.slice(begin))
    if held:
        yield pa.concat_tables(held)
