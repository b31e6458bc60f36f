"""Connected components by alternating large and small stars.

Every round is two grouped minima and two joins; the edges of a round go to a
table in the shared checkpoint folder, so lineage stays short and a lost executor
costs one round. Nothing but two numbers a round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipyard.llm.common import written


def _state(edges: DataFrame) -> tuple[int, int | None]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (``u``, ``v``: any ordered type) to (``node``, ``root``): every
    node of an edge with the smallest node that it reaches, roots included.
    Loops and repeated edges are harmless; no edges give no rows."""
    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        now = written(_small_star(_large_star(now)).where("u <> v").distinct(), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
