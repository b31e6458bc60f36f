"""Keep-first de-duplication without a global sort.

``keep_first`` keeps, per key, the row with the smallest ordering tuple. It is
one aggregation: ``min_by(struct(row), struct(order))``. Spark combines rows
map-side before the shuffle, so a key that holds a third of all rows reaches
its reducer as one row per map task, not as a third of the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    payload = [c for c in df.columns if c not in keys]
    winners = df.groupBy(*keys).agg(
        F.min_by(F.struct(*payload), F.struct(*[F.col(c) for c in order_by])).alias("_first")
    )
    return winners.select(*keys, "_first.*").select(*df.columns)


def keep_last(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    payload = [c for c in df.columns if c not in keys]
    winners = df.groupBy(*keys).agg(
        F.max_by(F.struct(*payload), F.struct(*[F.col(c) for c in order_by])).alias("_last")
    )
    return winners.select(*keys, "_last.*").select(*df.columns)
