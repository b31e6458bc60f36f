"""Mixing sources to target weights by hierarchical budgeting.

A token budget goes down a tree of domain, language and source. Each node gets
its share of its parent's budget by weight; a node that has less (its tokens times
the number of epochs, where no node of weight 0 lies in between) takes what it has,
and what it leaves is shared among its siblings first. Only a parent that cannot spend its budget in all its children
leaves something to its own siblings. At a leaf, every full epoch takes all
documents once; the last epoch takes the documents in an order seeded by the
epoch, the longest prefix within the rest of the budget. Budgets are whole
numbers: shares are rounded down, so a few tokens can stay unspent.

The tree has one row per leaf and is all that windows see. Where an order must be
cut, hash buckets of a leaf are summed first, and only the documents of the bucket
in which the budget ends are ordered: a source with a third of all rows is never
sorted in one task. Documents learn one cut per leaf; their text is not shuffled.

Only built-in functions, no Python. Null levels are leaves of their own with the
default weight; a null text has no tokens; null ids are ordered last; documents
equal in id and text are taken or left together; an empty table, or a budget of
0, gives an empty table, and so does a tree without weight.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shipyard.llm.common import written

#: Buckets of a leaf's order, by the first hexadecimal digits of its hash.
BUCKET_DIGITS = 3
LEVELS = ("domain", "language", "source")


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, 0 for null."""
    return F.coalesce(F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda x: x != "")), F.lit(0)).cast("long")


def _digest(text_col: str) -> Column:
    return F.md5(F.coalesce(F.col(text_col), F.lit("")))


def order_hash(seed: int, epoch: Column, id_: Column, digest: Column) -> Column:
    """A hexadecimal hash that orders the documents of an epoch; the text's digest breaks ties of ids."""
    named = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(id_.cast("string"), F.lit("null")))
    return F.concat(F.md5(named), digest)


def _weights(name: str, weights: dict[str, int], default: int) -> Column:
    value = F.lit(default).cast("long")
    for key, weight in weights.items():
        value = F.when(F.col(name) == key, F.lit(weight).cast("long")).otherwise(value)
    return value


def _share(nodes: DataFrame, parents: list[str], node: str) -> DataFrame:
    """Splits ``budget`` of a parent over its ``node`` rows by ``weight``, none above
    its ``capacity``: those with the least capacity for their weight are filled
    first, and what they leave goes to the siblings."""
    siblings = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    order = siblings.orderBy((F.col("capacity").cast("double") / F.col("weight")).asc(), F.col(node).asc_nulls_first())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    live = nodes.where("weight > 0")
    live = live.withColumns({"taken": F.coalesce(F.sum("capacity").over(before), F.lit(0)), "rest": F.sum("weight").over(after)})
    # Filled while the budget left, split by weight, reaches the capacity; the order makes that a prefix.
    fits = F.expr("cast(capacity as decimal(20,0)) * rest <= cast(greatest(budget - taken, 0) as decimal(20,0)) * weight")
    live = live.withColumn("full", F.min(fits.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) == 1)
    live = live.withColumns(
        {
            "spent": F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(siblings), F.lit(0)),
            "open": F.sum(F.when(~F.col("full"), F.col("weight"))).over(siblings),
        }
    )
    even = F.expr("cast((cast(budget - spent as decimal(20,0)) * weight) div open as bigint)")
    return live.withColumn("given", F.when(F.col("full"), F.col("capacity")).otherwise(F.least(F.col("capacity"), even))).drop(
        "taken", "rest", "full", "spent", "open", "budget"
    )


def _matched(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Joins on ``keys``, null equal to null; all columns of ``left`` and the others of ``right``."""
    named = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    joined = left.join(named, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys], how)
    return joined.drop(*[f"_right_{k}" for k in keys])


def budgets(leaves: DataFrame, total: int, weights: dict[str, dict[str, int]], epochs: int, default: int = 1) -> DataFrame:
    """``leaves`` (``domain``, ``language``, ``source``, ``tokens``) with ``given``, their tokens of the mix."""
    weight = {level: _weights(level, weights.get(level, {}), default) for level in LEVELS}
    given = None
    for depth, level in enumerate(LEVELS):
        parents = list(LEVELS[:depth])
        # What can be spent: leaves that no node of weight 0 below this one shuts off.
        usable = F.lit(True)
        for lower in LEVELS[depth + 1 :]:
            usable = usable & (weight[lower] > 0)
        spendable = F.when(usable, F.col("tokens") * epochs).otherwise(F.lit(0))
        nodes = leaves.groupBy(*parents, level).agg(F.sum(spendable).alias("capacity")).withColumn("weight", weight[level])
        if given is not None:
            nodes = _matched(nodes, given.withColumnRenamed("given", "budget"), parents)
        else:
            nodes = nodes.withColumn("budget", F.lit(total).cast("long"))
        given = _share(nodes, parents, level).select(*parents, level, "given")
    return _matched(leaves, given, list(LEVELS))


def mix(
    docs: DataFrame,
    domain: Column,
    language: Column,
    source: Column,
    weights: dict[str, dict[str, int]],
    share: tuple[int, int] = (1, 1),
    epochs: int = 1,
    seed: int = 0,
    default: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The mix: rows of ``docs`` with ``domain``, ``n_tokens`` and ``epoch`` (from 0),
    once for each epoch that takes them. The budget is ``share`` (numerator,
    denominator) of all tokens; a tree of weight 0 nodes spends nothing there."""
    level = {"domain": domain, "language": language, "source": source}
    narrow = docs.select(
        *[c.cast("string").alias(n) for n, c in level.items()],
        F.col(id_col).alias("id"),
        _digest(text_col).alias("digest"),
        word_count(F.col(text_col)).alias("tokens"),
    )
    sizes = written(narrow, "mix-sizes")
    leaves = sizes.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    tokens = sizes.agg(F.sum("tokens")).first()[0] or 0
    plan = budgets(leaves, tokens * share[0] // share[1], weights, epochs, default)
    # Full epochs, and what is left for the next one.
    plan = plan.withColumn("whole", F.when(F.col("tokens") > 0, F.expr("given div tokens")).otherwise(F.lit(0)).cast("int"))
    plan = written(plan.withColumn("rest", F.col("given") - F.col("whole") * F.col("tokens")), "mix-plan")
    cut = written(_cuts(sizes, plan, seed), "mix-cuts")

    rows = docs.select(*[c.cast("string").alias(f"own_{n}") for n, c in level.items()], F.struct(*docs.columns).alias("row"))
    joined = rows.join(cut, [F.col(f"own_{c}").eqNullSafe(F.col(c)) for c in LEVELS])
    joined = joined.select("own_domain", "row", "whole", "last", F.explode(F.sequence(F.lit(0), F.col("whole"))).alias("epoch"))
    hashed = order_hash(seed, F.col("whole"), F.col(f"row.`{id_col}`"), _digest(f"row.`{text_col}`"))
    taken = (F.col("epoch") < F.col("whole")) | (hashed <= F.col("last"))
    added = ("domain", "n_tokens", "epoch")
    return joined.where(taken).select(
        *[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in added],
        F.col("own_domain").alias("domain"),
        word_count(F.col(f"row.`{text_col}`")).alias("n_tokens"),
        "epoch",
    )


def _cuts(sizes: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """``plan`` with ``last``: the hash of the last document that the unfinished epoch of
    a leaf takes (null for none)."""
    keys = list(LEVELS)
    open_ = plan.where("rest > 0 OR tokens = 0").select(*keys, "rest", "whole")
    ordered = _matched(sizes, open_, keys).select(*keys, "rest", "tokens", order_hash(seed, F.col("whole"), F.col("id"), F.col("digest")).alias("hash"))
    ordered = ordered.withColumn("bucket", F.substring("hash", 1, BUCKET_DIGITS))
    by_leaf = Window.partitionBy(*keys).orderBy("bucket")
    buckets = ordered.groupBy(*keys, "bucket", "rest").agg(F.sum("tokens").alias("sum"))
    buckets = buckets.withColumn("upto", F.sum("sum").over(by_leaf))
    # Buckets that fit as a whole, and the one in which the budget ends.
    edge = buckets.where("upto > rest AND upto - sum <= rest").select(*keys, "bucket", F.expr("rest - upto + sum").alias("room"))
    inside = _matched(ordered.drop("rest"), edge, [*keys, "bucket"])
    running = Window.partitionBy(*keys, "bucket").orderBy("hash").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    partly = inside.withColumn("upto", F.sum("tokens").over(running)).where("upto <= room").groupBy(*keys).agg(F.max("hash").alias("last"))
    # A whole bucket ends after its highest possible hash.
    whole = buckets.where("upto <= rest").groupBy(*keys).agg(F.concat(F.max("bucket"), F.lit("g")).alias("last"))
    last = whole.unionByName(partly).groupBy(*keys).agg(F.max("last").alias("last"))
    return _matched(plan, last, keys, "left")
