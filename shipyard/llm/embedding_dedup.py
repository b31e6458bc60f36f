"""Near-duplicate vectors by comparing strips of vectors near each other.

Unit vectors with a cosine of at least ``t`` lie within the squared distance
``2 - 2t``. A random rotation (signs and a Walsh-Hadamard transform) spreads that
distance over all coordinates. The vectors are sorted by one of these and written
once, in strips of bounded size; a strip knows the ranges of a few coordinates. A
pair of strips whose ranges lie further apart is left out, all others are compared in
tiles: one product in single precision finds the candidates, which are verified at
once with all components in double precision.

A task reads two files of strips and compares each strip of one with each of the
other, so a vector is neither copied nor shuffled for the strips that it meets: what
is on disk grows with the vectors. A task hands on link counts and a spanning
forest. Equal vectors are one class from the start. In high dimensions without
structure nearly all pairs are compared, in tasks of bounded size: the work and the
reading are quadratic, rows and disk are not.

Vectors that are null, zero or hold null or non-finite components link with
nothing (``n_links`` 0, a component of their own), as do rows with a null id
(``component_id`` null, ``kept`` false). Vectors of other lengths never link.
Repeated rows are vectors of their own and link with each other; an empty table
gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, FloatType, IntegerType, LongType, StructField, StructType

from shipyard.llm.common import ready, scratch, written
from shipyard.llm.graph import components
from shipyard.llm.simhash import _forest
from shipyard.session import one_file_per_task

#: Coordinates whose ranges a strip knows.
BLOCKS = 4
#: Numbers in the vectors of a file of strips (32,768 vectors of 64); a task reads two files.
CHUNK_NUMBERS = 32_768 * 64
#: Strips of a file.
STRIPS = 8
TILE = 2048
SLACK = 1e-5


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def rotated(units: np.ndarray, seed: int = 11) -> np.ndarray:
    """A random rotation, the same for all vectors of one length; computed element
    by element, so a vector has the same bits wherever it is rotated."""
    n, d = units.shape
    size = 1 << max(0, d - 1).bit_length()
    out = np.zeros((n, size))
    out[:, :d] = units * np.random.default_rng([seed, d]).choice([-1.0, 1.0], d)
    step = 1
    while step < size:
        pairs = out.reshape(n, size // (2 * step), 2, step)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, size)
        step *= 2
    return out / np.sqrt(size)


def _vectors(blob: bytes, count: int, size: int) -> np.ndarray:
    """``count`` rows of ``size`` floats or doubles each, as doubles."""
    return np.frombuffer(blob, np.float64 if len(blob) == 8 * size * count else np.float32).reshape(count, size).astype(np.float64)


def strip_links(x: np.ndarray, y: np.ndarray, same: bool, limit: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (row of ``x``, row of ``y``) of unit vectors with a cosine of at least ``limit``,
    a bounded number at a time; within one strip each pair once."""
    # A sum of single products is off by a unit of its last place a product at most.
    least = np.float32(limit - max(SLACK, 2e-7 * x.shape[1]))
    x32, y32 = x.astype(np.float32), np.ascontiguousarray(y.astype(np.float32).T)
    for i in range(0, len(x), TILE):
        for j in range(i if same else 0, len(y), TILE):
            near = x32[i : i + TILE] @ y32[:, j : j + TILE] >= least
            a, b = np.divmod(np.flatnonzero(near), near.shape[1])
            a, b = a + i, b + j
            if same:
                a, b = a[a < b], b[a < b]
            for k in range(0, len(a), 1 << 18):  # verified exactly
                p, q = a[k : k + (1 << 18)], b[k : k + (1 << 18)]
                linked = (x[p] * y[q]).sum(axis=1) >= limit
                if linked.any():
                    yield p[linked], q[linked]


def near_duplicates(vectors: DataFrame, limit: float = 0.95, blocks: int = BLOCKS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector: its id, ``n_links`` (other vectors with a cosine of at
    least ``limit``), ``component_id`` (smallest id reached) and ``kept``."""
    ready(vectors.sparkSession)
    # Floats stay floats, which are doubles of fewer bytes; all else is compared as doubles.
    single = vectors.schema[vector_col].dataType == ArrayType(FloatType(), vectors.schema[vector_col].dataType.containsNull)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<float>" if single else "array<double>").alias("v"))
    fine = F.col("id").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.withColumn("part", F.coalesce(fine, F.lit(False)))
    # Vectors are told apart, and their rows found again, by a digest: they themselves are sent twice only.
    zero = F.lit(0).cast("float" if single else "double")  # makes -0.0 0.0
    digest = F.unhex(F.sha2(F.concat_ws(",", F.transform("v", lambda x: (x + zero).cast("string"))), 256))
    grouped = rows.where("part").groupBy("v").agg(F.min("id").alias("least"), F.count("*").alias("n")).withColumn("digest", digest)
    classes = written(grouped.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    found = written(_links(classes, limit, blocks), "vector-links")

    linked = components(found.where("v IS NOT NULL").select("u", "v"))
    counts = found.where("v IS NULL").groupBy("u").agg(F.sum("n").alias("others"))
    rooted = classes.drop("v").join(linked, "node", "left").withColumn("root", F.coalesce("root", "node"))
    of_root = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = rooted.join(of_root, "root").join(counts.withColumnRenamed("u", "node"), "node", "left")
    of_class = of_class.select("digest", "component_id", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    joined = rows.where("part").select("id", digest.alias("digest")).join(of_class, "digest").select("id", "n_links", "component_id")
    alone = rows.where("NOT part").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return joined.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept")
    )


def _links(classes: DataFrame, limit: float, blocks: int) -> DataFrame:
    """(``u``, null, links counted at it here) and (``u``, ``v``, null), a link of a forest."""
    strips = _strips(classes, blocks)
    left = strips.select(*[F.col(c).alias(f"l_{c}") for c in strips.columns])
    right = strips.select(*[F.col(c).alias(f"r_{c}") for c in strips.columns])
    apart = sum((F.greatest(F.lit(0.0), F.col("r_low")[k] - F.col("l_high")[k], F.col("l_low")[k] - F.col("r_high")[k]) ** 2 for k in range(blocks)), F.lit(0.0))
    met = (F.col("l_size") == F.col("r_size")) & (F.col("l_strip") <= F.col("r_strip")) & (apart <= 2 - 2 * limit + SLACK)
    # Every file with every file, read again by each task: no strip goes through a shuffle.
    pairs = left.join(right.hint("shuffle_replicate_nl"), met).select(*[f"{s}_{c}" for s in "lr" for c in ("strip", "size", "node", "n", "v")])
    out_schema = StructType([StructField("u", LongType()), StructField("v", LongType()), StructField("n", LongType())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The strips that the task has met: their first place in what follows, and their unit vectors.
        begin: dict[int, int] = {}
        units: dict[tuple[str, int], np.ndarray] = {}
        node, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        count, label, forest = np.zeros(0, np.int64), np.zeros(0, np.int64), ([], [])
        for batch in batches:
            for row in batch.to_pylist():
                ends = []
                for side in "lr":
                    strip, size = row[f"{side}_strip"], row[f"{side}_size"]
                    if strip not in begin:
                        begin[strip] = len(node)
                        node = np.r_[node, np.frombuffer(row[f"{side}_node"], np.int64)]
                        n = np.r_[n, np.frombuffer(row[f"{side}_n"], np.int64)]
                        count = np.r_[count, np.zeros(len(node) - len(count), np.int64)]
                        label = np.r_[label, np.arange(len(label), len(node))]
                    if (side, strip) not in units:
                        if side == "l":  # right strips come again for each left one
                            units = {k: x for k, x in units.items() if k[0] == "r"}
                        elif len(units) > 2 * STRIPS:
                            units = {k: x for k, x in units.items() if k[0] == "l"}
                        units[side, strip] = unit_rows(_vectors(row[f"{side}_v"], len(row[f"{side}_n"]) // 8, size))
                    ends.append((begin[strip], units[side, strip]))
                (at, x), (to, y) = ends
                for p, q in strip_links(x, y, at == to, limit):
                    p, q = p + at, q + to
                    np.add.at(count, p, n[q])
                    np.add.at(count, q, n[p])
                    u, v = _forest(p, q, len(label), label)
                    forest[0].extend(u)
                    forest[1].extend(v)
        hit = np.flatnonzero(count)
        u = [*node[hit].tolist(), *node[forest[0]].tolist()] if len(hit) else []
        v = [*[None] * len(hit), *node[forest[1]].tolist()] if len(hit) else []
        m = [*count[hit].tolist(), *[None] * len(forest[0])]
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(m, pa.int64())], names=out_schema.names)

    return pairs.mapInArrow(compare, out_schema)


def _strips(classes: DataFrame, blocks: int) -> DataFrame:
    """``classes`` written once as strips of vectors of one length, sorted by a coordinate,
    ``STRIPS`` of them a file, which a task reads as a whole."""
    spark = classes.sparkSession
    kind = np.float32 if classes.schema["v"].dataType.elementType == FloatType() else np.float64
    sorted_schema = StructType([StructField("size", IntegerType()), StructField("x", ArrayType(DoubleType())), *[classes.schema[c] for c in ("node", "n", "v")]])

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(2)
            values, lengths = v.flatten().to_numpy(zero_copy_only=False), np.diff(v.offsets.to_numpy())
            starts = np.cumsum(lengths) - lengths
            for d in np.unique(lengths):
                pick = np.flatnonzero(lengths == d)
                turned = rotated(unit_rows(values[starts[pick][:, None] + np.arange(d)].astype(np.float64)))
                seen = np.zeros((len(pick), blocks))
                seen[:, : min(blocks, turned.shape[1])] = turned[:, :blocks]
                taken = batch.take(pa.array(pick))
                x = pa.ListArray.from_arrays(pa.array(np.arange(len(pick) + 1) * blocks, pa.int32()), pa.array(seen.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pick), d, np.int32)), x, *taken.columns], names=sorted_schema.names)

    turned = classes.select("node", "n", "v").mapInArrow(turn, sorted_schema)
    numbers = classes.agg(F.sum(F.size("v"))).first()[0] or 0
    # Parts of a few files each, so that few files are not full.
    ranged = turned.repartitionByRange(max(1, numbers // (4 * CHUNK_NUMBERS)), "size", F.col("x")[0], "node").sortWithinPartitions("size", F.col("x")[0])
    strip_schema = StructType(
        [
            StructField("size", IntegerType()),
            StructField("low", ArrayType(DoubleType())),
            StructField("high", ArrayType(DoubleType())),
            StructField("node", BinaryType()),
            StructField("n", BinaryType()),
            StructField("v", BinaryType()),
        ]
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows = size = 0

        def packed() -> pa.RecordBatch:
            x, node, n, v = (pa.concat_tables(held)[c].combine_chunks() for c in ("x", "node", "n", "v"))
            seen = x.flatten().to_numpy().reshape(rows, blocks)
            blobs = [a.to_numpy(zero_copy_only=False).astype(t).tobytes() for a, t in ((node, np.int64), (n, np.int64), (v.flatten(), kind))]
            columns = [[size], [seen.min(axis=0).tolist()], [seen.max(axis=0).tolist()], *([b] for b in blobs)]
            types = [pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=strip_schema.names)

        for batch in batches:
            table = pa.Table.from_batches([batch])
            sizes = table["size"].to_numpy()
            at = 0
            while at < len(sizes):
                if rows and sizes[at] != size:
                    yield packed()
                    held, rows = [], 0
                size = int(sizes[at])
                most = max(1, CHUNK_NUMBERS // (STRIPS * size))
                take = min(most - rows, int(np.searchsorted(sizes[at:], size, "right")))
                held.append(table.slice(at, take))
                rows, at = rows + take, at + take
                if rows == most:
                    yield packed()
                    held, rows = [], 0
        if rows:
            yield packed()

    strips = ranged.mapInArrow(pack, strip_schema).withColumn("strip", F.monotonically_increasing_id())
    path = scratch(spark, "vector-strips")
    strips.write.option("maxRecordsPerFile", STRIPS).parquet(path)
    return one_file_per_task(spark).read.schema(strips.schema).parquet(path)
