"""SimHash near-duplicates by a segment-popcount embedding.

Each document gets a 64-bit majority fingerprint of its word shingles. Equal
fingerprints become one class. A fingerprint is cut into segments and embedded as
the vector of their bit counts: fingerprints with ``d`` differing bits lie within
Manhattan distance ``d`` there, so a range join on the integer grid of these
vectors finds every pair. Each class stands in its own cell and visits the cells
within the distance in one half of the directions; cells compare the full
fingerprints bit by bit, in blocks, and hand on only a spanning forest of the
links they find. Components of that forest are the groups. A cell with many owners
is cut into chunks, each two of which are a group of their own, and guests stream
past the owners, so a task's memory is bounded. Fingerprints without structure
fill the central cells in proportion, so comparisons there grow with the square.

Work and rows grow with the number of different fingerprints times the fixed
number of visited cells; copies cost one row each. No pair of documents is ever
written.

A null text counts as empty: fingerprint zero, linked like any other. Null ids
stay null and never are a ``component_id`` unless a whole component has no id;
repeated rows come out repeated; an empty table gives an empty table.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from shipyard.llm.bytetext import flat, gather, word_bounds
from shipyard.llm.common import ready, text_chunks, written
from shipyard.llm.graph import components
from shipyard.llm.xxh import xxh64

#: Segments of the embedding: more make smaller cells but more visits.
SEGMENTS = 5
#: Grid cells of a vector are numbered in this base; a bit count and a step stay below it.
BASE = 64
#: Classes compared at once within a cell.
BLOCK = 2048
#: Owners of a cell that one task compares; a fuller cell is cut into chunks.
OWNERS = 65_536
#: Rows that a task holds before it compares them; the guests of one cell may come in several such pieces.
PIECE = 1 << 18
#: A cell's chunks are numbered in this base.
CHUNKS = 1 << 15

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def shingle_fingerprints(buf: np.ndarray, offsets: np.ndarray, words: int = 3, seed: int = 42) -> np.ndarray:
    """The majority fingerprint of each document of a flat text column."""
    starts, ends, first = word_bounds(buf, offsets)
    n = np.diff(first)
    out = np.zeros(len(n), np.uint64)
    if not len(starts):
        return out
    length = ends - starts
    end = np.cumsum(length + 1)  # words with one blank after each
    begin = end - length - 1
    joined = np.full(int(end[-1]), 0x20, np.uint8)
    joined[gather(begin, length)] = _LOWER[buf[gather(starts, length)]]
    shingles = np.where(n == 0, 0, np.maximum(1, n - words + 1))
    left = gather(first[:-1], shingles)
    right = np.minimum(left + words - 1, np.repeat(first[1:] - 1, shingles))
    h = xxh64(joined, begin[left], begin[right] + length[right], seed)
    at = np.r_[0, np.cumsum(shingles)]
    bits = h.astype("<u8").view(np.uint8).reshape(-1, 8)
    for d in np.flatnonzero(shingles):
        votes = np.zeros(64, np.int64)
        for a in range(at[d], at[d + 1], 1 << 20):
            votes += np.unpackbits(bits[a : min(a + (1 << 20), at[d + 1])], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[d] = np.packbits(votes * 2 > shingles[d], bitorder="little").view("<u8")[0]
    return out


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: its id, the columns ``keep``, and ``fp`` (the fingerprint's bits as a long)."""
    ready(docs.sparkSession)
    plain = docs.select(id_col, *keep, text_col)
    schema = StructType([*[f for f in plain.schema.fields if f.name != text_col], StructField("fp", LongType())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in text_chunks(batches, text_col):
            fp = shingle_fingerprints(*flat(rows[text_col]), words, seed)
            yield from rows.drop_columns([text_col]).append_column("fp", pa.array(fp.view(np.int64))).to_batches()

    return plain.mapInArrow(make, schema)


def segments_of(count: int) -> list[int]:
    """Masks of ``count`` segments of 64 bits, as even as can be."""
    cuts = [round(64 * k / count) for k in range(count + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in itertools.pairwise(cuts)]


def steps_within(distance: int, segments: int) -> list[int]:
    """Numbers of the grid steps up to a Manhattan ``distance``: of each step and
    its opposite, the positive one; and the step to the cell itself."""
    each = itertools.product(range(-distance, distance + 1), repeat=segments)
    numbers = (sum(x * BASE**k for k, x in enumerate(v)) for v in each if sum(map(abs, v)) <= distance)
    return sorted(x for x in numbers if x >= 0)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _forest(a: np.ndarray, b: np.ndarray, nodes: int, label: np.ndarray) -> tuple[list[int], list[int]]:
    """Joins the pairs (a, b) into ``label`` and returns the pairs that were needed."""
    used_a, used_b = [], []

    def root(x: int) -> int:
        while label[x] != x:
            label[x] = label[label[x]]
            x = label[x]
        return x

    while len(a):
        # A pair for each pair of trees at most; whole blocks collapse in a few rounds.
        ra, rb = _roots(label, a), _roots(label, b)
        apart = ra != rb
        if not apart.any():
            break
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        _, one = np.unique(np.maximum(ra, rb), return_index=True)
        for i in one:
            x, y = root(int(a[i])), root(int(b[i]))
            if x != y:
                label[max(x, y)] = min(x, y)
                used_a.append(int(a[i]))
                used_b.append(int(b[i]))
    return used_a, used_b


def _roots(label: np.ndarray, x: np.ndarray) -> np.ndarray:
    r = label[x]
    while True:
        up = label[r]
        if (up == r).all():
            return r
        r = up


def _cell_links(home: np.ndarray, guests: np.ndarray, distance: int, inner: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links home-guest of one cell and, if ``inner``, home-home."""
    every = np.r_[home, guests]
    label = np.arange(len(every))
    out_a, out_b = [], []
    for i in range(0, len(home), BLOCK):
        for j in range(i if inner else len(home), len(every), BLOCK):
            near = np.bitwise_count(home[i : i + BLOCK, None] ^ every[None, j : j + BLOCK]) <= distance
            x, y = np.nonzero(near)
            x, y = x + i, y + j
            x, y = x[x < y], y[x < y]
            if len(x):
                a, b = _forest(x, y, len(every), label)
                out_a += a
                out_b += b
    return every[out_a], every[out_b]


def near_links(classes: DataFrame, distance: int = 3, segments: int = SEGMENTS) -> DataFrame:
    """``classes`` (column ``fp``, distinct) to links (``u``, ``v``) that connect
    all classes which at most ``distance`` differing bits connect."""
    spark = ready(classes.sparkSession)
    home = F.lit(0).cast("long")
    for k, mask in enumerate(segments_of(segments)):
        home = home + F.bit_count(F.col("fp").bitwiseAND(F.lit(_signed(mask)).cast("long"))).cast("long") * F.lit(BASE**k)
    steps = F.array(*[F.lit(s).cast("long") for s in steps_within(distance, segments)])
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Many rows come of each class, so the classes are spread before that.
    cells = classes.select("fp", home.alias("home")).repartition(partitions, "fp").select("fp", "home", F.explode(steps).alias("step"))
    cells = cells.select((F.col("home") + F.col("step")).alias("cell"), (F.col("step") != 0).alias("guest"), "fp")
    # A full cell's owners are cut into chunks: each two chunks meet, and all guests meet each chunk.
    full = classes.groupBy(home.alias("cell")).agg(F.ceil(F.count("*") / OWNERS).cast("int").alias("chunks")).where("chunks > 1")
    full = written(full.withColumn("chunks", F.least("chunks", F.lit(CHUNKS))), "simhash-full")
    cut = cells.join(full, "cell").withColumn("own", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    own = F.when(F.col("guest"), F.col("other")).otherwise(F.col("own"))
    pair = F.least(own, "other") * F.lit(CHUNKS).cast("long") + F.greatest(own, "other")
    cut = cut.select("cell", pair.alias("pair"), (F.col("guest") | (own > F.col("other"))).alias("guest"), "fp")
    rest = cells.join(full, "cell", "left_anti").select("cell", F.lit(0).cast("long").alias("pair"), "guest", "fp")
    schema = StructType([StructField("u", LongType()), StructField("v", LongType())])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by cell and pair, owners first; a group may go over several batches.
        held: list[tuple[np.ndarray, ...]] = []

        def bounds(cell: np.ndarray, pair: np.ndarray) -> np.ndarray:
            return np.r_[0, np.flatnonzero((cell[1:] != cell[:-1]) | (pair[1:] != pair[:-1])) + 1, len(cell)]

        def links(rows: tuple[np.ndarray, ...], again: bool) -> Iterator[pa.RecordBatch]:
            cell, pair, guest, fp = rows
            owned = np.r_[0, np.cumsum(~guest)]
            found = []
            for a, b in itertools.pairwise(bounds(cell, pair).tolist() if len(cell) else []):
                own = int(owned[b] - owned[a])
                if own and b - a > 1:
                    one, other = divmod(int(pair[a]), CHUNKS)
                    u, v = _cell_links(fp[a : a + own], fp[a + own : b], distance, one == other and not (again and a == 0))
                    if len(u):
                        found.append((u, v))
            if found:
                u, v = (np.concatenate(x).view(np.int64) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=schema.names)

        size, again = 0, False  # again: the owners of the first group have met each other
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
            held.append((*rows[:3], rows[3].view(np.uint64)))
            size += batch.num_rows
            if size < PIECE:
                continue
            whole = tuple(np.concatenate(x) for x in zip(*held, strict=True))
            last = int(bounds(whole[0], whole[1])[-2])
            if last:  # all groups but the last are complete
                yield from links(tuple(x[:last] for x in whole), again)
                whole, again = tuple(x[last:] for x in whole), False
            if len(whole[0]) >= PIECE and whole[2][-1]:  # its owners are all here: they stay, these guests go
                yield from links(whole, again)
                whole, again = tuple(x[~whole[2]] for x in whole), True
            held, size = [whole], len(whole[0])
        if held:
            yield from links(tuple(np.concatenate(x) for x in zip(*held, strict=True)), again)

    dealt = rest.unionByName(cut).repartition(partitions, "cell", "pair").sortWithinPartitions("cell", "pair", "guest")
    return written(dealt.mapInArrow(join, schema), "simhash-links")


def near_duplicates(
    docs: DataFrame, words: int = 3, distance: int = 3, segments: int = SEGMENTS, seed: int = 42, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: its id, ``fp``, ``component_id`` (the smallest id it
    reaches over links of at most ``distance`` differing bits)."""
    prints = written(fingerprints(docs.select(id_col, text_col), words, seed, id_col, text_col), "fingerprints")
    return with_component(prints, distance, segments, F.min(id_col).alias("component_id"))


def with_component(prints: DataFrame, distance: int, segments: int, chosen: F.Column) -> DataFrame:
    """``prints`` (with ``fp``) plus the aggregate ``chosen`` over each component;
    a minimum, so that it can be taken per class first."""
    name = prints.groupBy().agg(chosen).columns[0]
    classes = prints.groupBy("fp").agg(chosen)
    linked = components(near_links(classes.select("fp"), distance, segments))
    rooted = classes.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    of_root = rooted.groupBy("root").agg(F.min(name).alias(name))
    of_print = rooted.select("fp", "root").join(of_root, "root").select("fp", name)
    return prints.join(of_print, "fp")
