"""Importance resampling of documents towards the words of target texts.

Every run of ``least`` to ``most`` consecutive words is a feature, hashed to a
bucket by the CRC-32 of its UTF-8 bytes (``crc.py``: byte contributions by the
distance from the end, XORed over the feature). A bucket's gain is the logarithm
of its share among the target's features over its share among all documents, with
one feature added to every bucket. A document's weight is the sum of its features'
gains; a seeded Gumbel number on top makes the highest scores a draw without
replacement in proportion to the weights.

Counts come from all documents and all target texts: each task counts its own
texts into ``buckets`` numbers and Spark adds them up, so what reaches the driver
has the size of the table of buckets. The order of the scores is made by a range
sort; a rank is the place in its range plus the sizes of the ranges before it, so
no task sees more than a range, also where a third of the scores are equal.

A null or empty text has no words: no features, weight 0. A document with fewer
than ``least_words`` words gets a score and no rank. A null id counts as an empty
one in the seeded number and comes first among equal scores; repeated rows are
drawn each. Empty targets leave all gains to the smoothing; an empty table gives
an empty table. Other columns of ``docs`` are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from shipyard.llm.bytetext import flat, gather
from shipyard.llm.common import ready, text_chunks, written
from shipyard.llm.crc import Crc32

#: The bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``: digits, small letters and all beyond ASCII.
WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x80:] = True
#: A to Z become small letters, no other character does.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def words_of(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, starts and ends of all words, for every document the
    index of its first word and one entry more)."""
    low = LOWER[buf]
    if not len(buf):
        return low, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = WORD[low]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(solid & (~np.r_[False, solid[:-1]] | edge[:-1]))
    ends = np.flatnonzero(solid & (~np.r_[solid[1:], False] | edge[1:])) + 1
    return low, starts, ends, np.searchsorted(starts, offsets)


def feature_buckets(
    crc: Crc32, buf: np.ndarray, offsets: np.ndarray, least: int, most: int, buckets: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, bucket) of every feature, and the number of words of every document."""
    low, starts, ends, first = words_of(buf, offsets)
    lengths, n_words = ends - starts, np.diff(first)
    document = np.repeat(np.arange(len(n_words)), n_words)
    if most > 1:  # the words one after the other, with a blank behind each
        joined = np.full(int(lengths.sum()) + len(lengths), 0x20, np.uint8)
        begin = np.cumsum(lengths + 1) - lengths - 1
        joined[gather(begin, lengths)] = low[gather(starts, lengths)]
        low, starts = joined, begin
    found = []
    for n in range(least, most + 1):
        head = np.arange(max(0, len(starts) - n + 1))
        head = head[document[head] == document[head + n - 1]]
        tail = head + n - 1
        code = crc.spans(low, starts[head], starts[tail] + lengths[tail] - starts[head])
        found.append((document[head], (code % np.uint32(buckets)).astype(np.int64)))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]), n_words


def bucket_counts(texts: DataFrame, buckets: int, least: int = 1, most: int = 1, text_col: str = "text") -> np.ndarray:
    """How many features of all ``texts`` fall into each bucket."""
    ready(texts.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc, sums = Crc32(), np.zeros(buckets, np.int64)
        for rows in text_chunks(batches, text_col):
            buf, offsets = flat(rows[text_col])
            sums += np.bincount(feature_buckets(crc, buf, offsets, least, most, buckets)[1], minlength=buckets)
        held = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(sums[held])], names=["bucket", "n"])

    each = texts.select(F.col(text_col)).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in each.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row a bucket at most
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of target share over source share, rounded down."""
    size, all_source, all_target = len(source), int(source.sum()), int(target.sum())
    return np.array(
        [math.floor(1000 * math.log(float(t + 1) * float(all_source + size) / (float(s + 1) * float(all_target + size)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)],
        np.int64,
    )


def document_weights(docs: DataFrame, gains: np.ndarray, least: int, most: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``n_words``, ``n_features`` and ``weight`` of every document."""
    ready(docs.sparkSession)
    schema = StructType([StructField(id_col, docs.schema[id_col].dataType), *[StructField(c, LongType()) for c in ("n_words", "n_features", "weight")]])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc = Crc32()
        for rows in text_chunks(batches, text_col):
            buf, offsets = flat(rows[text_col])
            document, bucket, n_words = feature_buckets(crc, buf, offsets, least, most, len(gains))
            weight = np.zeros(len(n_words), np.int64)
            np.add.at(weight, document, gains[bucket])
            n_features = np.bincount(document, minlength=len(n_words))
            columns = [rows[id_col].combine_chunks(), *[pa.array(x.astype(np.int64)) for x in (n_words, n_features, weight)]]
            yield from pa.table(columns, names=schema.names).to_batches()

    return docs.select(id_col, text_col).mapInArrow(weigh, schema)


def gumbel(id_col: str, seed: int) -> F.Column:
    """Thousandths of a standard Gumbel number of the id, rounded down."""
    code = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(code, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def ranks(scored: DataFrame, id_col: str, drawn: int) -> DataFrame:
    """``scored`` (a written table with ``score``) with ``rank`` from 1 by descending
    score, then ascending id; null beyond the first ``drawn``."""
    order = [F.desc("score"), F.asc(id_col), F.asc("_row")]
    sorted_ = scored.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    # Within a task, rows are numbered in order; a range sort deals ascending ranges to ascending tasks.
    place = F.monotonically_increasing_id()
    placed = written(sorted_.withColumn("_part", F.shiftright(place, 33)).withColumn("_place", place.bitwiseAND(F.lit((1 << 33) - 1))).drop("_row"), "ranks")
    sizes = placed.groupBy("_part").agg(F.count("*").alias("n")).orderBy("_part").collect()  # one row a range
    before, upto = [], 0
    for row in sizes:
        before.append((row["_part"], upto))
        upto += row["n"]
    start = scored.sparkSession.createDataFrame(before, "_part long, _before long")
    rank = F.col("_before") + F.col("_place") + 1
    return placed.join(F.broadcast(start), "_part").withColumn("rank", F.when(rank <= drawn, rank)).drop("_part", "_place", "_before")


def resample(
    docs: DataFrame,
    target: DataFrame,
    share: tuple[int, int] = (10, 100),
    buckets: int = 10_000,
    words: tuple[int, int] = (1, 1),
    least_words: int = 20,
    seed: int = 2024,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_features``, ``weight``, ``score`` and
    ``rank``, which the ``share`` of the long enough documents with the highest scores have."""
    source = bucket_counts(docs, buckets, *words, text_col)
    gains = bucket_gains(source, bucket_counts(target, buckets, *words, target_text_col))
    weights = document_weights(docs, gains, *words, id_col, text_col)
    scored = written(weights.withColumn("score", F.col("weight") + gumbel(id_col, seed)), "scores")
    long_enough = scored.where(F.col("n_words") >= least_words)
    drawn = long_enough.count() * share[0] // share[1]
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranks(long_enough, id_col, drawn).unionByName(rest)
