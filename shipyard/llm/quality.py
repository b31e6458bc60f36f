"""Quality scores: random Fourier features of document statistics, ridge by
partition-summed normal equations, isotonic calibration.

Each whole text becomes a vector of statistics of its bytes, words and lines (one
pass, no shuffle of text). Random Fourier features approximate a Gaussian kernel
on these vectors. Every partition of labelled rows adds up its share of the
normal equations, Spark sums the shares, and the driver solves one system whose
size is the number of features, whatever the number of rows. The other labelled
rows calibrate: their scores are counted in a fixed number of bins, and pooled
adjacent violators make the share of good rows a rising function of the score.

Labels are learnt from rows whose crc32 of the id (as text) modulo 3 is 0 (fit)
or 2 (calibration); remainder 1 is held out. All labelled rows are used. Only the
text enters a score.

A null text counts as empty and gets a score like any other. A null id has no
label and is not held out. Several labels of one id count as their mean; null
labels as none. Without labels, or with labels of one class only, every score is
the mean label (0.5 without any). Repeated rows come out repeated; an empty table
gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from shipyard.llm.bytetext import flat, mix, span_hash, word_bounds
from shipyard.llm.common import ready, text_chunks, written

LOWER, UPPER, DIGIT, BLANK, LINE, STOP, QUOTE, SYMBOL, WIDE = range(9)
KINDS = 9
FOURIER = 256
#: Labelled documents that the pipeline fits a model on; of more, about so many.
FIT_ROWS = 250_000
RIDGE = 1e-3
BINS = 1024
#: Share of a score that follows the raw score, so that calibration keeps its order.
ORDER_SHARE = 0.02


def _kinds() -> np.ndarray:
    kind = np.full(256, SYMBOL, np.uint8)
    kind[0x61:0x7B], kind[0x41:0x5B], kind[0x30:0x3A], kind[0x80:] = LOWER, UPPER, DIGIT, WIDE
    kind[[0x20, 0x09, 0x0B, 0x0C, 0x0D]], kind[0x0A] = BLANK, LINE
    kind[[ord(c) for c in ".,;:?!"]] = STOP
    kind[[ord(c) for c in "'\"()-"]] = QUOTE
    return kind


KIND = _kinds()


def statistics(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of statistics per document of a flat text column."""
    docs, size = len(offsets) - 1, np.diff(offsets)
    kind = KIND[buf]
    owner = np.repeat(np.arange(docs), size)
    counts = np.bincount(owner * KINDS + kind, minlength=docs * KINDS).reshape(docs, KINDS)
    out = [counts[:, k] / np.maximum(1, size) for k in range(KINDS)]

    starts, ends, first = word_bounds(buf, offsets)
    n = np.diff(first)
    some = np.maximum(1, n)
    of = np.repeat(np.arange(docs), n)
    mean = lambda x: np.bincount(of, x, docs) / some
    length = (ends - starts).astype(float)
    average = mean(length)
    out += [np.log1p(n), average, np.sqrt(np.maximum(0, mean(length**2) - average**2)), mean(length <= 3), mean(length >= 12)]
    total = lambda *kinds: np.r_[0, np.cumsum(np.isin(kind, kinds))]
    inside = lambda sums: sums[ends] - sums[starts]
    symbols, upper, stops = inside(total(SYMBOL)), inside(total(UPPER)), inside(total(STOP))
    out += [mean(symbols > 0), mean(symbols >= length), mean((upper > 0) & (upper >= (length - stops) * 0.8) & (length > 1)), mean(stops > 0), mean(stops > 1)]
    out += [mean(KIND[buf[starts]] == UPPER) if len(starts) else np.zeros(docs)]

    def repeats(hashes: np.ndarray, of: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per document the share of different items, and of the most frequent one."""
        if not len(hashes):
            return np.ones(docs), np.zeros(docs)
        _, at, times = np.unique(mix(hashes ^ mix(of.astype(np.uint64) + np.uint64(1))), return_index=True, return_counts=True)
        most = np.zeros(docs)
        np.maximum.at(most, of[at], times)
        return np.where(n > 0, np.bincount(of[at], minlength=docs) / np.maximum(1, n), 1.0), most / np.maximum(1, n)

    hashes = span_hash(buf, starts, ends)
    out += repeats(hashes, of, n)
    if len(hashes) > 1:
        pair = np.flatnonzero(of[1:] == of[:-1])
        out.append(repeats(mix(hashes[:-1][pair]) + hashes[1:][pair], of[:-1][pair], np.maximum(0, n - 1))[0])
    else:
        out.append(np.ones(docs))

    breaks = np.flatnonzero(kind == LINE)
    edge = np.unique(np.r_[offsets, breaks, breaks + 1])
    a, b = edge[:-1], edge[1:]
    filled = kind[a] != LINE if len(a) else np.zeros(0, bool)
    a, b = a[filled], b[filled]
    line_of = np.searchsorted(offsets, a, "right") - 1
    lines = np.bincount(line_of, minlength=docs)
    out += [np.log1p(lines), np.log1p(size / np.maximum(1, lines))]
    out += repeats(span_hash(buf, a, b), line_of, lines)
    return np.column_stack(out)


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Id, the columns ``keep`` and ``x``, the statistics of the text."""
    ready(docs.sparkSession)
    plain = docs.select(id_col, *keep, text_col)
    schema = StructType([*[f for f in plain.schema.fields if f.name != text_col], StructField("x", ArrayType(DoubleType()))])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in text_chunks(batches, text_col):
            x = statistics(*flat(rows[text_col]))
            column = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
            yield from rows.drop_columns([text_col]).append_column("x", column).to_batches()

    return plain.mapInArrow(make, schema)


@dataclass(frozen=True)
class Model:
    """Everything a score needs; its size does not depend on the data."""

    center: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    low: float
    high: float
    knots: np.ndarray
    values: np.ndarray

    def fourier(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.center) / self.scale, -8, 8)
        waves = np.sqrt(2 / len(self.phases)) * np.cos(z @ self.directions + self.phases)
        return np.column_stack([waves, np.ones(len(x))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.fourier(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.raw(x)
        order = 1 / (1 + np.exp(-4 * (np.clip(raw, -10, 10) - 0.5)))
        return np.clip((1 - ORDER_SHARE) * np.interp(raw, self.knots, self.values) + ORDER_SHARE * order, 0, 1)


def rows_of(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat_values = column.flatten().to_numpy(zero_copy_only=False)
    return flat_values.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def fold(id_col: str = "doc_id") -> F.Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3


def isotonic(sums: np.ndarray, counts: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooled adjacent violators: (mean position, mean value) of each block."""
    blocks: list[list[float]] = []
    for s, c, x in zip(sums, counts, at, strict=True):
        blocks.append([s, c, x * c])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [u + v for u, v in zip(blocks[-1], last, strict=True)]
    return np.array([x / c for _, c, x in blocks]), np.array([s / c for s, c, _ in blocks])


def to_fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", most: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs`` that a model is fitted on: those with a label, of more than
    ``most`` labelled ids about ``most``, chosen by a hash. That bounds the broadcast ids."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).select(id_col).distinct()
    share = min(1.0, most / max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64(id_col, F.lit(3)), F.lit(1 << 31)) < int(share * (1 << 31)))
    return docs.join(F.broadcast(known), id_col, "left_semi")


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", seed: int = 7) -> Model:
    """The model from ``stats`` (id, ``x``) and ``labels`` (id, label 0 or 1)."""
    known = labels.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.avg(F.col(label_col).cast("double")).alias("y")).where("y IS NOT NULL")
    rows = written(stats.select(id_col, "x").join(known, id_col).where(fold(id_col) != 1).select("x", "y", fold(id_col).alias("fold")), "labelled")
    width = len(statistics(np.zeros(0, np.uint8), np.zeros(2, np.int64))[0])
    fitting, checking = rows.where("fold = 0"), rows.where("fold = 2")
    parts = [F.avg(F.col("x")[k]).alias(f"m{k}") for k in range(width)] + [F.stddev_pop(F.col("x")[k]).alias(f"s{k}") for k in range(width)]
    row = fitting.agg(F.count("*").alias("n"), F.avg("y").alias("y"), F.min("y").alias("least"), F.max("y").alias("most"), *parts).first()
    rng = np.random.default_rng(seed)
    directions = rng.normal(size=(width, FOURIER)) / np.sqrt(width)
    phases = rng.uniform(0, 2 * np.pi, FOURIER)
    if not row["n"] or row["least"] == row["most"]:
        y = 0.5 if row["y"] is None else float(row["y"])
        flat_y = np.full(2, y)
        return Model(np.zeros(width), np.ones(width), directions, phases, np.zeros(FOURIER + 1), 0.0, 1.0, np.array([0.0, 1.0]), flat_y)
    center = np.array([row[f"m{k}"] for k in range(width)])
    scale = np.array([row[f"s{k}"] for k in range(width)])
    scale[scale < 1e-9] = 1.0
    start = Model(center, scale, directions, phases, np.zeros(FOURIER + 1), 0.0, 1.0, np.zeros(1), np.zeros(1))

    # Normal equations: each partition adds up its own, Spark adds up the cells of all.
    size = FOURIER + 1
    cell_schema = StructType([StructField("i", IntegerType()), StructField("j", IntegerType()), StructField("v", DoubleType())])
    upper = np.triu_indices(size + 1)

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size + 1))
        for b in batches:
            if b.num_rows:
                z = np.column_stack([start.fourier(rows_of(b.column(0))), b.column(1).to_numpy()])
                total += z.T @ z
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)), pa.array(total[upper])], names=["i", "j", "v"])

    cells = fitting.select("x", "y").mapInArrow(share, cell_schema).groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    system = np.zeros((size + 1, size + 1))
    for c in cells:
        system[c["i"], c["j"]] = system[c["j"], c["i"]] = c["v"]
    weights = np.linalg.solve(system[:size, :size] + RIDGE * row["n"] / size * np.eye(size), system[:size, size])

    # Calibration on rows that the ridge has not seen.
    ridge = Model(center, scale, directions, phases, weights, -0.5, 1.5, np.zeros(1), np.zeros(1))
    bin_schema = StructType([StructField("bin", IntegerType()), StructField("y", DoubleType())])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                at = (ridge.raw(rows_of(b.column(0))) - ridge.low) / (ridge.high - ridge.low)
                bins = np.clip((at * BINS).astype(np.int64), 0, BINS - 1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(bins), b.column(1)], names=["bin", "y"])

    found = checking.select("x", "y").mapInArrow(binned, bin_schema).groupBy("bin").agg(F.sum("y").alias("y"), F.count("*").alias("n")).orderBy("bin").collect()
    if not found:  # no rows to calibrate with: the clipped raw score
        return Model(center, scale, directions, phases, weights, ridge.low, ridge.high, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    at = ridge.low + (np.array([r["bin"] for r in found]) + 0.5) / BINS * (ridge.high - ridge.low)
    knots, values = isotonic(np.array([r["y"] for r in found]), np.array([r["n"] for r in found], float), at)
    return Model(center, scale, directions, phases, weights, ridge.low, ridge.high, knots, values)


def scores(stats: DataFrame, model: Model) -> DataFrame:
    """``stats`` with ``score`` in place of ``x``."""
    schema = StructType([*[f for f in stats.schema.fields if f.name != "x"], StructField("score", DoubleType())])
    place = stats.columns.index("x")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                others = [c for k, c in enumerate(b.columns) if k != place]
                yield pa.RecordBatch.from_arrays([*others, pa.array(model.score(rows_of(b.column(place))))], names=schema.names)

    return stats.mapInArrow(apply, schema)


def scored(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` with their score, in one pass without a shuffle;
    a column called ``name`` is replaced."""
    ready(docs.sparkSession)
    plain = docs.drop(name)
    schema = StructType([*plain.schema.fields, StructField(name, DoubleType())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in text_chunks(batches, text_col):
            yield from rows.append_column(name, pa.array(model.score(statistics(*flat(rows[text_col]))))).to_batches()

    return plain.mapInArrow(apply, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: its id, ``keep``, ``held_out``, ``score``, ``predicted``."""
    stats = written(document_statistics(docs, id_col, text_col, keep), "statistics")
    model = fit(stats, labels, id_col, label_col)
    return scores(stats, model).select(
        id_col, *keep, F.coalesce(fold(id_col) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
