"""Exact top-k inner products over norm-sorted vectors.

Vectors are ordered by descending length and cut into blocks of bounded size. A
histogram of the lengths, 256 steps for each doubling, gives the ranges: steps that
hold little share one, a step that holds much is dealt to more blocks by hash. First
every query meets one block of the longest vectors, which gives it a score that its
k-th result cannot fall below, so a length below which no candidate can reach it
(Cauchy-Schwarz). Queries are grouped by that length, and a candidate is copied only
to the groups that it can reach. Within a block the search goes on in descending
length while that holds. There the vectors
are rotated by the singular vectors of the whole table: the partial sum over the
leading coordinates plus the product of the residual lengths bounds a score from
above, and only vectors whose bound reaches the current k-th score are scored,
exactly, on the original whole numbers.

The query set is stated, so queries times blocks is not a join of everything with
everything, but the work grows with their product. Tasks return at most k rows a query.

Vectors that are null or hold null or non-finite components take no part, nor do
rows with a null id; vectors of another length than a query's are no candidates
of it. Of repeated rows each is a candidate, and a query leaves out only its own
row. Ties go to the smaller id. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from shipyard.llm.common import ready, written

#: Bytes of a block of candidates, and queries to a block: both stand in one task.
BLOCK_BYTES, QUERIES = 8 << 20, 4096
#: Steps of the histogram of lengths for each doubling.
STEPS = 256
#: The step of a length of 0, below all others.
LOWEST = -(1 << 30)
#: Vectors scored between two looks at the bounds.
STEP = 1024
#: Leading share of the rotated coordinates in a partial sum.
LEADING = 0.5
#: Below it all sums of products of whole numbers are exact in doubles.
EXACT = 2.0**53


def whole_vectors(vectors: DataFrame, scale: float, id_col: str, vector_col: str) -> DataFrame:
    """``row``, ``id``, ``v`` (floor(scale * x), doubles), ``d``, ``norm`` of the vectors that take part."""
    v = F.col(vector_col)
    fine = F.col(id_col).isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    rows = vectors.where(F.coalesce(fine, F.lit(False))).select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), whole.alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    return written(rows.select("row", "id", "v", F.size("v").alias("d"), norm.alias("norm")), "topk-vectors")


def rotations(rows: DataFrame) -> dict[int, np.ndarray]:
    """For each vector length the singular vectors of all vectors, most weight first:
    sums of squares of each partition, added up by Spark; length squared numbers reach the driver."""
    schema = StructType([StructField("d", IntegerType()), StructField("i", IntegerType()), StructField("j", IntegerType()), StructField("s", DoubleType())])

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, _, x in by_length(batch.column(0)):
                total[d] = total.get(d, 0) + x.T @ x
        for d, m in total.items():
            i, j = np.triu_indices(d)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), d, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(m[i, j])], names=schema.names)

    out: dict[int, np.ndarray] = {0: np.zeros((0, 0))}  # empty vectors have no cell
    for r in rows.select("v").mapInArrow(share, schema).groupBy("d", "i", "j").agg(F.sum("s").alias("s")).collect():
        m = out.setdefault(r["d"], np.zeros((r["d"], r["d"])))
        m[r["i"], r["j"]] = m[r["j"], r["i"]] = r["s"]
    return {d: np.linalg.eigh(m)[1][:, ::-1] for d, m in out.items()}


def step_of(norm: Column) -> Column:
    """The step of a length in the histogram; longer vectors have higher steps."""
    return F.when(norm > 0, F.floor(F.log2(norm) * STEPS).cast("int")).otherwise(LOWEST)


def length_ranges(rows: DataFrame, per: int) -> DataFrame:
    """``step``, its ``range`` (ascending as lengths fall; 0 holds the longest) and the
    ``parts`` that the range is dealt to, of about ``per`` rows each."""
    steps = rows.groupBy("step").agg(F.count("*").alias("n"))
    above = F.sum("n").over(Window.orderBy(F.desc("step"))) - F.col("n")
    ranged = steps.withColumn("range", F.floor(above / per))
    parts = F.greatest(F.lit(1), F.round(F.sum("n").over(Window.partitionBy("range")) / per).cast("int"))
    return ranged.withColumn("parts", parts).select("step", "range", "parts")


def reaches(needs: DataFrame, steps: DataFrame) -> DataFrame:
    """For each ``need`` (a step) with ``n`` queries: ``reach``, the last range that holds a
    step not below it, and ``before``, the queries with a higher need."""
    listed = steps.select(F.col("step").alias("need"), F.lit(0).cast("long").alias("n"), "range")
    listed = listed.unionByName(needs.select("need", "n", F.lit(None).cast("long").alias("range")))
    order = Window.orderBy(F.desc("need"), F.col("n"), F.col("range").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    found = listed.withColumns({"reach": F.coalesce(F.max("range").over(order), F.lit(0).cast("long")), "before": F.sum("n").over(order) - F.col("n")})
    return found.where("range IS NULL").select("need", "n", "reach", "before")


def by_length(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, matrix) for each vector length of a list column."""
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    values, offsets = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    lengths, starts = np.diff(offsets), offsets[:-1] - offsets[0]
    for d in np.unique(lengths):
        pick = np.flatnonzero(lengths == d)
        yield int(d), pick, values[starts[pick][:, None] + np.arange(d)]


class Best:
    """The k best (score, id, row) of each query so far."""

    def __init__(self, queries: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor.copy()
        self.query, self.score, self.id, self.row = (np.zeros(0, t) for t in (np.int64, np.float64, np.int64, np.int64))
        self.queries = queries

    def add(self, query: np.ndarray, score: np.ndarray, id_: np.ndarray, row: np.ndarray) -> None:
        every = [np.r_[a, b] for a, b in ((self.query, query), (self.score, score), (self.id, id_), (self.row, row))]
        order = np.lexsort((every[3], every[2], -every[1], every[0]))
        q = every[0][order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        self.query, self.score, self.id, self.row = (x[order][rank < self.k] for x in every)
        last = rank == self.k - 1
        self.floor[q[last]] = np.maximum(self.floor[q[last]], every[1][order][last])


def block_best(q: dict[str, np.ndarray], c: dict[str, np.ndarray], turn: np.ndarray, k: int) -> Best:
    """The best candidates of a block for each query. Keys: ``v``, ``norm``, ``id``, ``row``; queries also ``floor``."""
    best = Best(len(q["row"]), k, q["floor"])
    order = np.argsort(-c["norm"], kind="stable")
    c = {name: x[order] for name, x in c.items()}
    d = q["v"].shape[1]
    lead = max(1, round(d * LEADING))
    exact = max(1.0, np.abs(q["v"]).max(initial=0)) * max(1.0, np.abs(c["v"]).max(initial=0)) * d < EXACT
    qt, ct = q["v"] @ turn[:, :lead], c["v"] @ turn[:, :lead]
    rest = lambda x, t: np.sqrt(np.maximum(0, x["norm"] ** 2 - (t * t).sum(axis=1)))
    q_rest, c_rest = rest(q, qt), rest(c, ct)
    for i in range(0, len(c["row"]), STEP):
        s = slice(i, i + STEP)
        # Cauchy-Schwarz on whole lengths; the slack covers rounding.
        slack = 1e-9 * (1 + q["norm"] * c["norm"][i])
        live = np.flatnonzero(q["norm"] * c["norm"][i] + slack >= best.floor)
        if not len(live):
            break
        bound = qt[live] @ ct[s].T + q_rest[live, None] * c_rest[None, s] + slack[live, None]
        a, b = np.nonzero(bound >= best.floor[live, None])
        if not len(a):
            continue
        if not exact:
            score = np.einsum("nd,nd->n", q["v"][live][a].astype(np.int64), c["v"][s][b].astype(np.int64)).astype(np.float64)
        elif len(a) * 8 > bound.size:
            score = (q["v"][live] @ c["v"][s].T)[a, b]
        else:
            score = np.einsum("nd,nd->n", q["v"][live][a], c["v"][s][b])
        own = q["row"][live][a] == c["row"][s][b]
        good = ~own & (score >= best.floor[live][a])
        a, b, score = a[good], b[good], score[good].astype(np.float64)
        # Only the k best of the step and their ties are worth sorting.
        if len(a) > 4 * k * len(live):
            table = np.full(bound.shape, -np.inf)
            table[a, b] = score
            kth = np.partition(table, -min(k, table.shape[1]), axis=1)[:, -min(k, table.shape[1])]
            good = score >= kth[a]
            a, b, score = a[good], b[good], score[good]
        best.add(live[a], score, c["id"][s][b], c["row"][s][b])
    return best


def top_k(
    vectors: DataFrame, queries: Column, k: int = 20, scale: float = 64.0, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """The ``k`` best candidates of each row for which ``queries`` holds:
    ``query_id``, ``rank`` (from 1), ``id_col``, ``score``."""
    ready(vectors.sparkSession)
    rows = whole_vectors(vectors, scale, id_col, vector_col).withColumn("step", step_of(F.col("norm")))
    turns = rotations(rows)
    widest = rows.agg(F.max("d")).first()[0] or 1
    steps = written(length_ranges(rows, max(1, BLOCK_BYTES // (8 * widest))), "topk-steps")
    # At most as many rows as there are steps, whatever the number of vectors.
    candidates = rows.join(steps.select("step", "range", "parts"), "step").withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int"))
    asked = rows.where(queries).toDF(*rows.columns).drop("step")  # columns of its own: it meets ``rows`` again
    groups = max(1, -(-asked.count() // QUERIES))
    schema = StructType([StructField("query", LongType()), StructField("query_id", LongType()), StructField("id", LongType()), StructField("row", LongType()), StructField("score", LongType())])

    def search(q: pa.Table, c: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = []
        of = {d: (pick, x) for d, pick, x in by_length(c["v"])} if len(c) else {}
        for d, pick, x in by_length(q["v"]) if len(q) else ():
            if d not in of:
                continue
            where, y = of[d]
            numbers = lambda t, name, rows: t[name].to_numpy()[rows]
            ask = {"v": x, "floor": numbers(q, "floor", pick)} | {n: numbers(q, n, pick) for n in ("norm", "id", "row")}
            best = block_best(ask, {"v": y} | {n: numbers(c, n, where) for n in ("norm", "id", "row")}, turns[d], k)
            out.append([ask["row"][best.query], ask["id"][best.query], best.id, best.row, best.score.astype(np.int64)])
        joined = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 5
        return pa.table([pa.array(x) for x in joined], names=schema.names)

    def met(queries: DataFrame, some: DataFrame) -> DataFrame:
        key = ["group", "range", "part"]
        left = queries.select(*key, "row", "id", "v", "norm", "floor").groupBy(*key)
        return left.cogroup(some.select(*key, "row", "id", "v", "norm").groupBy(*key)).applyInArrow(search, schema)

    def is_head(yes: bool) -> Column:
        return (F.col("range") == 0) & (F.col("part") == 0) if yes else (F.col("range") > 0) | (F.col("part") > 0)

    dealt = asked.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("long"))
    dealt = dealt.withColumns({"range": F.lit(0).cast("long"), "part": F.lit(0), "floor": F.lit(float("-inf"))})
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))
    first = written(met(dealt, candidates.where(is_head(True)).withColumn("group", every)), "topk-first")
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), "id", "row")
    floors = first.withColumn("n", F.row_number().over(ranked)).where(F.col("n") == k).select(F.col("query").alias("row"), F.col("score").cast("double").alias("floor"))
    later = asked.join(floors, "row", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    # The length that a candidate needs; one step less covers rounding.
    needed = F.when((F.col("norm") > 0) & (F.col("floor") > 1), step_of((F.col("floor") - 1e-6) / F.col("norm")) - 1)
    later = written(later.withColumn("need", F.coalesce(needed, F.lit(LOWEST))), "topk-floors")
    reach = written(reaches(later.groupBy("need").agg(F.count("*").alias("n")), steps), "topk-reach")
    later = later.join(reach, "need").withColumn("group", F.floor((F.col("before") + F.pmod(F.xxhash64("row"), F.col("n"))) / QUERIES))
    reached = later.groupBy("group").agg(F.max("reach").alias("reach"))
    pairs = written(reached.withColumn("range", F.explode(F.sequence(F.lit(0).cast("long"), "reach"))).select("group", "range"), "topk-pairs")
    parts = steps.select("range", "parts").distinct()
    asking = later.withColumn("range", F.explode(F.sequence(F.lit(0).cast("long"), "reach"))).join(parts, "range")
    asking = asking.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    second = met(asking.where(is_head(False)), candidates.where(is_head(False)).join(pairs, "range"))
    best = first.unionByName(second).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", F.col("id").alias(id_col), "score")
