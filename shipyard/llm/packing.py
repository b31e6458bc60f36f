"""Sum-of-squares packing of documents into token sequences of one size.

Documents become pieces of at most ``capacity`` tokens (only longer documents
are cut; the first piece takes what is left over). Pieces are dealt at random to
groups of bounded size, each sorted by length, and every piece goes where the sum
over all residual gaps of the squared number of open sequences with that gap
becomes smallest; ties go to the smallest gap. Longest first, a new sequence is
opened only if the piece fits in none: that leaves under 0.3 % unused, where
random order leaves 2 to 5 %.

A task holds nothing but the open sequences of its group. The groups are dealt
by a hash of the row, so neither a hot source nor many equal rows meet in one.

A null text counts as empty: one piece of the end token alone. Null ids stay
null, repeated rows are packed each, an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from shipyard.llm import bpe
from shipyard.llm.bytetext import flat
from shipyard.llm.common import ready, text_chunks

#: Pieces of a packing group on average; more make the packing hardly tighter.
GROUP_ROWS = 32_768


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The pieces of all documents: id, ``piece``, ``start`` (tokens of the document
    before it), ``length`` and ``ids`` (little-endian unsigned 32-bit numbers)."""
    ready(docs.sparkSession)
    schema = StructType(
        [
            StructField(id_col, docs.schema[id_col].dataType),
            StructField("piece", IntegerType()),
            StructField("start", LongType()),
            StructField("length", LongType()),
            StructField("ids", BinaryType()),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe.load(tokenizer)
        for rows in text_chunks(batches, text_col):
            buf, offsets = flat(rows[text_col])
            ids, at = model.encode(buf, offsets)
            counts = np.diff(at)
            total = counts + 1  # the end token
            stream = np.full(len(ids) + len(counts), end_id, "<u4")
            stream[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
            pieces = -(-total // capacity)
            owner = np.repeat(np.arange(len(counts)), pieces)
            number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            first = (total - 1) % capacity + 1
            start = np.where(number == 0, 0, first[owner] + (number - 1) * capacity)
            length = np.where(number == 0, first[owner], capacity)
            ends = np.r_[0, np.cumsum(length)] * 4
            raw = pa.Array.from_buffers(pa.binary(), len(owner), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(stream)])
            out = [
                rows[id_col].combine_chunks().take(pa.array(owner)),
                pa.array(number.astype(np.int32)),
                pa.array(start.astype(np.int64)),
                pa.array(length.astype(np.int64)),
                raw,
            ]
            yield from pa.table(out, names=schema.names).to_batches()

    return docs.select(id_col, text_col).mapInArrow(cut, schema)


class SumOfSquares:
    """Open sequences by their residual gap; ``place`` gives each piece its sequence."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, np.int64)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.sequences = 0

    def place(self, n: int) -> tuple[int, int]:
        """(sequence, offset therein) of a piece of ``n`` tokens."""
        if not 1 <= n <= self.capacity:
            raise ValueError(f"a piece of {n} tokens does not fit sequences of {self.capacity}")
        held = self.count[n:]
        change = 1 - 2 * held
        change[1:] += 2 * self.count[1 : self.capacity + 1 - n] + 1
        change[held == 0] = np.iinfo(np.int64).max
        gap = n + int(change.argmin())
        if self.count[gap]:
            sequence = self.open[gap].pop()
            self.count[gap] -= 1
        else:
            gap, sequence = self.capacity, self.sequences
            self.sequences += 1
        if gap > n:
            self.open[gap - n].append(sequence)
            self.count[gap - n] += 1
        return sequence, self.capacity - gap


def pack(pieces: DataFrame, expected_rows: int, capacity: int = 1024, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``pieces`` (any columns, among them ``length``, 1 to ``capacity``) with
    ``sequence_id`` and ``offset``. ``expected_rows`` only sets the number of groups."""
    ready(pieces.sparkSession)
    plain = pieces.drop("sequence_id", "offset")
    schema = StructType([*plain.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = SumOfSquares(capacity)
        base = TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [packer.place(n) for n in batch.column(batch.schema.get_field_index("length")).to_pylist()]
            sequence, offset = np.array(placed, np.int64).reshape(-1, 2).T
            columns = [*batch.columns, pa.array(base + sequence), pa.array(np.ascontiguousarray(offset))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    groups = max(1, -(-expected_rows // group_rows))
    dealt = plain.withColumn("_row", F.monotonically_increasing_id())
    dealt = dealt.repartition(groups, F.xxhash64("_row", "length")).sortWithinPartitions(F.desc("length"), "_row")
    return dealt.drop("_row").mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The finished sequences of ``pack`` over ``token_pieces``: one row each with
    its pieces in place and its token ids (at most ``capacity`` pieces a group)."""
    part = F.struct("offset", "ids")
    ordered = F.sort_array(F.collect_list(part))
    joined = F.aggregate(F.transform(ordered, lambda p: p["ids"]), F.lit(b""), lambda a, b: F.concat(a, b))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.count("*").alias("n_pieces"), joined.alias("ids"))
