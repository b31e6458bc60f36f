"""First-fit decreasing packing over a tournament tree, group by group.

Documents become token ids with an end token; longer ones are cut into full
sequences and a rest. The pieces are dealt at random to groups of bounded size.
In a group, longest first, each piece goes to the first sequence it fits in: a
tournament tree over the sequences keeps the largest room of every subtree at its
top, so the first fit is found on one way down from the root.

A sequence that is not full is padded to ``capacity``, unless its length is a
power of two. What first fit leaves open is therefore closed by cutting: the
last open sequences of the group give up tokens to the first ones, and the one
sequence left in the middle is cut into lengths that are powers of two. No token
is padding then; about one document in fifty is cut for it.

A task holds the ids of one group. The groups are dealt by a hash of the row, so
neither a hot source nor many equal rows meet in one, and a text of any length
leaves nothing but pieces of at most ``capacity`` tokens. Within a group the order
is by length, then row: a task that runs again gives the same sequences.

A null text counts as empty: the end token alone. Null ids stay null, repeated
rows are packed each, other columns are left out, an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from shipyard.llm import word_bpe
from shipyard.llm.bytetext import flat, gather
from shipyard.llm.common import ready, text_chunks

#: Text bytes of a packing group on average; its ids take about half of that.
GROUP_BYTES = 24 << 20
#: Ids of an output batch.
OUT_IDS = 1 << 20


class TournamentTree:
    """Sequences of one capacity; ``place`` puts a length into the first that has room."""

    def __init__(self, capacity: int, most: int):
        self.leaves = 1 << max(0, most - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def place(self, n: int) -> int:
        room, at = self.room, 1
        if room[1] < n:
            raise ValueError(f"no sequence has room for {n}")
        while at < self.leaves:
            at *= 2
            if room[at] < n:
                at += 1
        found = at - self.leaves
        room[at] -= n
        while at > 1:
            at //= 2
            best = max(room[2 * at], room[2 * at + 1])
            if room[at] == best:
                break
            room[at] = best
        return found


def first_fit(lengths: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """The sequences of pieces given in descending order: each a list of (piece,
    start in the piece, length)."""
    tree = TournamentTree(capacity, len(lengths))
    out: list[list[tuple[int, int, int]]] = []
    for i, n in enumerate(lengths):
        if not 1 <= n <= capacity:
            raise ValueError(f"a piece of {n} tokens does not fit sequences of {capacity}")
        at = tree.place(n)
        if at == len(out):
            out.append([])
        out[at].append((i, 0, n))
    return out


def _power_of_two(n: int) -> bool:
    return n & (n - 1) == 0


def close_gaps(sequences: list[list[tuple[int, int, int]]], capacity: int) -> list[list[tuple[int, int, int]]]:
    """The same tokens in sequences that are full or whose length is a power of two."""
    fill = [sum(n for _, _, n in s) for s in sequences]
    open_ = [k for k, n in enumerate(fill) if n < capacity and not _power_of_two(n)]
    done = [list(s) for s in sequences]
    low, high = 0, len(open_) - 1
    while low < high:
        taker, giver = open_[low], open_[high]
        gap = capacity - fill[taker]
        piece, start, n = done[giver].pop()
        take = min(gap, n)
        done[taker].append((piece, start, take))
        if take < n:
            done[giver].append((piece, start + take, n - take))
        fill[taker] += take
        fill[giver] -= take
        if fill[taker] == capacity:
            low += 1
        if not done[giver]:
            high -= 1
    if low == high and not _power_of_two(fill[open_[low]]):
        rest, done[open_[low]] = done[open_[low]], []
        for bit in range(fill[open_[low]].bit_length() - 1, -1, -1):
            want, part = fill[open_[low]] & (1 << bit), []
            while want:
                piece, start, n = rest.pop(0)
                take = min(want, n)
                part.append((piece, start, take))
                if take < n:
                    rest.insert(0, (piece, start + take, n - take))
                want -= take
            if part:
                done.append(part)
    return [s for s in done if s]


def token_rows(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All documents as pieces of at most ``capacity`` tokens: ``row``, id, ``start``,
    ``doc_tokens`` and ``ids`` (little-endian, two bytes each if the vocabulary allows)."""
    ready(docs.sparkSession)
    schema = StructType(
        [
            StructField("row", LongType()),
            StructField(id_col, docs.schema[id_col].dataType),
            StructField("start", LongType()),
            StructField("doc_tokens", LongType()),
            StructField("ids", BinaryType()),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = word_bpe.load(tokenizer)
        kind = _id_type(max(model.size - 1, end_id))
        for rows in text_chunks(batches, text_col):
            buf, offsets = flat(rows[text_col])
            ids, at = model.encode(buf, offsets)
            total = np.diff(at) + 1  # the end token
            stream = np.full(len(ids) + len(total), end_id, kind)
            stream[np.arange(len(ids)) + np.repeat(np.arange(len(total)), total - 1)] = ids
            pieces = -(-total // capacity)
            owner = np.repeat(np.arange(len(total)), pieces)
            start = (np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * capacity
            length = np.minimum(total[owner] - start, capacity)
            ends = np.r_[0, np.cumsum(length)] * kind.itemsize
            raw = pa.Array.from_buffers(pa.large_binary(), len(owner), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(stream)])
            place = pa.array(owner)
            columns = [rows["row"].combine_chunks().take(place), rows[id_col].combine_chunks().take(place), pa.array(start), pa.array(total[owner]), raw.cast(pa.binary())]
            yield from pa.table(columns, names=schema.names).to_batches(max_chunksize=1024)

    # The row's number is taken below the other columns, which may have any name.
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col), F.col(text_col)).mapInArrow(cut, schema)


def _id_type(largest: int) -> np.dtype:
    return np.dtype("<u2" if largest < 1 << 16 else "<u4")


def pack_first_fit(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    end_id: int = 1,
    group_bytes: int = GROUP_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: id, ``start`` (tokens of the document before it), ``length``,
    ``doc_tokens``, ``ids`` (little-endian unsigned 32-bit), ``sequence_id`` and
    ``offset`` (place in the sequence, without gaps)."""
    ready(docs.sparkSession)
    pieces = token_rows(docs, tokenizer, capacity, end_id, id_col, text_col)
    schema = StructType(
        [
            pieces.schema[id_col],
            StructField("start", LongType()),
            StructField("length", LongType()),
            StructField("doc_tokens", LongType()),
            StructField("ids", BinaryType()),
            StructField("sequence_id", LongType()),
            StructField("offset", LongType()),
        ]
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _id_type(max(word_bpe.load(tokenizer).size - 1, end_id))
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        group = pa.Table.from_batches(held)
        buf, offsets = flat(group["ids"])
        ids, offsets = buf.view(kind) if len(buf) else buf.astype(kind), offsets // kind.itemsize
        length, row, start = np.diff(offsets), group["row"].to_numpy(), group["start"].to_numpy()
        order = np.lexsort((start, row, -length))
        packed = close_gaps(first_fit(length[order].tolist(), capacity), capacity)
        parts = np.array([(i, s, n, k) for k, sequence in enumerate(packed) for i, s, n in sequence], np.int64)
        sums = np.cumsum(parts[:, 2])
        first_of = np.r_[True, parts[1:, 3] != parts[:-1, 3]]
        before = sums - parts[:, 2]
        offset = before - np.maximum.accumulate(np.where(first_of, before, 0))
        base = TaskContext.get().partitionId() << 40
        named, doc_tokens = group[id_col].combine_chunks(), group["doc_tokens"].to_numpy()
        a = 0
        while a < len(parts):
            b = max(a + 1, int(np.searchsorted(sums, before[a] + OUT_IDS)))
            i, s, n, k = parts[a:b].T
            i = order[i]
            raw = ids[gather(offsets[i] + s, n)].astype("<u4")
            ends = (np.r_[0, np.cumsum(n)] * 4).astype(np.int32)
            columns = [
                named.take(pa.array(i)),
                pa.array(start[i] + s),
                pa.array(np.ascontiguousarray(n)),
                pa.array(doc_tokens[i]),
                pa.Array.from_buffers(pa.binary(), len(i), [None, pa.py_buffer(ends), pa.py_buffer(raw)]),
                pa.array(base + k),
                pa.array(offset[a:b]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)
            a = b

    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    groups = max(1, -(-size // group_bytes))
    dealt = pieces.repartition(groups, F.xxhash64("row", "start"))
    return dealt.mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The finished sequences: one row each with its token ids, ready to be padded."""
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(F.transform(ordered, lambda p: p["ids"]), F.lit(b""), lambda a, b: F.concat(a, b))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))
