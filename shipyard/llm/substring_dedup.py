"""Removal of word passages that an earlier document has, by prefix-partitioned suffix trees.

A window is ``width`` consecutive words. A window goes with that suffix inside it
whose prefix, the words up to the first uncommon one, has the least hash, so
neighbouring windows mostly travel together as one short stretch of text. The
path of a window is that suffix up to the window's end, then the words in front
of it. The first words of its path name a window's group, so equal windows always
meet. The prefix is as long as the sizes ask for: it has ``SHORTEST_PREFIX`` words, and
where the stretches of a group have more than ``GROUP_BYTES``, one word more for its
windows, and so on up to the whole window. Windows of one stretch whose prefix lies in
the suffix stay together; the others go on alone. Two passes sum the bytes: one over all
stretches, one, where a group is full, over the windows of the full groups at all lengths.
Each group sorts its suffixes into a subtree (suffix
array and common-prefix lengths, cut off at ``width`` words): the internal nodes
that deep are the repeated windows, and each learns the smallest id below it.

Documents are dealt to batches of bounded size by a hash of the row. A batch
sends each different stretch once, with its smallest id, so a passage that a
third of the corpus shares costs one entry a batch; what the groups answer goes
back to the batches, which cut the words out. Windows are judged on the input.

A null text counts as empty: no words. A null id counts as larger than any other
id, and null ids as equal to each other; rows of one id never repeat each other.
Texts shorter than a window keep everything. Repeated rows come out repeated; an
empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from shipyard.llm.bytetext import coded, copy_spans, distinct_spans, flat, gather, mix, span_hash, word_bounds
from shipyard.llm.common import ready, text_chunks, written

#: A word is common if it makes up this share of all words: at most 1 / COMMON of them.
COMMON = 1e-3
#: Words of the shortest prefix, and of the shortest window.
SHORTEST_PREFIX = 3
SHORTEST_WINDOW = 5
#: Text bytes of a batch and of a group's share of the corpus.
BATCH_BYTES = 4 << 20
#: Bytes of stretches from which on a group's prefix grows; stretches overlap, so a usual group has about three batches.
GROUP_BYTES = 16 << 20
#: Compression level of the stretches on their way to the groups.
LEVEL = 2
NO_ID = np.iinfo(np.int64).max
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


# ------------------------------------------------------------------ first pass
def word_statistics(docs: DataFrame, text_col: str, share: float = COMMON) -> DataFrame:
    """Per word hash that makes up ``share`` of some chunk: its count there; in a
    row without hash, the words and bytes of the chunk."""
    schema = StructType([StructField("word", LongType()), StructField("n", LongType()), StructField("bytes", LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in text_chunks(batches, text_col):
            buf, offsets = flat(rows[text_col])
            starts, ends, _ = word_bounds(buf, offsets)
            hashes, place, _ = coded(span_hash(buf, starts, ends))
            n = np.bincount(place, minlength=len(hashes))
            often = n >= share * len(starts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([None, *hashes[often].view(np.int64).tolist()], pa.int64()),
                    pa.array([len(starts), *n[often].tolist()], pa.int64()),
                    pa.array([len(buf), *[0] * int(often.sum())], pa.int64()),
                ],
                names=schema.names,
            )

    return docs.select(text_col).mapInArrow(count, schema)


def common_words(docs: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """(sorted hashes of the common words, text bytes of the corpus). The list has
    at most ``1 / COMMON`` entries at any size, as each is that share of all words."""
    stats = written(word_statistics(docs, text_col), "words")
    total = stats.where("word IS NULL").agg(F.sum("n").alias("n"), F.sum("bytes").alias("b")).first()
    often = stats.where("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= COMMON * (total["n"] or 0))
    return np.sort(np.array([r["word"] for r in often.select("word").collect()], np.int64).view(np.uint64)), total["b"] or 0


# ------------------------------------------------------------------- stretches
class Windows:
    """The words of a batch of documents, its windows, and the suffix that each goes with."""

    def __init__(self, texts: pa.ChunkedArray, width: int, common: np.ndarray, groups: int):
        self.width, self.groups = width, groups
        buf, offsets = flat(texts)
        starts, ends, self.first = word_bounds(buf, offsets)
        self.length = ends - starts
        self.end = np.cumsum(self.length + 1) - 1
        self.begin = self.end - self.length
        self.text = np.full(int(self.end[-1]) if len(starts) else 0, 0x20, np.uint8)
        copy_spans(self.text, self.begin, buf, starts, self.length)
        n = np.diff(self.first)
        count = np.maximum(0, n - width + 1)
        self.at = gather(self.first[:-1], count)
        #: Per window: its document, the word that its path begins at, the hash of the shortest prefix.
        self.owner = np.repeat(np.arange(len(n)), count)
        self.anchor, self.key, self.word = self.at, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        if not len(self.at):
            return
        self.word = word = span_hash(self.text, self.begin, self.end)
        order = _order(word, _among(word, common))
        self.anchor = self.at + _least_of(order, width - SHORTEST_PREFIX + 1)[self.at]
        self.key = _first_hashes(word)[self.anchor]

    def grown(self, key: np.ndarray, i: np.ndarray, length: int) -> np.ndarray:
        """The hashes of the first ``length`` words of the paths of the windows ``i``,
        from ``key``, those of one word less."""
        at = self.at[i]
        return mix(key * GOLDEN + self.word[at + (self.anchor[i] - at + length - 1) % self.width])

    def group(self, key: np.ndarray, length: int) -> np.ndarray:
        """The numbers of the groups of prefixes of ``length`` words. There are more groups
        of whole windows, since these are sent one by one, with all their words."""
        many = self.groups * (self.width if length == self.width else 1)
        return (mix(key) % np.uint64(many)).astype(np.int64) + (length - SHORTEST_PREFIX) * self.groups


class Stretches(Windows):
    """The stretches of windows that share a suffix and a group; the same documents and
    ``full`` groups always give the same stretches in the same order."""

    def __init__(self, texts: pa.ChunkedArray, width: int, common: np.ndarray, groups: int, full: np.ndarray | None, distinct: bool = True):
        super().__init__(texts, width, common, groups)
        at = self.at
        if not len(at):
            self.window = self.count = self.place = self.different = self.number = self.last = np.zeros(0, np.int64)
            return
        number = self.group(self.key, SHORTEST_PREFIX)
        i = np.flatnonzero(flagged(full, number))
        key = self.key[i]
        for length in range(SHORTEST_PREFIX + 1, width + 1):
            if not len(i):
                break
            key = self.grown(key, i, length)
            number[i] = self.group(key, length)
            if length < width:
                still = flagged(full, number[i])
                i, key = i[still], key[still]
        head = np.r_[True, (self.anchor[1:] != self.anchor[:-1]) | (self.owner[1:] != self.owner[:-1]) | (number[1:] != number[:-1])]
        cut = np.flatnonzero(head)
        #: Per stretch: its first window (a word index), its windows, its document, its group.
        self.window, self.count, self.owner = at[cut], np.diff(np.r_[cut, len(at)]), self.owner[cut]
        self.number = number[cut]
        self.last = self.window + self.count + width - 2
        self.at = self.anchor = self.key = self.word = None  # not needed any more; long texts have many
        if not distinct:
            return
        one, place = distinct_spans(self.text, self.begin[self.window], self.end[self.last])
        # The different stretches in order of their groups; ``place`` numbers them that way.
        by_group = np.argsort(self.number[one], kind="stable")
        rank = np.empty(len(one), np.int64)
        rank[by_group] = np.arange(len(one))
        self.different, self.place = one[by_group], rank[place]


def _prefix_hashes(word: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of the prefix at each word: up to the first uncommon word, at most
    ``SHORTEST_PREFIX`` words; and whether all these are common."""
    h, more = mix(word), common.copy()
    for k in range(1, SHORTEST_PREFIX):
        i = np.flatnonzero(more[: len(word) - k])
        h[i] = mix(h[i] * GOLDEN + word[i + k])
        more = np.zeros(len(word), bool)
        more[i] = common[i + k]
    return h, more


def _first_hashes(word: np.ndarray) -> np.ndarray:
    """The hash of the first ``SHORTEST_PREFIX`` words at each word, of fewer at the end."""
    h = mix(word)
    for k in range(1, min(SHORTEST_PREFIX, len(word))):
        h[:-k] = mix(h[:-k] * GOLDEN + word[k:])
    return h


def _least_of(order: np.ndarray, n: int) -> np.ndarray:
    """Where among the ``n`` ranks from each place on the first smallest one is; for the
    places that have as many."""
    least, at, size = order, np.zeros(len(order), np.int8), 1
    while size < n:  # two runs of ``size``, which overlap the last time
        step = min(size, n - size)
        lower = least[step:] < least[:-step]
        at = np.where(lower, at[step:] + np.int8(step), at[:-step])
        least = np.where(lower, least[step:], least[:-step])
        size += step
    return at


def _among(word: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Whether each hash is one of the different ``some``: tables by the low bits, one unless these clash."""
    low = np.uint64((1 << 16) - 1)
    hit, at = np.zeros(len(word), bool), (word & low).astype(np.int64)
    while len(some):
        _, one = np.unique(some & low, return_index=True)
        table = np.arange(1, (1 << 16) + 1, dtype=np.uint64)  # no hash in a free place has its low bits
        table[(some[one] & low).astype(np.int64)] = some[one]
        hit |= table[at] == word
        some = np.delete(some, one)
    return hit


def _order(word: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The rank of the prefix at each word, by hash; those of common words alone come last."""
    h, all_common = _prefix_hashes(word, common)
    return (mix(h ^ np.uint64(0xA24BAED4963EE407)) >> np.uint64(1)) | (all_common.astype(np.uint64) << np.uint64(63))


def flagged(bits: np.ndarray | None, number: np.ndarray) -> np.ndarray:
    """Whether the bit of each number is set."""
    if bits is None:
        return np.zeros(len(number), bool)
    return (bits[number >> 3] >> (number & 7).astype(np.uint8)) & np.uint8(1) > 0


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    return pc.fill_null(column.cast(pa.int64()), NO_ID).to_numpy()


def _sealed(**columns: np.ndarray | pa.Array) -> bytes:
    batch = pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=LEVEL))) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _opened(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()


def _binary(text: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = np.r_[0, np.cumsum(lengths)].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(text[gather(starts, lengths)])])


# ---------------------------------------------------------------------- groups
def group_sizes(docs: DataFrame, text_col: str, width: int, common: np.ndarray, groups: int, full: np.ndarray | None) -> DataFrame:
    """``number`` and ``bytes`` of the groups of the shortest prefix, or, given the full ones
    of these, of the groups of all longer prefixes of their windows. Equal stretches count
    each time, and windows at all lengths, so no group gets more."""
    schema = StructType([StructField("number", LongType()), StructField("bytes", LongType())])

    def sums(number: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
        each, place = np.unique(number, return_inverse=True)
        total = np.bincount(place, weights=size, minlength=len(each)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(each), pa.array(total)], names=schema.names)

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in text_chunks(batches, text_col):
            if full is None:
                s = Stretches(rows[text_col], width, common, groups, None, distinct=False)
                yield sums(s.number, s.end[s.last] - s.begin[s.window])
                continue
            w = Windows(rows[text_col], width, common, groups)
            i = np.flatnonzero(flagged(full, w.group(w.key, SHORTEST_PREFIX)))
            key, size = w.key[i], w.end[w.at[i] + width - 1] - w.begin[w.at[i]]
            for length in range(SHORTEST_PREFIX + 1, width):
                key = w.grown(key, i, length)
                yield sums(w.group(key, length), size)

    return docs.select(text_col).mapInArrow(sizes, schema).groupBy("number").agg(F.sum("bytes").alias("bytes"))


def full_groups(docs: DataFrame, text_col: str, width: int, common: np.ndarray, groups: int, limit: int) -> np.ndarray | None:
    """One bit for each group whose prefix has to grow, being of more than ``limit``
    bytes; None if there is none. That is ``width - SHORTEST_PREFIX`` bits for each
    ``BATCH_BYTES`` of the corpus: 32 MB at 100 TB for windows of 13 words."""
    numbers: list[int] = []
    bits = None
    for _ in range(2):
        sizes = group_sizes(docs, text_col, width, common, groups, bits)
        numbers += [r["number"] for r in sizes.where(F.col("bytes") > limit).select("number").collect()]
        if not numbers:
            return None
        flags = np.zeros((width - SHORTEST_PREFIX) * groups, bool)
        flags[numbers] = True
        bits = np.packbits(flags, bitorder="little")
    return bits


def stretches_sent(dealt: DataFrame, send, schema: StructType) -> DataFrame:
    """One row for each batch and group with the different stretches that the batch has for it."""
    return dealt.groupBy("batch").applyInArrow(send, schema)


# --------------------------------------------------------------------- subtree
def deep_nodes(words: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The internal nodes at depth ``width`` of the subtree over the suffixes that
    begin at ``at`` in the word numbers ``words``: (suffixes in tree order, index
    of each node's first suffix therein). Suffixes without a partner are left out."""
    path = np.zeros(len(at), np.uint64)
    for k in range(width):
        path = path * GOLDEN + words[at + k].astype(np.uint64) + np.uint64(1)
    _, place, _ = coded(path)
    some = np.flatnonzero(np.bincount(place)[place] > 1)  # a path that occurs once ends in a leaf
    if not len(some):
        return some, some
    each = int(63 // max(1, int(words.max()).bit_length()))
    keys = []
    for k in range(0, width, each):
        key = np.zeros(len(some), np.uint64)
        for j in range(k, min(k + each, width)):
            key = key * np.uint64(int(words.max()) + 1) + words[at[some] + j].astype(np.uint64)
        keys.append(key)
    order = np.lexsort(keys[::-1])
    differs = np.zeros(len(some), bool)
    differs[0] = True
    for key in keys:
        sorted_key = key[order]
        differs[1:] |= sorted_key[1:] != sorted_key[:-1]  # the common prefix is shorter than the width
    return some[order], np.flatnonzero(differs)


def remove_repeats(docs: DataFrame, width: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its integer id, ``n_words``, ``n_removed``, and
    ``kept_text``, the words left, joined by one blank."""
    if width < SHORTEST_WINDOW:
        raise ValueError(f"windows must be longer than {SHORTEST_WINDOW - 1} words")
    spark = ready(docs.sparkSession)
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    common, size = common_words(plain, "text")
    groups = max(1, -(-size // BATCH_BYTES))
    spread = max(groups, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = plain.withColumn("batch", F.pmod(F.xxhash64("id", "text"), F.lit(spread)).cast("int")).repartition("batch")

    sent_schema = StructType([StructField("number", LongType()), StructField("batch", IntegerType()), StructField("first", LongType()), StructField("blob", BinaryType())])
    back_schema = StructType([StructField("batch", IntegerType()), StructField("first", LongType()), StructField("blob", BinaryType())])
    out_schema = StructType([StructField(id_col, LongType()), StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept_text", StringType())])

    def in_order(rows: pa.Table) -> pa.Table:
        return rows.sort_by([("id", "ascending"), ("text", "ascending")])

    def send(rows: pa.Table) -> pa.Table:
        batch = rows["batch"][0].as_py()
        rows = in_order(rows)
        s = Stretches(rows["text"], width, common, spread, full)
        out = []
        if len(s.window):
            ids = _ids(rows["id"])[s.owner]
            least = np.full(len(s.different), NO_ID)
            np.minimum.at(least, s.place, ids)
            one = s.different
            group = s.number[one]
            cuts = np.r_[np.flatnonzero(np.r_[True, group[1:] != group[:-1]]), len(group)]
            a, b = s.begin[s.window[one]], s.end[s.last[one]]
            for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                text = _binary(s.text, a[i:j], (b - a)[i:j])
                out.append((int(group[i]), batch, i, _sealed(text=text, n=s.count[one[i:j]].astype(np.uint8), id=least[i:j])))
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.binary())], names=sent_schema.names)

    def answer(rows: pa.Table) -> pa.Table:
        parts = [_opened(b.as_py()) for b in rows["blob"]]
        base = np.cumsum([0, *[len(p) for p in parts]])
        entries = pa.concat_tables(parts)
        del parts
        n, id_of = entries["n"].to_numpy().astype(np.int64), entries["id"].to_numpy()
        buf, offsets = flat(entries["text"])
        starts, ends, first = word_bounds(buf, offsets)
        words = distinct_spans(buf, starts, ends)[1].astype(np.int32)
        del entries, buf, offsets, starts, ends
        at, entry = gather(first[:-1], n), np.repeat(np.arange(len(n)), n)
        ids = id_of[entry]
        leaves, node = deep_nodes(words, at, width)
        out = []
        if len(leaves):
            lowest = np.repeat(np.minimum.reduceat(ids[leaves], node), np.diff(np.r_[node, len(leaves)]))
            lower = ids[leaves] > lowest
            hit, lowest = leaves[lower], lowest[lower]
            in_order = np.argsort(hit)
            hit, lowest = hit[in_order], lowest[in_order]
            cuts = np.searchsorted(entry[hit], base)
            for k in np.flatnonzero(np.diff(cuts)):
                i, j = cuts[k], cuts[k + 1]
                e = entry[hit[i:j]]
                blob = _sealed(entry=(e - base[k]).astype(np.int32), window=(at[hit[i:j]] - first[e]).astype(np.uint8), id=lowest[i:j])
                out.append((rows["batch"][int(k)].as_py(), rows["first"][int(k)].as_py(), blob))
        columns = list(zip(*out, strict=True)) or [[], [], []]
        return pa.table([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary())], names=back_schema.names)

    def cut_out(rows: pa.Table, answers: pa.Table) -> pa.Table:
        rows = in_order(rows)
        s = Stretches(rows["text"], width, common, spread, full)
        removed = np.zeros(len(s.begin) + 1, np.int64)
        if len(s.window):
            # The smallest id of each window of each different stretch: here, then anywhere.
            own = _ids(rows["id"])[s.owner]
            least = np.full(len(s.different), NO_ID)
            np.minimum.at(least, s.place, own)
            n = s.count[s.different]
            base = np.cumsum(n) - n
            lowest = np.repeat(least, n)
            for first, blob in zip(answers["first"].to_pylist(), answers["blob"], strict=True):
                got = _opened(blob.as_py())
                lowest[base[first + got["entry"].to_numpy()] + got["window"].to_numpy()] = got["id"].to_numpy()
            at = gather(s.window, s.count)
            gone = lowest[gather(base[s.place], s.count)] < np.repeat(own, s.count)
            np.add.at(removed, at[gone], 1)
            np.add.at(removed, at[gone] + width, -1)
        keep = np.cumsum(removed)[:-1] == 0
        kept = np.r_[0, np.cumsum(keep)][s.first]
        length = s.length[keep]
        # Words with a blank after each; a document's last blank is left out.
        stop = np.cumsum(length + 1)
        text = np.full(int(stop[-1]) if len(stop) else 0, 0x20, np.uint8)
        copy_spans(text, stop - length - 1, s.text, s.begin[keep], length)
        edge = np.r_[0, stop][kept]
        if len(text):
            last = np.zeros(len(text), bool)
            last[edge[1:][np.diff(kept) > 0] - 1] = True
            text = text[~last]
        ends = edge - np.r_[0, np.cumsum(np.diff(kept) > 0)]
        out = pa.Array.from_buffers(pa.large_utf8(), len(rows), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(text))]).cast(pa.utf8())
        n_words = np.diff(s.first)
        return pa.table([rows["id"].combine_chunks(), pa.array(n_words), pa.array(n_words - np.diff(kept)), out], names=out_schema.names)

    full = full_groups(plain, "text", width, common, spread, GROUP_BYTES)
    back = stretches_sent(dealt, send, sent_schema).groupBy("number").applyInArrow(answer, back_schema)
    return dealt.groupBy("batch").cogroup(back.groupBy("batch")).applyInArrow(cut_out, out_schema)
