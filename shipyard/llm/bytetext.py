"""Whole columns of text as flat byte arrays: word boundaries and hashes in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: ASCII white space, the complement of the word class ``[^\x20\x09-\x0D]``.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def flat(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[off[0] : off[-1]], off - off[0]


def word_bounds(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and per document the index of its first word
    (one entry more than documents)."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = ~SPACE[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offsets] = True  # a document begins
    before = np.r_[False, solid[:-1]]
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    ends = np.flatnonzero(solid & (np.r_[~solid[1:], True] | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n + 1:
        for k, x in enumerate((_BASE, _INVERSE)):
            steps = np.full(max(n, 1 << 16) + 1, x, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def span_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans (ascending starts); equal bytes give equal
    hashes wherever they stand. Unequal bytes may collide: compare with ``same_spans``."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + (1 << 20))))
        low, high = int(starts[i]), int(ends[i:j].max())
        power, inverse = _power_tables(high - low)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum((buf[low:high].astype(np.uint64) + np.uint64(1)) * power[: high - low], out=sums[1:])
        s, e = starts[i:j] - low, ends[i:j] - low
        out[i:j] = (sums[e] - sums[s]) * inverse[s]
        i = j
    return mix(out ^ (ends - starts).astype(np.uint64))


def coded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct values in the order in which they come, for each value its place
    therein, the index at which each comes first); by hash tables, without a sort."""
    codes = pa.array(values).dictionary_encode()
    distinct, place = codes.dictionary.to_numpy(zero_copy_only=False), codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    # A value is new where its place is larger than all before.
    new = np.r_[True, np.maximum.accumulate(place[:-1]) < place[1:]] if len(place) else np.zeros(0, bool)
    return distinct, place, np.flatnonzero(new)


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all elements of the spans, one span after the other."""
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - first, lengths)


def copy_spans(to: np.ndarray, at: np.ndarray, buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
    """Copies span k of ``buf`` to place ``at[k]`` of ``to``, some thousand spans at a
    time: the indices of all bytes of a long text would take 50 times its size."""
    for i in range(0, len(starts), 1 << 15):
        some = slice(i, i + (1 << 15))
        to[gather(at[some], lengths[some])] = buf[gather(starts[some], lengths[some])]


def same_spans(buf: np.ndarray, a: np.ndarray, b: np.ndarray, lengths_a: np.ndarray, lengths_b: np.ndarray) -> np.ndarray:
    """Whether the bytes of span k of ``a`` equal those of span k of ``b``."""
    same = lengths_a == lengths_b
    look = np.flatnonzero(same & (a != b) & (lengths_a > 0))
    sums = np.cumsum(lengths_a[look])
    i = 0
    while i < len(look):  # a million bytes at a time
        j = max(i + 1, int(np.searchsorted(sums, (sums[i - 1] if i else 0) + (1 << 20), "right")))
        part = look[i:j]
        n = lengths_a[part]
        differs = buf[gather(a[part], n)] != buf[gather(b[part], n)]
        if differs.any():
            same[part[np.repeat(np.arange(len(n)), n)[differs]]] = False
        i = j
    return same


def _ends_of(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last 8 bytes of each span as numbers; together with the
    length they hold every byte of spans up to 16 bytes."""
    padded = np.r_[np.zeros(8, np.uint8), buf, np.zeros(8, np.uint8)]
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    n = np.minimum(ends - starts, 8)
    masks = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    return eight[starts + 8] & masks[n], eight[ends] & ~masks[8 - n]


def distinct_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of one span of each distinct byte string, for each span its place
    therein). Spans are told apart by their bytes; the hash only sorts them."""
    n = ends - starts
    head, tail = _ends_of(buf, starts, ends)
    h = mix(head ^ (n.astype(np.uint64) << np.uint64(57))) ^ (tail * np.uint64(0x9E3779B97F4A7C15))
    long = np.flatnonzero(n > 16)
    if len(long):
        h[long] ^= span_hash(buf, starts[long], ends[long])
    _, place, first = coded(h)
    rep = first[place]
    same = (n == n[rep]) & (head == head[rep]) & (tail == tail[rep])
    if len(long):
        same[long] &= same_spans(buf, starts[long], starts[rep[long]], n[long], n[rep[long]])
    if not same.all():
        seen: dict[bytes, int] = {}
        extra = []
        for i in np.flatnonzero(~same):
            key = buf[starts[i] : ends[i]].tobytes()
            if key not in seen:
                seen[key] = len(first) + len(extra)
                extra.append(i)
            place[i] = seen[key]
        first = np.r_[first, extra]
    return first, place
