"""CRC-32 of many byte spans at once.

The CRC is linear over XOR: a byte with d bytes after it in its span contributes
``table[d][byte]``, wherever the span stands, and the length adds a constant. So
the CRCs of all spans are one look-up per byte and one ``bitwise_xor.reduceat``.
The table holds distances below ``BLOCK``. A longer span is cut into blocks from
its end; the XOR of a block is moved over the blocks behind it, two neighbours
at a time, by tables for a shift by 1, 2, 4, ... blocks.
"""

from __future__ import annotations

import numpy as np

from shipyard.llm.bytetext import gather

#: The reversed polynomial of CRC-32 (a fixed value).
POLYNOMIAL = 0xEDB88320
#: Distances from the end that the position table covers.
BLOCK = 64
#: Spans looked up at a time: at most this many blocks of bytes.
PART = 1 << 16


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


def _next(state: np.ndarray, bytes_table: np.ndarray) -> np.ndarray:
    """The state after one zero byte."""
    return (state >> np.uint32(8)) ^ bytes_table[state & np.uint32(0xFF)]


class Crc32:
    def __init__(self, block: int = BLOCK):
        self.block = block
        self.bytes = _byte_table()
        self.positions = np.empty((block, 256), np.uint32)
        state = self.bytes
        for d in range(block):
            self.positions[d] = state
            state = _next(state, self.bytes)
        # shifts[j][k][b]: byte k of a state, moved over 2**j blocks of zeros.
        one = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
        for _ in range(block):
            one = _next(one, self.bytes)
        self.shifts = [one]
        # The CRC of n zero bytes: what the length alone gives, for lengths within a block.
        self.zeros = np.empty(block + 1, np.uint32)
        state = np.uint32(0xFFFFFFFF)
        for n in range(block + 1):
            self.zeros[n] = ~state
            state = _next(state, self.bytes)

    def _shift(self, j: int) -> np.ndarray:
        while len(self.shifts) <= j:
            half = self.shifts[-1]
            self.shifts.append(self._moved(half, half))
        return self.shifts[j]

    @staticmethod
    def _moved(state: np.ndarray, shift: np.ndarray) -> np.ndarray:
        out = shift[0][state & np.uint32(0xFF)]
        for k in (1, 2, 3):
            out = out ^ shift[k][(state >> np.uint32(8 * k)) & np.uint32(0xFF)]
        return out

    def _constants(self, lengths: np.ndarray) -> np.ndarray:
        """The CRC of as many zero bytes as each span has."""
        whole, rest = lengths // self.block, lengths % self.block
        state = ~self.zeros[rest]
        j = 0
        while (whole >> j).any():
            odd = ((whole >> j) & 1).astype(bool)
            state[odd] = self._moved(state[odd], self._shift(j))
            j += 1
        return ~state

    def _reduced(self, buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """XOR of the contributions of spans of 1 to ``block`` bytes."""
        at = gather(starts, lengths)
        first = np.cumsum(lengths) - lengths
        distance = np.repeat(first + lengths, lengths) - 1 - np.arange(len(at))
        return np.bitwise_xor.reduceat(self.positions[distance, buf[at]], first)

    def spans(self, buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The CRC-32 of every span of ``buf``; spans may overlap, be empty, and come in any order."""
        out = self._constants(lengths)
        if not len(lengths):
            return out
        short = np.flatnonzero((lengths > 0) & (lengths <= self.block))
        for a in range(0, len(short), PART):
            part = short[a : a + PART]
            out[part] ^= self._reduced(buf, starts[part], lengths[part])
        long = np.flatnonzero(lengths > self.block)
        if len(long):
            out[long] ^= self._folded(buf, starts[long], lengths[long])
        return out

    def _folded(self, buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        # Blocks of a span, the last one first: block k ends k blocks before the span does.
        blocks = -(-lengths // self.block)
        owner = np.repeat(np.arange(len(lengths)), blocks)
        k = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        end = (starts + lengths)[owner] - k * self.block
        begin = np.maximum(end - self.block, starts[owner])
        value = np.empty(len(owner), np.uint32)
        for a in range(0, len(owner), PART):
            part = slice(a, a + PART)
            value[part] = self._reduced(buf, begin[part], (end - begin)[part])
        j = 0
        while len(value) > len(lengths):
            # Neighbours 2k and 2k + 1 meet; the one further from the end moves over 2**j blocks.
            odd = (k & 1).astype(bool)
            value[odd] = self._moved(value[odd], self._shift(j))
            pair = np.flatnonzero(odd)
            value[pair - 1] ^= value[pair]
            owner, k, value = owner[~odd], k[~odd] >> 1, value[~odd]
            j += 1
        return value
