"""XXH64 (the published algorithm) over many byte spans at once, in numpy."""

from __future__ import annotations

import numpy as np

# Fixed values of the algorithm: its five primes.
P1 = np.uint64(11400714785074694791)
P2 = np.uint64(14029467366897019727)
P3 = np.uint64(1609587929392839161)
P4 = np.uint64(9650029242287828579)
P5 = np.uint64(2870177450012600261)


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotl(acc + lane * P2, 31) * P1


def xxh64(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """The hash of ``buf[starts[i]:ends[i]]`` for every i."""
    with np.errstate(over="ignore"):
        return _xxh64(np.r_[buf, np.zeros(8, np.uint8)], starts, (ends - starts).astype(np.int64), np.uint64(seed))


def _xxh64(buf: np.ndarray, starts: np.ndarray, n: np.ndarray, seed: np.uint64) -> np.ndarray:
    eight = np.ndarray((len(buf) - 7,), "<u8", buf, strides=(1,))
    four = np.ndarray((len(buf) - 3,), "<u4", buf, strides=(1,))
    h = np.full(len(starts), seed + P5, np.uint64)
    p, left = starts.copy(), n.copy()

    big = np.flatnonzero(n >= 32)
    if len(big):
        acc = [np.full(len(big), x, np.uint64) for x in (seed + P1 + P2, seed + P2, seed, seed - P1)]
        live = np.arange(len(big))
        while len(live):
            at = p[big[live]]
            for k in range(4):
                acc[k][live] = _round(acc[k][live], eight[at + 8 * k])
            p[big[live]] += 32
            left[big[live]] -= 32
            live = live[left[big[live]] >= 32]
        joined = _rotl(acc[0], 1) + _rotl(acc[1], 7) + _rotl(acc[2], 12) + _rotl(acc[3], 18)
        for k in range(4):
            joined = (joined ^ _round(np.zeros(len(big), np.uint64), acc[k])) * P1 + P4
        h[big] = joined
    h += n.astype(np.uint64)

    for _ in range(3):
        i = np.flatnonzero(left >= 8)
        if not len(i):
            break
        h[i] = _rotl(h[i] ^ _round(np.zeros(len(i), np.uint64), eight[p[i]]), 27) * P1 + P4
        p[i] += 8
        left[i] -= 8
    i = np.flatnonzero(left >= 4)
    if len(i):
        h[i] = _rotl(h[i] ^ (four[p[i]].astype(np.uint64) * P1), 23) * P2 + P3
        p[i] += 4
        left[i] -= 4
    for _ in range(3):
        i = np.flatnonzero(left >= 1)
        if not len(i):
            break
        h[i] = _rotl(h[i] ^ (buf[p[i]].astype(np.uint64) * P5), 11) * P1
        p[i] += 1
        left[i] -= 1
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    return h ^ (h >> np.uint64(32))
