import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from shipyard.llm.prefix_trie import Parentheses, _range_minima, prefix_trie, turn_sequences
from shipyard.llm.queries import rebuilt_conversations

SCHEMA = StructType(
    [
        StructField("conv_id", LongType()),
        StructField("turn", LongType()),
        StructField("role", StringType()),
        StructField("text", StringType()),
        *[StructField(c, IntegerType()) for c in ("key", "shard", "depth", "pid", "turns", "t", "h")],
    ]
)


def turns(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4, 5, 6, 7) for r in rows], SCHEMA)


def sequences_of(rows):
    held = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            h = hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest()[:32]
            held.setdefault(conv, []).append(((turn is not None, turn or 0), h, (role or "", text or "")))
    return {c: [t[2] for t in sorted(x)] for c, x in held.items()}


def brute(sequences):
    members = {}
    for conv, s in sequences.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(conv)
    rows = []
    for path, convs in members.items():
        under = [p for p in members if p[: len(path)] == path]
        children = [p for p in under if len(p) == len(path) + 1]
        leaves = [p for p in under if not any(q[:-1] == p for q in members if q)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1]) for p in under if p)
        ends = ",".join(str(c) for c in sorted(convs) if len(sequences[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        rows.append((min(convs), len(path), parent, len(convs), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(map(str, rows))


def got(frame):
    return sorted(str(tuple(r)) for r in frame.collect())


@pytest.mark.parametrize(("shards", "fan"), [(1, 1024), (7, 1024), (9, 2)])
def test_nodes_by_brute_force(spark, shards, fan):
    r = random.Random(shards)
    rows = []
    for conv in range(120):
        for turn in range(r.choice([0, 1, 2, 3, 6])):
            rows.append((conv * 7 - 50, turn if turn else None, r.choice(["user", "assistant", None]), r.choice(["a", "bé😀", "", None])))
    rows += [(1000 + k, t, "user", "same") for k in range(60) for t in range(4)]  # half of all: equal
    rows += [(5000, t, "user", f"deep {t}") for t in range(300)] + [(5001, t, "user", f"deep {t}") for t in range(250)]
    rows += [(None, 0, "user", "nobody"), (None, None, None, None), (6000, 1, "user", "twice"), (6000, 1, "user", "twice")]
    expected = brute(sequences_of(rows))
    assert got(prefix_trie(turn_sequences(turns(spark, rows)), shards=shards, fan=fan)) == expected


def test_conversations_are_rebuilt(spark):
    r = random.Random(5)
    rows = [(c, t, r.choice("ab"), r.choice("xyz")) for c in [*range(0, 130, 3), 200, 201, 305, 306] for t in range(r.choice([1, 2, 7]))]
    own = sequences_of(rows)
    h = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    rebuilt = {c: own.get(c - c % 100, [])[: h[c]] + s[h[c] :] for c, s in own.items()}
    assert any(not s for s in rebuilt.values())  # turnless ones belong to the root
    assert got(prefix_trie(rebuilt_conversations(turns(spark, rows)), shards=3)) == brute(rebuilt)


def test_no_conversations(spark):
    assert prefix_trie(turn_sequences(turns(spark, []))).count() == 0
    assert prefix_trie(turn_sequences(turns(spark, [(None, 1, "user", "x")]))).count() == 0


@pytest.mark.parametrize("block", [2, 4, 64])
def test_closing_parentheses(block):
    r = random.Random(block)
    for _ in range(100):
        depth = [0]
        for _ in range(r.randint(0, 300)):
            depth.append(r.randint(1, depth[-1] + 1) if r.random() < 0.5 else depth[-1] + 1)
        open_, expected, at = [], [0] * len(depth), 0
        for k, d in enumerate([*depth, 0]):
            while open_ and depth[open_[-1]] >= d:
                expected[open_.pop()] = at
                at += 1
            if k < len(depth):
                open_.append(k)
                at += 1
        pairs = Parentheses(np.array(depth), block)
        close = pairs.close()
        assert close.tolist() == expected
        assert pairs.opened(close).tolist() == [next((j for j in range(k + 1, len(depth)) if depth[j] <= d), len(depth)) for k, d in enumerate(depth)]


def test_least_of_ranges():
    r = np.random.default_rng(0)
    values = r.integers(0, 1000, 257)
    a, b = np.sort(r.integers(0, 257, (2, 500)), axis=0)
    assert _range_minima(values, a, b + 1).tolist() == [values[i : j + 1].min() for i, j in zip(a, b, strict=True)]
