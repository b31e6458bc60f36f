import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shipyard.llm.common import written
from shipyard.llm.crc import Crc32
from shipyard.llm.resampling import bucket_counts, ranks, resample
from tests.llm.cases import documents, empty

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@settings(max_examples=80, deadline=None)
@given(st.binary(max_size=400), st.lists(st.tuples(st.integers(0, 400), st.integers(0, 400)), max_size=20), st.sampled_from([1, 3, 16, 64]))
def test_crc_of_spans(raw, spans, block):
    buf = np.frombuffer(raw, np.uint8)
    a = np.array([min(x, len(raw)) for x, _ in spans], np.int64)
    n = np.array([min(k, len(raw) - x) for x, (_, k) in zip(a.tolist(), spans, strict=True)], np.int64)
    assert Crc32(block).spans(buf, a, n).tolist() == [zlib.crc32(raw[x : x + k]) for x, k in zip(a.tolist(), n.tolist(), strict=True)]


def features(text, least, most):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(words), [" ".join(words[i : i + n]) for n in range(least, most + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, buckets, words, least_words, share, seed):
    code = lambda f: zlib.crc32(f.encode()) % buckets
    found = [(i, *features(t, *words)) for i, t in docs]
    s, t = Counter(code(f) for _, _, fs in found for f in fs), Counter(code(f) for x in target for f in features(x, *words)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    rows = []
    for i, n, fs in found:
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[code(f)] for f in fs)
        rows.append([i, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in rows if r[1] >= least_words), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    for k, r in enumerate(able[: len(able) * share[0] // share[1]]):
        r[5] = k + 1
    return sorted(map(str, map(tuple, rows)))


@pytest.mark.parametrize("words", [(1, 1), (1, 3), (2, 2)])
def test_scores_by_brute_force(spark, words):
    docs = documents(spark)
    target = documents(spark, [(0, "One TWO three naïve café " * 9, "en", "s"), (1, None, None, None), (2, "", None, None)])
    got = resample(docs, target, share=(1, 2), buckets=101, words=words, least_words=3, seed=7)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    expected = brute(pairs, [r["text"] for r in target.collect()], 101, words, 3, (1, 2), 7)
    assert sorted(str(tuple(r)) for r in got.collect()) == expected


def test_empty_tables(spark):
    assert resample(empty(spark), documents(spark)).count() == 0
    no_target = resample(documents(spark), empty(spark), least_words=1).collect()
    assert len(no_target) == documents(spark).count() and any(r["rank"] == 1 for r in no_target)
    assert bucket_counts(empty(spark), 10).tolist() == [0] * 10


def test_ranks_of_many_ties(spark):
    rows = [(i, 5 if i % 3 else i, i) for i in range(3000)]
    scored = written(spark.createDataFrame(rows, "doc_id long, score long, other long"), "ties").repartition(7)
    got = {r["doc_id"]: r["rank"] for r in ranks(written(scored, "ties2"), "doc_id", 2500).collect()}
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    assert got == {r[0]: k + 1 if k < 2500 else None for k, r in enumerate(order)}
