import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from shipyard.llm import simhash
from shipyard.llm.bytetext import flat
from shipyard.llm.simhash import BASE, near_duplicates, near_links, segments_of, shingle_fingerprints, steps_within
from shipyard.llm.xxh import xxh64
from tests.llm.cases import TEXTS, documents, empty
from tests.llm.test_graph import roots


def fingerprint(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=150), max_size=20), st.integers(0, 2**32))
def test_xxh64(spans, seed):
    ends = np.cumsum([len(x) for x in spans], dtype=np.int64)
    starts = ends - np.array([len(x) for x in spans], np.int64)
    got = xxh64(np.frombuffer(b"".join(spans), np.uint8), starts, ends, seed)
    assert got.tolist() == [xxhash.xxh64_intdigest(x, seed) for x in spans]


def test_fingerprints_by_brute_force():
    texts = [t for _, t, *_ in TEXTS if t is None or len(t) < 10_000] + ["A b", "word", "Ä Ö ü É", "a b c a b c a b c"]
    got = shingle_fingerprints(*flat(pa.array(texts)))
    assert got.tolist() == [fingerprint(t) for t in texts]


def test_embedding_bounds_the_bits():
    rng = random.Random(1)
    for segments in (2, 5, 8):
        masks = segments_of(segments)
        assert sum(masks) == 2**64 - 1
        steps = set(steps_within(3, segments))
        for _ in range(300):
            a = rng.getrandbits(64)
            b = a
            for bit in rng.sample(range(64), rng.randrange(4)):
                b ^= 1 << bit
            cell = [sum((x & m).bit_count() * BASE**k for k, m in enumerate(masks)) for x in (a, b)]
            assert abs(cell[0] - cell[1]) in steps


@pytest.mark.parametrize(("owners", "piece"), [(65_536, 1 << 18), (3, 20), (1, 1)])
def test_links_find_every_component(spark, monkeypatch, owners, piece):
    """Also where cells are cut into chunks and guests come in pieces."""
    monkeypatch.setattr(simhash, "OWNERS", owners)
    monkeypatch.setattr(simhash, "PIECE", piece)
    monkeypatch.setattr(simhash, "BLOCK", 4 if owners < 5 else 2048)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000" if owners > 5 else "7")
    rng = random.Random(5)
    prints = [rng.getrandbits(64) for _ in range(150)] + [0, 1, 2**64 - 1, 2**63]
    for p in prints[:60]:
        for _ in range(4):
            q = p
            for bit in rng.sample(range(64), rng.choice([1, 2, 3, 4, 5])):
                q ^= 1 << bit
            prints.append(q)
    prints = sorted({p - 2**64 if p >= 2**63 else p for p in prints})
    links = [(r["u"], r["v"]) for r in near_links(spark.createDataFrame([(p,) for p in prints], "fp long")).collect()]
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    near = [(a, b) for i, a in enumerate(prints) for b in prints[i + 1 :] if ((a ^ b) % 2**64).bit_count() <= 3]
    assert all(((a ^ b) % 2**64).bit_count() <= 3 for a, b in links)
    assert roots(links) == roots(near) and len(near) > 100


def test_near_duplicates(spark):
    got = near_duplicates(documents(spark)).collect()
    assert len(got) == len(TEXTS)
    prints = [(i, fingerprint(t)) for i, t, *_ in TEXTS]
    assert sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["fp"] % 2**64) for r in got)) == sorted((i is None, i or 0, p) for i, p in prints)
    of = roots([(a, b) for _, a in prints for _, b in prints if (a ^ b).bit_count() <= 3])
    least = {}
    for i, p in prints:
        if i is not None:
            least[of[p]] = min(i, least.get(of[p], i))
    for r in got:
        assert r["component_id"] == least.get(of[r["fp"] % 2**64])
    assert near_duplicates(empty(spark)).count() == 0


def test_many_copies_are_one_class(spark):
    text = " ".join(f"t{i}" for i in range(200))
    texts = [(i, text if i % 3 else f"{text} more{i}", "en", "s") for i in range(600)]
    got = near_duplicates(documents(spark, texts)).collect()
    copies = {r["component_id"] for r in got if r["doc_id"] % 3}
    assert len(copies) == 1
