import numpy as np
import pytest

from shipyard.llm import embedding_dedup, topk
from shipyard.llm.embedding_dedup import near_duplicates, rotated, unit_rows
from shipyard.llm.topk import top_k
from tests.llm.test_graph import roots

SCHEMA = "vec_id long, embedding array<float>, label int, node string, n string, v string, row string, norm string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "a", "b", "c", "d", "e") for i, v in rows], SCHEMA)


def planted(n=260, d=16, seed=0):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        if out and rng.random() < 0.6:
            base = np.array(out[rng.integers(len(out))])
            out.append((base + rng.normal(size=d) * rng.choice([0, 0.02, 0.06, 0.1]) * np.linalg.norm(base)).astype(np.float32).tolist())
        else:
            out.append((rng.normal(size=d) * rng.choice([0.1, 1, 30])).astype(np.float32).tolist())
    return [(int(i), v) for i, v in zip(rng.permutation(3 * n)[:n], out, strict=True)]


AWKWARD = [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16), (1003, [float("inf")] + [1.0] * 15), (1004, [None] * 16), (1005, []), (1006, [1.0, 2.0]), (1007, [2.0, 4.0]), (None, [1.0] * 16), (1008, [3.0])]


def usable(i, v, zero=False):
    return i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and (zero or any(v))


def links(rows, limit):
    fine = [(k, np.array(v, np.float64)) for k, (i, v) in enumerate(rows) if usable(i, v)]
    return [(a, b) for p, (a, x) in enumerate(fine) for b, y in fine[p + 1 :] if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= limit]


@pytest.mark.parametrize(("d", "chunk"), [(16, 16_384), (16, 20), (5, 30)])
def test_near_duplicates_by_brute_force(spark, monkeypatch, d, chunk):
    monkeypatch.setattr(embedding_dedup, "CHUNK_NUMBERS", chunk * d)
    rows = planted(d=d, seed=d + chunk) + AWKWARD
    rows += rows[:3]  # repeated rows
    found = links(rows, 0.95)
    assert len(found) > 100
    of = roots([(rows[a][0], rows[b][0]) for a, b in found])
    n = [0] * len(rows)
    for a, b in found:
        n[a] += 1
        n[b] += 1
    want = sorted(((i, n[k], of.get(i, i), i is not None and of.get(i, i) == i) for k, (i, _) in enumerate(rows)), key=str)
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in near_duplicates(frame(spark, rows)).collect()), key=str)
    assert got == want


def test_doubles_are_compared_as_doubles(spark):
    """Cosines a billionth above and below the limit, which floats cannot tell apart."""
    rows = [(2 * k + j, v) for k, (c, s) in enumerate([(0.95 + 1e-9, 1), (0.95 - 1e-9, -1)]) for j, v in enumerate([[1.0, 0.0], [c, s * float(np.sqrt(1 - c * c))]])]
    rows = [(i, [x * (1 if i < 2 else -1) for x in v]) for i, v in rows]
    found = links(rows, 0.95)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_duplicates(df).collect()}
    assert [(rows[a][0], rows[b][0]) for a, b in found] == [(0, 1)]
    assert got == {0: (1, 0), 1: (1, 0), 2: (0, 2), 3: (0, 3)}


def test_empty_vectors(spark):
    assert near_duplicates(frame(spark, [])).count() == 0
    assert top_k(frame(spark, []), top_k_queries()).count() == 0


def top_k_queries(every=7):
    from pyspark.sql import functions as F

    return F.col("id") % every == 0


def test_rotation_keeps_distances():
    x = unit_rows(np.random.default_rng(3).normal(size=(40, 11)))
    y = rotated(x)
    assert np.allclose(x @ x.T, y @ y.T)
    assert (rotated(x[5:9]) == y[5:9]).all()


@pytest.mark.parametrize("block", [16_384, 40])
def test_top_k_by_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK_BYTES", 8 * 16 * block)
    monkeypatch.setattr(topk, "QUERIES", 13 if block < 100 else 2048)
    monkeypatch.setattr(topk, "STEP", 16)
    rows = planted(seed=block) + [(2000 + i, [0.5] * 16) for i in range(90)] + AWKWARD
    rows += rows[:2]
    whole = [(k, i, np.floor(64 * np.array(v, np.float64)).astype(np.int64)) for k, (i, v) in enumerate(rows) if usable(i, v, zero=True)]
    want = []
    for k, i, q in whole:
        if i % 7 == 0:
            best = sorted((-int(q @ c), j) for m, j, c in whole if m != k and len(c) == len(q))[:20]
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in top_k(frame(spark, rows), top_k_queries()).collect()]
    assert sorted(got) == sorted(want)


def test_top_k_of_an_empty_vector(spark):
    """Empty vectors meet each other, also where one is a query."""
    rows = [(7, []), (14, [1.0, 2.0]), (20, []), (21, [3.0, 1.0])]
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in top_k(frame(spark, rows), top_k_queries()).collect())
    assert got == [(7, 1, 20, 0), (14, 1, 21, 5 * 64 * 64), (21, 1, 14, 5 * 64 * 64)]


def test_candidates_reach_few_groups(spark, monkeypatch):
    """Where lengths differ, a candidate goes only to the query groups that it can reach."""
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=8) * 2.0 ** (i % 12)).astype(np.float32).tolist()) for i in range(600)]
    monkeypatch.setattr(topk, "BLOCK_BYTES", 8 * 8 * 64)
    monkeypatch.setattr(topk, "QUERIES", 10)
    sent = []
    plain = topk.reaches
    monkeypatch.setattr(topk, "reaches", lambda needs, steps: sent.append((plain(needs, steps).collect(), steps.collect())) or plain(needs, steps))
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in top_k(frame(spark, rows), top_k_queries()).collect())
    whole = {i: np.floor(64 * np.array(v, np.float64)).astype(np.int64) for i, v in rows}
    want = []
    for q in range(0, 600, 7):
        best = sorted((-int(whole[q] @ c), j) for j, c in whole.items() if j != q)[:20]
        want += [(q, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    assert got == sorted(want)
    needs, steps = sent[0]
    last = max(r["range"] for r in steps)
    assert last >= 7 and sum(r["n"] for r in needs) == 86
    assert sum(r["n"] * (r["reach"] + 1) for r in needs) < 0.5 * 86 * (last + 1)


def test_tasks_grow_with_the_pairs_compared(spark, monkeypatch):
    """Chunks are dealt to tasks by the pairs they hold, not by their bytes: no task's share grows with the data."""
    rng = np.random.default_rng(4)
    rows = [(i, int(1), rng.normal(size=8).tolist()) for i in range(400)]
    classes = spark.createDataFrame(rows, "node long, n long, v array<float>")
    monkeypatch.setattr(embedding_dedup, "CHUNK_NUMBERS", 8 * 40)
    few = embedding_dedup._links(classes.where("node < 100"), 0.95, 4).rdd.getNumPartitions()
    many = embedding_dedup._links(classes, 0.95, 4).rdd.getNumPartitions()
    assert many > 8 * few / 2 and many > 50


def test_vectors_are_on_disk_once_and_strips_are_not_shuffled(spark, monkeypatch):
    """However many strips a vector meets, it is written once; pairs of strips come from files."""
    rng = np.random.default_rng(5)
    rows = [(i, 1, rng.normal(size=8).tolist()) for i in range(400)]
    classes = spark.createDataFrame(rows, "node long, n long, v array<float>")
    monkeypatch.setattr(embedding_dedup, "CHUNK_NUMBERS", 8 * 40)
    strips = embedding_dedup._strips(classes, 4).collect()
    held = [np.frombuffer(s["node"], np.int64).tolist() for s in strips]
    assert sorted(sum(held, [])) == list(range(400)) and max(map(len, held)) == 5
    assert all(len(s["v"]) == 4 * 8 * len(k) for s, k in zip(strips, held, strict=True))
    plan = embedding_dedup._links(classes, 0.95, 4)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Exchange" not in plan


def test_pairs_of_a_strip_with_itself_come_once():
    x = unit_rows(np.random.default_rng(6).normal(size=(300, 6)))
    pairs = [(p.tolist(), q.tolist()) for p, q in embedding_dedup.strip_links(x, x, True, 0.9)]
    got = sorted((a, b) for p, q in pairs for a, b in zip(p, q, strict=True))
    assert got == [(a, b) for a in range(300) for b in range(a + 1, 300) if (x[a] * x[b]).sum() >= 0.9]


def test_zeros_of_both_signs_are_equal(spark):
    rows = [(1, [0.0, 1.0, 2.0]), (2, [-0.0, 1.0, 2.0]), (3, [0.0, -1.0, 2.0])]
    got = sorted(tuple(r) for r in near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect())
    assert got == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
