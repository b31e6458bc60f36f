import random
import zlib

import numpy as np

from shipyard.llm.quality import BINS, FOURIER, ORDER_SHARE, RIDGE, document_statistics, fit, isotonic, quality_scores, scored, statistics, to_fit
from tests.llm.cases import TEXTS, documents, empty


def pooled(s, n, at):
    """Isotonic regression by its max-min formula: the means of all runs of bins, nothing merged step by step."""
    k = range(len(s))
    fitted = [max(min(s[a : b + 1].sum() / n[a : b + 1].sum() for b in k if b >= i) for a in k if a <= i) for i in k]
    groups = [[i for i in k if abs(fitted[i] - v) < 1e-12] for v in sorted(set(np.round(fitted, 12)))]
    return np.array([(at[g] * n[g]).sum() / n[g].sum() for g in groups]), np.array([fitted[g[0]] for g in groups])


def test_isotonic_by_brute_force():
    rng = np.random.default_rng(2)
    joined = 0
    for _ in range(60):
        n = rng.integers(1, 6, 8).astype(float)
        s = rng.integers(0, n + 1).astype(float)
        at = np.sort(rng.random(8))
        knots, values = isotonic(s, n, at)
        want = pooled(s, n, at)
        assert np.allclose(knots, want[0]) and np.allclose(values, want[1])
        joined += len(knots) < 8
    assert joined > 30


def test_scores_by_brute_force(spark):
    """Ridge as least squares over all rows at once, the calibration by the formula above."""
    docs, labels = table(spark, noise=6)
    of = {r["doc_id"]: np.array(r["x"]) for r in document_statistics(docs).collect()}
    y = {r["doc_id"]: r["quality"] for r in labels.collect()}
    part = {i: zlib.crc32(str(i).encode()) % 3 for i in of}
    model = fit(document_statistics(docs), labels)
    x0, y0 = (np.array([v[i] for i in of if part[i] == 0], float) for v in (of, y))
    center, scale = x0.mean(axis=0), x0.std(axis=0)
    scale[scale < 1e-9] = 1.0

    def features(x):
        z = np.clip((x - center) / scale, -8, 8)
        return np.column_stack([np.sqrt(2 / FOURIER) * np.cos(z @ model.directions + model.phases), np.ones(len(x))])

    shrink = np.sqrt(RIDGE * len(x0) / (FOURIER + 1)) * np.eye(FOURIER + 1)
    weights = np.linalg.lstsq(np.vstack([features(x0), shrink]), np.r_[y0, np.zeros(FOURIER + 1)], rcond=None)[0]
    x2, y2 = (np.array([v[i] for i in of if part[i] == 2], float) for v in (of, y))
    at = np.clip(((features(x2) @ weights + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)
    bins = np.unique(at)
    s, n = (np.array([w[at == b].sum() for b in bins]) for w in (y2, np.ones(len(y2))))
    knots, values = pooled(s, n, -0.5 + (bins + 0.5) / BINS * 2)
    assert 2 < len(knots) < len(bins)
    raw = features(np.array(list(of.values()))) @ weights
    order = 1 / (1 + np.exp(-4 * (np.clip(raw, -10, 10) - 0.5)))
    want = np.clip((1 - ORDER_SHARE) * np.interp(raw, knots, values) + ORDER_SHARE * order, 0, 1)
    got = {r["doc_id"]: r["score"] for r in quality_scores(docs, labels).collect()}
    assert max(abs(got[i] - w) for i, w in zip(of, want, strict=True)) < 1e-6


def test_rows_to_fit(spark):
    docs, labels = table(spark, 400)
    some = labels.where("doc_id % 2 = 0").unionByName(labels.limit(5))
    assert {r["doc_id"] for r in to_fit(docs, some).collect()} >= set(range(0, 400, 2))
    assert to_fit(docs, labels.where("false")).count() == 0
    assert 60 < to_fit(docs, labels, most=100).count() < 140


def table(spark, n=900, noise=0):
    rng = random.Random(1)
    texts, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        words = [rng.choice(["the", "of", "river", "morning", "walked", "house"]) + rng.choice(["", "", "ing", "ed"]) for _ in range(rng.randrange(20, 90))]
        text = " ".join(words).capitalize() + "." if good else " ".join(w.upper() + rng.choice(["$$$", "!!", "***"]) for w in words)
        texts.append((i, text, "en", "s"))
        labels.append((i, int(good != bool(noise and rng.random() < noise / 100))))
    return documents(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int")


def test_held_out_accuracy(spark):
    docs, labels = table(spark)
    rows = quality_scores(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 200
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    assert sum(r["predicted"] == r["quality"] for r in held) / len(held) > 0.97
    # Held-out labels never enter: turning them round changes nothing.
    turned = labels.selectExpr("doc_id", "if(crc32(cast(string(doc_id) as binary)) % 3 = 1, 1 - quality, quality) AS quality")
    again = {r["doc_id"]: r["score"] for r in quality_scores(docs, turned).collect()}
    assert all(abs(again[r["doc_id"]] - r["score"]) < 1e-6 for r in rows)


def test_awkward_documents(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(0, 1), (0, 0), (1, None), (None, 1), (2, 1), (4, 0), (6, 1), (7, 0), (8, 1), (9, 0), (10, 1)], "doc_id long, quality int")
    got = quality_scores(docs, labels).collect()
    assert len(got) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in got)
    assert not any(r["held_out"] for r in got if r["doc_id"] is None)
    assert len({r["score"] for r in got if r["doc_id"] == 8}) == 1
    none = quality_scores(docs, labels.limit(0)).collect()
    assert len(none) == len(TEXTS) and len({round(r["score"], 1) for r in none}) == 1
    one = quality_scores(docs, labels.selectExpr("doc_id", "1 AS quality")).collect()
    assert all(r["predicted"] == 1 for r in one)
    assert quality_scores(empty(spark), labels).count() == 0


def test_scored_keeps_rows(spark):
    docs, labels = table(spark, 120)
    model = fit(document_statistics(docs), labels)
    out = scored(docs, model, name="score")
    assert sorted(out.columns) == sorted(docs.columns) and out.count() == 120


def test_statistics_are_per_document():
    texts = [t or "" for _, t, *_ in TEXTS] + ["a\n\na\nB b!", "one"]
    raw = [t.encode() for t in texts]
    buf, at = np.frombuffer(b"".join(raw), np.uint8), np.r_[0, np.cumsum([len(x) for x in raw])]
    together = statistics(buf, at)
    alone = np.vstack([statistics(np.frombuffer(x, np.uint8), np.array([0, len(x)])) for x in raw])
    assert np.allclose(together, alone) and np.isfinite(together).all()
