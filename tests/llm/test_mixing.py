import hashlib
import random

from pyspark.sql import functions as F

from shipyard.llm.mixing import budgets, mix
from tests.llm.cases import CLASHES, TEXTS, documents, empty

WEIGHTS = {"domain": {"a": 3, "b": 1}, "language": {"en": 5}, "source": {"s1": 2, "s3": 0}}


def fill(budget, nodes):
    """Water filling in whole numbers: [(key, capacity, weight)] to {key: given}."""
    nodes = [n for n in nodes if n[2]]
    given = {}
    while nodes:
        total = sum(w for _, _, w in nodes)
        full = [n for n in nodes if n[1] * total <= max(0, budget) * n[2]]
        if not full:
            given |= {k: budget * w // total for k, _, w in nodes}
            break
        k, c, _ = min(full, key=lambda n: n[1] / n[2])
        given[k] = c
        budget -= c
        nodes = [n for n in nodes if n[0] != k]
    return given


def plan(leaves, total, epochs, default=1):
    def down(level, rows, budget):
        if level == 3:
            return {key: budget for key, _ in rows}
        name = ("domain", "language", "source")[level]
        groups = {}
        for key, tokens in rows:
            groups.setdefault(key[level], []).append((key, tokens))
        # A node can spend what its leaves hold, unless a weight of 0 lies between it and the leaf.
        open_ = lambda key: all(WEIGHTS[n].get(key[i], default) for i, n in enumerate(("domain", "language", "source")) if i > level)
        nodes = [(k, sum(t for key, t in g if open_(key)) * epochs, WEIGHTS[name].get(k, default)) for k, g in groups.items()]
        out = {}
        for k, given in fill(budget, nodes).items():
            out |= down(level + 1, groups[k], given)
        return out

    return down(0, list(leaves.items()), total)


def test_budgets_by_brute_force(spark):
    rng = random.Random(4)
    for _ in range(4):
        leaves = {(d, g, s): rng.choice([0, 3, rng.randrange(1, 4000)]) for d in ("a", "b", None) for g in ("en", "de") for s in ("s1", "s2", "s3", None) if rng.random() < 0.8}
        df = spark.createDataFrame([(*k, t) for k, t in leaves.items()], "domain string, language string, source string, tokens long")
        for total in (0, 10, 3000, 50_000):
            got = {(r["domain"], r["language"], r["source"]): r["given"] for r in budgets(df, total, WEIGHTS, 2).collect()}
            assert got == plan(leaves, total, 2)
            assert sum(got.values()) <= total


def test_nothing_is_left_to_a_node_below_which_all_weighs_nothing(spark):
    df = spark.createDataFrame([("a", "en", "s3", 100), ("a", "en", "s1", 10), ("b", "en", "s2", 300)], "domain string, language string, source string, tokens long")
    assert {r["source"]: r["given"] for r in budgets(df, 200, WEIGHTS, 1).collect()} == {"s1": 10, "s2": 190}


def words(text):
    return len((text or "").encode().split())


def brute_mix(texts, share, epochs, seed):
    leaves = {}
    for _, t, lang, source in texts:
        leaves[domain_of(source), lang, source] = leaves.get((domain_of(source), lang, source), 0) + words(t)
    out = []
    for leaf, given in plan(leaves, sum(leaves.values()) * share[0] // share[1], epochs).items():
        tokens = leaves[leaf]
        whole = given // tokens if tokens else 0
        own = [x for x in texts if (domain_of(x[3]), x[2], x[3]) == leaf]
        out += [(i, t, e) for i, t, *_ in own for e in range(whole)]
        room = given - whole * tokens
        if room or not tokens:
            md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
            order = {}
            for x in own:
                key = md5(f"{seed}:{whole}:{'null' if x[0] is None else x[0]}") + md5(x[1] or "")
                order.setdefault(key, []).append(x)
            upto = 0
            for key in sorted(order):
                upto += sum(words(x[1]) for x in order[key])
                if upto > room:
                    break
                out += [(x[0], x[1], whole) for x in order[key]]
    return sorted(out, key=str)


def domain_of(source):
    return None if source is None else "a" if source in ("s1", "src0", "src1") else "b"


def mixed(docs, share, epochs, seed):
    domain = F.when(F.col("source").isin("s1", "src0", "src1"), "a").when(F.col("source").isNotNull(), "b")
    df = mix(docs, domain, F.col("lang"), F.col("source"), WEIGHTS, share, epochs, seed)
    return df, sorted(((r["doc_id"], r["text"], r["epoch"]) for r in df.collect()), key=str)


def test_awkward_documents(spark):
    docs = documents(spark)
    for share, epochs in (((1, 1), 1), ((1, 2), 2), ((0, 1), 1), ((3, 1), 3)):
        df, got = mixed(docs, share, epochs, 5)
        assert got == brute_mix(TEXTS, share, epochs, 5)
        assert set(docs.columns) <= set(df.columns) and len(set(df.columns)) == len(df.columns)
        for r in df.collect():
            assert r["n_tokens"] == words(r["text"]) and r["domain"] == domain_of(r["source"])
            assert all(r[c] == (r["doc_id"] or 0) for c in CLASHES if c not in ("domain", "n_tokens", "epoch"))
    assert mixed(empty(spark), (1, 1), 1, 5)[1] == []


def test_hot_source(spark):
    rng = random.Random(8)
    texts = [(i, "w " * rng.randrange(30), rng.choice(["en", "de"]), "s1" if i % 3 else rng.choice(["s2", "s4"])) for i in range(600)]
    got = mixed(documents(spark, texts), (3, 5), 2, 11)[1]
    assert got == brute_mix(texts, (3, 5), 2, 11)
