import random

import pytest

from shipyard.llm.graph import components


def roots(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(5, 4), (4, 5), (5, 4)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 200)]])
def test_shapes(spark, edges):
    got = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r["node"]: r["root"] for r in got} == roots([e for e in edges if e[0] != e[1]])
    assert len(got) == len({r["node"] for r in got})


def test_random_graph(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == roots([e for e in edges if e[0] != e[1]])
