import random

import pytest

from tidecast.llm.components import connected_components


def brute(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in edges:
        if u is not None and v is not None and u != v:
            a, b = find(u), find(v)
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("kind", ["path", "star", "random", "odd"])
def test_against_union_find(spark, kind):
    rng = random.Random(5)
    ids = list(range(200))
    rng.shuffle(ids)
    edges = {
        "path": list(zip(ids, ids[1:])),
        "star": [(199, k) for k in range(0, 199, 2)],
        "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(120)],
        "odd": [(1, 1), (None, 2), (3, None), (4, 5), (5, 4), (4, 5)],
    }[kind]
    got = connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert len(got) == len({r["node"] for r in got})
    assert {r["node"]: r["component"] for r in got} == brute(edges)


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "u string, v string")).collect() == []
