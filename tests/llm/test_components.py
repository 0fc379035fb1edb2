"""Components against union-find."""

import random

from croptide.llm.components import connected_components


def brute(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    return {x: find(x) for x in parent}


def check(spark, edges):
    frame = spark.createDataFrame(edges, "a long, b long")
    got = connected_components(frame, "a", "b").collect()
    assert len(got) == len({r["node"] for r in got})
    assert {r["node"]: r["component"] for r in got} == brute(edges)


def test_chain_star_and_random(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(100, 160)]
    rng.shuffle(chain)
    star = [(1000, i) for i in range(1001, 1100)]
    mixed = [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(70)]
    check(spark, chain + star + mixed + mixed[:5] + [(b, a) for a, b in mixed[:9]])


def test_odd_edges(spark):
    check(spark, [(5, 5), (None, 3), (4, None), (-7, 9), (9, -7)])
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0
