"""Vector groups against all pairs."""

import math
import random

import pytest

from croptide.llm import embeddings
from test_components import brute

VECTORS = "vec_id long, embedding array<double>, label int"


def usable(row):
    i, v, label = row
    return (i is not None and label is not None and v and
            all(x is not None and math.isfinite(x) for x in v) and any(v))


def groups(rows, threshold=0.98):
    good = [r for r in rows if usable(r)]
    links = []
    for k, (a, u, x) in enumerate(good):
        for b, v, y in good[:k]:
            if x == y and len(u) == len(v):
                cosine = (math.sumprod(u, v) / math.sqrt(math.sumprod(u, u))
                          / math.sqrt(math.sumprod(v, v)))
                if cosine >= threshold:
                    links.append((a, b))
    parts = brute(links)
    count = {}
    for a, b in links:
        count[a] = count.get(a, 0) + 1
        count[b] = count.get(b, 0) + 1
    return sorted(((i if i is not None else -1), count.get(i, 0), parts.get(i, i) or -1
                   if i is None else parts.get(i, i),
                   parts.get(i, i) == i) for i, _, _ in rows)


def found(frame):
    return sorted((-1 if r["vec_id"] is None else r["vec_id"], r["n_links"],
                   -1 if r["component_id"] is None else r["component_id"], r["kept"])
                  for r in embeddings.near_duplicates(frame).collect())


def vectors(seed, n=300, size=16):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            base = rng.choice(rows)[1]
            v = [x + rng.gauss(0, rng.choice([0, 0.03, 0.06])) for x in base]
        else:
            v = [rng.gauss(0, 1) for _ in range(size)]
        rows.append((i * 2, v, rng.randrange(3)))
    return rows


@pytest.mark.parametrize("block", [1024, 8])
def test_groups_match_all_pairs(spark, block):
    rows = vectors(5)
    old, embeddings.BLOCK = embeddings.BLOCK, block
    try:
        assert found(spark.createDataFrame(rows, VECTORS).repartition(6)) == groups(rows)
    finally:
        embeddings.BLOCK = old


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (3, [2.0, 0.0], 1), (2, [1.0, 0.0], 2), (4, [1.0, 0.0], None),
            (5, None, 1), (6, [0.0, 0.0], 1), (7, [1.0, None], 1), (8, [nan, 1.0], 1),
            (9, [inf, 1.0], 1), (10, [], 1), (11, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1),
            (12, [1e300, 0.0], 1), (13, [1.0, 0.0], 1), (14, [-0.0, 1.0], 1), (15, [0.0, 1.0], 1)]
    frame = spark.createDataFrame([(*r, 7) for r in rows], VECTORS + ", n_links int")
    assert found(frame) == [
        (-1, 0, -1, True), (1, 3, 1, True), (2, 0, 2, True), (3, 3, 1, False), (4, 0, 4, True),
        (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (8, 0, 8, True), (9, 0, 9, True),
        (10, 0, 10, True), (11, 0, 11, True), (12, 3, 1, False), (13, 3, 1, False),
        (14, 1, 14, True), (15, 1, 14, False)]
    assert found(spark.createDataFrame([], VECTORS)) == []


def test_copies_and_repeated_ids(spark):
    rows = [(i, [1.0, 2.0], 1) for i in range(50)] + [(7, [1.0, 2.0], 1)]
    out = found(spark.createDataFrame(rows, VECTORS))
    assert len(out) == 51
    assert {r[1:3] for r in out} == {(50, 0)}
