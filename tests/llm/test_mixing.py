"""Targets against step-by-step resharing, word counts, draws, odd rows."""

import re

import pytest

from croptide.llm import mixing

DOCS = "doc_id long, text string, source string"


def reshare(sizes: dict, weights: dict, ceiling=3) -> dict:
    """Share by weight; cap and share the excess again until none is above."""
    target, fixed, left = {}, set(), float(sum(sizes.values()))
    while True:
        free = [s for s in sizes if s not in fixed]
        total = sum(weights[s] for s in free)
        for s in free:
            target[s] = left * weights[s] / total
        over = [s for s in free if target[s] > ceiling * sizes[s]]
        if not over:
            return target
        for s in over:
            target[s] = float(ceiling * sizes[s])
            fixed.add(s)
            left -= target[s]


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 1000}, {"a": 1, "b": 2, "c": 3, "d": 10**6},
    {"a": 500, "b": 20, "c": 30, "d": 40, "e": 10}, {"a": 7}, {"a": 0, "b": 5},
    {"Z": 5, "a": 100, "é": 100, None: 300}])
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r for r in mixing.targets(mixing.weigh(frame)).collect()}
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    assert {s: r["weight"] for s, r in got.items()} == weights
    want = reshare(sizes, weights)
    assert {s: r["target"] for s, r in got.items()} == pytest.approx(want)
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))


def test_word_count_matches_the_pattern(spark):
    texts = [None, "", " ", "a", " a\tb\n", "x y z", "\x0b\x0c", "a" * 5000 + " b",
             "one  two\r\nthree", " ", "é ü"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = {r["i"]: r["n"] for r in rows.select("i", mixing.word_count(rows["text"]).alias("n"))
           .collect()}
    assert got == {i: len(re.findall("[^\x20\x09-\x0d]+", t or "")) for i, t in enumerate(texts)}


def corpus(spark, n=600):
    rows = [(i, "w " * (1 + i % 40), ("hot", "b", "c", None)[(i % 7) % 4]) for i in range(n)]
    return spark.createDataFrame(rows, DOCS)


def test_mix_meets_targets_and_repeats(spark):
    docs = corpus(spark)
    first = {tuple(r) for r in mixing.mix_sizes(docs).collect()}
    assert first == {tuple(r) for r in mixing.mix_sizes(docs.repartition(7)).collect()}
    by_source = {}
    for r in mixing.mix_sizes(docs).collect():
        assert 0 <= r["taken"] <= 3 * r["size"]
        assert abs(r["copies"] - r["target"] / r["source_size"]) < 1
        taken, target = by_source.get(r["source"], (0, 0))
        by_source[r["source"]] = (taken + r["taken"], r["target"])
    for taken, target in by_source.values():
        assert taken == pytest.approx(target, rel=0.25)
    mixed = mixing.mix(docs)
    assert mixed.columns == [*docs.columns, "copy"]
    assert mixed.count() == sum(r["copies"] for r in mixing.mix_sizes(docs).collect())


def test_odd_rows(spark):
    rows = [(1, None, "a"), (1, "x y", "a"), (1, "x y", "a"), (None, "z", None), (2, "", "b")]
    docs = spark.createDataFrame([(*r, 9, 8) for r in rows],
                                 DOCS + ", copy int, _copies int")
    out = mixing.mix_sizes(docs).collect()
    assert len(out) == 5
    assert len({r["copies"] for r in out if r["doc_id"] == 1}) == 1
    assert set(mixing.mix(docs).columns) == {"doc_id", "text", "source", "copy"}
    none = spark.createDataFrame([], DOCS)
    assert mixing.mix_sizes(none).count() == 0
    assert mixing.mix(none).count() == 0
