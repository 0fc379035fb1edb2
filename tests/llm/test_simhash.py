"""SimHash groups against all pairs of fingerprints."""

import random
import re

import numpy as np
import pytest
import xxhash

from croptide.llm import simhash
from croptide.llm.queries import op5_simhash_neardup
from test_components import brute

DOCS = "doc_id long, text string"


def fingerprint(text, size=3):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lower)
    parts = ([" ".join(words[i:i + size]) for i in range(len(words) - size + 1)]
             or ([" ".join(words)] if words else []))
    h = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(rows, radius=3):
    prints = [(i, fingerprint(t)) for i, t in rows]
    edges = [(a, b) for k, (a, x) in enumerate(prints) for b, y in prints[:k]
             if a is not None and b is not None and (x ^ y).bit_count() <= radius]
    parts = brute(edges)
    return sorted((i, format(x, "016x"), parts.get(i, i)) for i, x in prints)


def corpus(seed, n=160):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdé", k=rng.randrange(1, 6))) for _ in range(300)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.5:
            words = rng.choice(rows)[1].split()
            for _ in range(rng.randrange(0, 3)):
                if words:
                    words[rng.randrange(len(words))] = rng.choice(vocabulary)
        else:
            words = rng.choices(vocabulary, k=rng.choice([0, 1, 2, 3, 5, 60, 300]))
        rows.append((i * 3, " ".join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_match_all_pairs(spark, seed):
    rows = corpus(seed) + [(1, "A BcÉ D"), (2, "a bcÉ d"), (5, None), (7, " \n")]
    frame = spark.createDataFrame(rows, DOCS).repartition(5)
    out = simhash.near_duplicates(frame).collect()
    got = sorted((r["doc_id"], format(r["fp"] % 2**64, "016x"), r["component_id"]) for r in out)
    assert got == groups(rows)


def test_cells_find_every_near_pair(spark):
    """Fingerprints around a few centres, with more in a cell than a block holds."""
    rng = np.random.default_rng(3)
    fps = set()
    for centre in rng.integers(0, 2**63, 12).tolist():
        for _ in range(25):
            x = centre
            for b in rng.integers(0, 64, rng.integers(0, 5)).tolist():
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    block, simhash.BLOCK = simhash.BLOCK, 4
    try:
        nodes = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in fps], "fp long")
        edges = simhash.link_fingerprints(nodes, 3).collect()
    finally:
        simhash.BLOCK = block
    got = brute([(r["a"] % 2**64, r["b"] % 2**64) for r in edges])
    want = brute([(a, b) for k, a in enumerate(fps) for b in fps[:k] if (a ^ b).bit_count() <= 3])
    assert got == want


def test_odd_rows(spark):
    rows = [(4, "a b c d", 1), (4, "a b c d", 2), (None, "a b c d", 3), (None, "zz", 4),
            (9, None, 5), (3, "", 6)]
    frame = spark.createDataFrame(rows, DOCS + ", fp int")
    out = sorted((r["doc_id"] or -1, r["component_id"] or -1)
                 for r in simhash.near_duplicates(frame).collect())
    assert out == [(-1, -1), (-1, 4), (3, 3), (4, 4), (4, 4), (9, 3)]
    kept = simhash.keep_first(frame)
    assert kept.columns == frame.columns
    assert sorted((r["doc_id"] or -1, r["text"]) for r in kept.collect()) == [
        (-1, "a b c d"), (-1, "zz"), (3, ""), (4, "a b c d")]
    none = spark.createDataFrame([], DOCS)
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.keep_first(none).count() == 0


def test_query(spark):
    import duckdb

    rows = duckdb.connect().execute(
        "SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    got = op5_simhash_neardup(spark, "/root/testdata/sf0.001")
    assert sorted(tuple(r) for r in got.collect()) == groups(rows)
