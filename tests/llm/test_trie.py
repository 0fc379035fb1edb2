"""The prefix trie against a dictionary of prefixes; numbering; heights of the bands."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from croptide.llm import skew, trie
from croptide.operators.numbering import number_rows

CONVERSATIONS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
           "saved_tokens", "ends_sha256"]


def brute(rows):
    """Rows of one turn and role must be equal here: their order is by digest."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    members, words = {}, re.compile("[^\x20\x09-\x0d]+")
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        rebuilt = own.get(base, [])[:h] + turns[h:]
        for d in range(len(rebuilt) + 1):
            members.setdefault(tuple(rebuilt[:d]), []).append((c, len(rebuilt)))
    out = {}
    for p in sorted(members, key=len, reverse=True):
        ids = [c for c, _ in members[p]]
        kids = [k for k in out if len(k) == len(p) + 1 and k[:-1] == p]
        gained = (len(ids) - 1) * (len(words.findall(p[-1][1])) if p else 0)
        out[p] = (min(ids), len(p), min(c for c, _ in members[p[:-1]]) if p else None, len(ids),
                  len(kids), sum(out[k][5] for k in kids) or 1,
                  gained + sum(out[k][6] for k in kids),
                  hashlib.sha256(",".join(str(c) for c, n in sorted(members[p])
                                          if n == len(p)).encode()).hexdigest())
    return sorted(out.values())


def conversations(seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-45, 160), 110):
        like = rng.choice([None, None, 7, 8])
        talk = random.Random(like if like else c * 31 + seed)
        for t in range(rng.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, t, talk.choice(["user", "assistant", None]),
                         talk.choice(["hi", "a b  c", "", None, "x\ny"])))
    for c in (200, 201, 213):  # deep, and equal up to some turn
        rows += [(c, t, "user", "w " * (t % 3) + ("fork" if t == c - 150 else "")) for t in range(70)]
    rows += [(301, None, "user", "n"), (301, None, "user", "n"), (301, 5, "a", "z"),
             (301, 5, "b", "y"), (None, 1, "user", "lost")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "height"), [(1, 2), (2, 32), (3, 4)])
def test_matches_prefixes(spark, seed, height):
    rows = conversations(seed)
    got = trie.prefix_trie(spark.createDataFrame(rows, CONVERSATIONS).repartition(3), height)
    assert got.columns == COLUMNS
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_hot_keys_spans_and_copies(spark, monkeypatch):
    """Small bounds, so that every way of splitting is taken."""
    monkeypatch.setattr(trie, "SPAN", 4)
    monkeypatch.setattr(trie, "COPIES", 2)
    monkeypatch.setattr(trie, "ENDS_BITS", 1)
    rows = conversations(4) + [(c, 0, "user", "same") for c in range(400, 460)] + [
        (460, 3, "user", "again")] * 7
    frame = spark.createDataFrame(rows, CONVERSATIONS)
    for hot in (1, 50, 10**6):
        monkeypatch.setattr(skew, "HOT", hot)
        assert sorted(tuple(r) for r in trie.prefix_trie(frame, 3).collect()) == brute(rows)


def test_ties_rerun_alike(spark):
    rows = [(1, 1, "user", f"text {k}") for k in range(40)]
    runs = [sorted(map(tuple, trie.prefix_trie(
        spark.createDataFrame(rows[::step], CONVERSATIONS).repartition(3)).collect()))
        for step in (1, -1)]
    assert runs[0] == runs[1]


def test_empty_and_clashing_columns(spark):
    frame = spark.createDataFrame([(1, 0, "user", "a", 5, "x")],
                                  CONVERSATIONS + ", depth int, words string")
    assert trie.prefix_trie(frame.limit(0)).count() == 0
    assert trie.prefix_trie(frame.where("conv_id > 1")).count() == 0
    nodes = {r["depth"]: r for r in trie.prefix_trie(frame).collect()}
    # The first turns are those of conversation 0, which isn't there.
    h = zlib.crc32(b"1") % 4
    assert len(nodes) == (2 if h == 0 else 1)
    assert nodes[0]["n_leaves"] == 1
    long = spark.createDataFrame([(9, 0, "user", "word " * 300_000)], CONVERSATIONS)
    assert trie.prefix_trie(long).count() >= 1


def test_numbers_follow_the_order(spark):
    frame = spark.range(1000).withColumn("x", (F.col("id") * 7919) % 1000).repartition(5)
    got = number_rows(frame, F.col("x").desc(), name="place").collect()
    assert {(r["x"], r["place"]) for r in got} == {(x, 999 - x) for x in range(1000)}
    assert number_rows(frame.limit(0), "x").count() == 0
