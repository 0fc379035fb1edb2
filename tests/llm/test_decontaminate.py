"""Benchmark items in documents against all windows."""

import random
import re
from collections import Counter

from croptide.llm import decontaminate

DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"


def words(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+",
                      re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(part):
    size = min(5, len(part))
    return Counter(tuple(part[k:k + size]) for k in range(len(part) - size + 1))


def brute(docs, items, least=0.8):
    out = []
    for i, text in docs:
        w = words(text)
        for item, t in set(items):
            own = words(t)
            want, best = shingles(own), None
            for k in range(len(w) - len(own) + 1 if own else 0):
                got = shingles(w[k:k + len(own)])
                shared = sum((got & want).values())
                score = shared / (sum(got.values()) + sum(want.values()) - shared)
                if score >= least and (best is None or score > best[0]):
                    best = (score, k)
            if best:
                out.append((i, item, round(best[0], 12), best[1], len(own)))
    return sorted(out, key=str)


def found(spark, docs, items):
    out = decontaminate.contaminations(spark.createDataFrame(docs, DOCS).repartition(3),
                                       spark.createDataFrame(items, ITEMS))
    return sorted(((r["doc_id"], r["item_id"], round(r["similarity"], 12), r["start"],
                    r["n_words"]) for r in out.collect()), key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"v{k}" for k in range(60)] + ["É", "don't"]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([3, 4, 5, 6, 20, 40, 41]))))
             for k in range(25)]
    docs = []
    for i in range(80):
        text = rng.choices(vocabulary, k=rng.randrange(0, 80))
        if rng.random() < 0.6:
            passage = rng.choice(items)[1].split()
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                passage[rng.randrange(len(passage))] = rng.choice(vocabulary)
            at = rng.randrange(len(text) + 1)
            text[at:at] = passage
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(text)))
    return docs, items


def test_matches_all_windows(spark):
    """All of it but what lies beyond the fingerprints' radius, as its odds say."""
    total = missed = 0
    for seed in (1, 2, 3):
        docs, items = corpus(seed)
        want, got = brute(docs, items), found(spark, docs, items)
        exact = {r for r in want if r[2] == 1}
        assert exact <= set(got)
        assert {r[:2] for r in got} <= {r[:2] for r in want}
        total += len(want)
        missed += len({r[:2] for r in want} - {r[:2] for r in got})
    assert total > 60 and missed <= 0.03 * total


def test_slices_and_clean_rows(spark, monkeypatch):
    docs, items = corpus(4)
    want = found(spark, docs, items)
    monkeypatch.setattr(decontaminate, "SLICE_BYTES", 700)
    assert found(spark, docs, items) == want
    frame = spark.createDataFrame([(*d, "e") for d in docs] + [(None, items[0][1], "e")],
                                  DOCS + ", item_id string")
    kept = decontaminate.remove_contaminated(frame, spark.createDataFrame(items, ITEMS))
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(
        {i for i, _ in docs} - {r[0] for r in want})


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (None, "the one and only item here"), (4, "short one"),
            (4, "short one"), (5, "THE one, and only: item here! " * 2)]
    items = [(1, "The one and only item here."), (1, "The one and only item here."), (2, None),
             (3, ""), (4, "!!!"), (5, "short one"), (None, "one")]
    assert found(spark, docs, items) == brute(docs, items)
    assert found(spark, [], items) == [] and found(spark, docs, []) == []


def brute_short(docs, items, least=0.8):
    """Pairs of documents and longer items, whole against whole."""
    out = {}
    for i, text in docs:
        for item, t in items:
            own, w = words(t), words(text)
            size = min(5, len(own))
            if size <= len(w) < len(own):
                got, want = shingles(w), shingles(own)
                shared = sum((got & want).values())
                score = shared / (sum(got.values()) + sum(want.values()) - shared)
                if score >= least:
                    out[i, item] = (round(score, 12), 0, len(w))
    return out


def test_documents_shorter_than_an_item(spark):
    rng = random.Random(5)
    vocabulary = [f"v{k}" for k in range(300)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([6, 14, 30, 41, 80]))))
             for k in range(40)]
    docs = [(0, " ".join(items[2][1].split()[:-1]))]
    for i in range(1, 200):
        part = rng.choice(items)[1].split()
        for _ in range(rng.choice([1, 1, 2, 3])):
            part.pop(rng.choice([0, -1, rng.randrange(len(part))]))
        docs.append((i, " ".join(part)))
    want = brute_short(docs, items)
    got = {r[:2]: r[2:] for r in found(spark, docs, items)}
    assert all(want[k] == v for k, v in got.items())
    assert len(want) > 60 and len(want) - len(got) <= 0.03 * len(want)
    kept = decontaminate.remove_contaminated(spark.createDataFrame(docs, DOCS),
                                             spark.createDataFrame(items, ITEMS))
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in docs} - {i for i, _ in got}
