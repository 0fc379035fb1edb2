"""Removed words against all windows."""

import random

import pytest

from croptide.llm import substrings

DOCS = "doc_id long, text string"


def removed(rows, window=13):
    seen = {}
    for i, t in rows:
        words = (t or "").encode().split()
        for k in range(len(words) - window + 1):
            if i is not None:
                key = tuple(words[k:k + window])
                seen[key] = min(seen.get(key, i), i)
    out = []
    for i, t in rows:
        words = (t or "").encode().split()
        gone = set()
        for k in range(len(words) - window + 1):
            if i is not None and seen[tuple(words[k:k + window])] < i:
                gone.update(range(k, k + window))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone).decode()
        out.append((i if i is not None else -1, len(words), len(gone), kept))
    return sorted(out)


def found(frame, window=13):
    out = substrings.remove_repeats(frame, window)
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_words"], r["n_removed"],
                   r["kept_text"]) for r in out.collect())


def corpus(seed, n=120):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(40)] + ["é", "ß,"]
    passages = [rng.choices(vocabulary, k=rng.choice([12, 13, 14, 20, 60])) for _ in range(6)]
    rows = []
    for i in range(n):
        words = rng.choices(vocabulary, k=rng.choice([0, 3, 12, 13, 30, 200]))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = rng.choice(passages)
        if rows and rng.random() < 0.1:
            words = (rows[-1][1] or "").split()
        rows.append((rng.randrange(10**6), rng.choice([" ", "\n", "  "]).join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_all_windows(spark, seed):
    rows = corpus(seed)
    assert found(spark.createDataFrame(rows, DOCS).repartition(5)) == removed(rows)


@pytest.mark.parametrize("window", [1, 2, 4, 7])
def test_other_windows(spark, window):
    rows = corpus(7, 40)
    assert found(spark.createDataFrame(rows, DOCS), window) == removed(rows, window)


def test_odd_rows(spark):
    long = " ".join(f"t{k}" for k in range(30))
    rows = [(5, long), (5, long), (2, long + " x"), (None, long), (9, None), (8, ""),
            (7, long.replace("t3 ", "T3 ")), (5, "other " + long)]
    frame = spark.createDataFrame([(*r, "extra", 3) for r in rows],
                                  DOCS + ", kept_text string, N_WORDS int")
    assert found(frame) == removed(rows)
    assert found(spark.createDataFrame([], DOCS)) == []


def test_a_window_within_one_document_stays(spark):
    twice = " ".join(f"t{k}" for k in range(20))
    rows = [(1, twice + " " + twice)]
    assert found(spark.createDataFrame(rows, DOCS)) == removed(rows)
    assert removed(rows)[0][2] == 0
