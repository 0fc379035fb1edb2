"""Quality rules: measures by brute force, the cascade's order and its verdicts."""

import random
import re

import pytest
from pyspark.sql import functions as F

from croptide.llm import quality

DOCS = "doc_id long, text string"
WORD = re.compile("[^\x20\x09-\x0d]+")


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    many = {w for w in windows if windows.count(w) > 1}
    covered = {i + k for i, w in enumerate(windows) if w in many for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered))


def texts():
    rng = random.Random(13)
    fixed = [None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "a a a a", "a a a",
             "x\ny\nx \nx\n\n \n", "é\xa0é\x85   b", "# * $ % & | < >", "a\rb\x0bc\x0cd\x1c",
             "one two three four one two three", "a b c d " * 200, "x" * 5000, "THE CAT " * 60]
    return fixed + [" ".join(rng.choices("abcde", k=rng.randrange(0, 90))) + rng.choice(
        ["", "\n", "\na b\na b"]) for _ in range(120)]


def test_measures_and_base(spark):
    rows = [*enumerate(texts()), (None, "a b"), (3, "a"), (3, "a")]
    got = quality.judge(spark.createDataFrame(rows, DOCS).repartition(3), order=[
        r.name for r in quality.standard_rules()]).collect()
    want = sorted((-1 if i is None else i, *measures(t)) for i, t in rows)
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"],
                   *(r[c] for c in quality.MEASURES)) for r in got) == want
    for r in got:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed
        assert not (failed and (r["kept"] or r["failed_rule"]))
        assert r["kept"] == (not failed and r["failed_rule"] is None)


def clean(rng, n=80):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randrange(1, 9))) for _ in range(n))


def test_each_rule_rejects_its_own(spark):
    rng = random.Random(1)
    bad = {
        "word_length": " ".join(rng.choices("abcdefghijklmnop", k=900)),
        "symbols": clean(rng).replace(" ", "# "),
        "duplicate_lines": "\n".join(x for k in range(20) for x in (
            [clean(rng, 9)] + ["top of page"])),
        "capitals": clean(rng).upper(),
        "words_without_letter": clean(rng).replace(" ", " 1 "),
        "digits": re.sub("[a-d]", "7", clean(rng)),
        "longest_word": clean(rng) + " " + "q" * 201,
        "bullets": "\n".join("- " + clean(rng, 9) for _ in range(10)),
        "ellipses": "\n".join(clean(rng, 9) + "..." for _ in range(10)),
    }
    names = [r.name for r in quality.standard_rules()]
    assert set(bad) == set(names)
    frame = spark.createDataFrame([*enumerate(bad.values()), (99, clean(rng))], DOCS)
    for order in (names, names[::-1]):
        got = {r["doc_id"]: r for r in quality.judge(frame, order=order).collect()}
        assert got[99]["kept"]
        assert not any(got[k]["kept"] for k in range(len(bad)))
    # With the rule first in order it is the one that is named.
    for k, name in enumerate(bad):
        rest = [name, *(n for n in names if n != name)]
        assert {r["doc_id"]: r["failed_rule"] for r in
                quality.judge(frame, order=rest).collect()}[k] == name


def test_order_is_by_rejections_per_cost():
    e = [quality.Estimate(n, c, 0) for n, c in (("dear", 4.0), ("cheap", 1.0), ("same", 1.0),
                                                ("never", 1.0))]
    together = {(True, True, False, False): 60, (True, False, True, False): 30,
                (True, False, False, False): 10, (False, False, False, False): 900}
    # dear finds 100 / 4, cheap 60, then dear 40 / 4 against same 30.
    assert quality.best_order(e, together) == ["cheap", "same", "dear", "never"]
    assert quality.best_order([], {}) == []
    assert quality.best_order(e, {}) == ["cheap", "same", "never", "dear"]


def test_later_rules_are_not_evaluated(spark):
    docs = spark.createDataFrame([(1, clean(random.Random(2)))], DOCS)
    rules = [quality.Rule("all", F.col("n_words") > 0),
             quality.Rule("error", F.raise_error(F.lit("evaluated")).cast("boolean"))]
    got = quality.judge(docs, rules, order=["all", "error"]).first()
    assert got["failed_rule"] == "all"
    with pytest.raises(ValueError):
        quality.judge(docs, rules, order=["all"])


def test_verdict_does_not_depend_on_the_estimated_order(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    names = [r.name for r in quality.standard_rules()]
    fixed = {r["doc_id"]: r["kept"] for r in quality.judge(docs, order=names).collect()}
    found = quality.judge(docs)
    assert {r["doc_id"]: r["kept"] for r in found.collect()} == fixed
    # A filter above computes nothing twice.
    assert found.where("kept").count() == sum(fixed.values())
    good = quality.keep_good(docs)
    assert good.columns == docs.columns
    assert {r["doc_id"] for r in good.collect()} == {k for k, v in fixed.items() if v}


def test_clashing_columns_and_empty_tables(spark):
    names = ["words", "lines", "n_words", "kept", "row", "failed_rule", "_windows"]
    text = clean(random.Random(3))
    docs = spark.createDataFrame([(1, text, *[7] * 7), (2, "", *[8] * 7)],
                                 DOCS + "".join(f", {c} int" for c in names))
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert kept.collect() == [(1, text, *[7] * 7)]
    assert [r["doc_id"] for r in quality.judge(docs).orderBy("doc_id").collect()] == [1, 2]
    assert quality.judge(docs.limit(0)).count() == 0
    assert quality.keep_good(docs.limit(0)).count() == 0
