"""Language prediction: held-out accuracy, mixtures, odd rows."""

import random
from itertools import combinations

import numpy as np

from croptide.llm import language
from croptide.llm.queries import op3_language

DOCS = "doc_id long, text string, lang string"
SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    out = op3_language(spark, SF).join(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text"), "doc_id")
    rows = out.where("held_out").collect()
    assert 100 < len(rows) < 350
    known = [r for r in rows if r["lang"] is not None and r["lang_pred"] != "und"]
    right = sum(r["lang"] == r["lang_pred"] for r in known)
    assert right / len(known) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def model(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate(
        [("the cat and the dog with the bird", "en"), ("der hund und die katze mit dem vogel", "de"),
         ("le chien et le chat avec un oiseau", "fr")] * 20)]
    return language.fit(spark.createDataFrame(rows, DOCS))


def test_mixture_proportions(spark):
    fitted = model(spark)
    en, de = "the cat and the dog with the bird ", "der hund und die katze mit dem vogel "
    texts = [en * 10, de * 10, en * 30 + de * 10]
    doc, gram, _ = language._grams(texts)
    feature = fitted.feature[gram]
    pair, n = np.unique((doc * language.FEATURES + feature)[feature >= 0], return_counts=True)
    share = language._mixtures(fitted, pair // language.FEATURES, pair % language.FEATURES,
                               n.astype(float), 3)
    at = {lang: i for i, lang in enumerate(fitted.languages)}
    assert np.allclose(share.sum(axis=1), 1)
    assert share[0, at["en"]] == 1 and share[1, at["de"]] == 1
    assert 0.65 < share[2, at["en"]] < 0.85 and share[2, at["fr"]] == 0


def em(p, n, rounds=400):
    """Plain expectation maximisation of one set's proportions; the log-likelihood reached."""
    share = np.full(p.shape[1], 1 / p.shape[1])
    for _ in range(rounds):
        part = p * share
        part *= (n / part.sum(axis=1))[:, None]
        share = part.sum(axis=0) / n.sum()
    return share, float((np.log(p @ share) * n).sum())


def test_mixtures_against_every_set_of_languages(spark):
    """All subsets with plain EM, the best by likelihood less half a log per further language."""
    fitted = model(spark)
    words = {"en": "the cat and dog with bird", "de": "der hund und die katze mit dem vogel",
             "fr": "le chien et chat avec un oiseau"}
    rng = random.Random(9)
    texts = []
    for _ in range(60):
        picked = rng.sample(sorted(words), rng.choice([1, 1, 2, 3]))
        texts.append(" ".join(rng.choice(words[rng.choice(picked)].split())
                              for _ in range(rng.choice([5, 20, 80]))))
    doc, gram, _ = language._grams(texts)
    feature = fitted.feature[gram]
    doc, feature = doc[feature >= 0], feature[feature >= 0]
    pair, n = np.unique(doc * language.FEATURES + feature, return_counts=True)
    doc, feature = pair // language.FEATURES, pair % language.FEATURES
    share = language._mixtures(fitted, doc, feature, n.astype(float), len(texts))
    langs, same = len(fitted.languages), 0
    for k in range(len(texts)):
        own = doc == k
        p, counts = fitted.likelihood[feature[own]], n[own].astype(float)
        options = []
        for size in range(1, langs + 1):
            for chosen in combinations(range(langs), size):
                part, reached = em(p[:, chosen], counts)
                full = np.zeros(langs)
                full[list(chosen)] = part
                options.append((reached - 0.5 * (size - 1) * np.log(max(counts.sum(), 2)), full))
        options.sort(key=lambda x: -x[0])
        (best, want), (second, _) = options[:2]
        if best - second < 0.5 or np.sort(want)[-1] - np.sort(want)[-2] < 0.1:
            continue  # two sets or two languages are as good as each other
        same += 1
        assert share[k].argmax() == want.argmax(), texts[k]
        assert set(np.flatnonzero(share[k] > 0.02)) == set(np.flatnonzero(want > 0.02)), texts[k]
        assert np.abs(share[k] - want).max() < 0.1, texts[k]
    assert same >= 30


def test_fit_tells_text_of_the_language_from_other_text(spark):
    fitted = model(spark)
    rows = [(0, "the bird with the dog and the cat", None), (1, "xq zzv kjw qqp wxy " * 9, None),
            (2, "12 34", None), (3, None, None)]
    got = {r["doc_id"]: r["fit"] for r in language.predict(
        spark.createDataFrame(rows, DOCS).withColumn("fit", language.F.lit(7)), fitted,
        explained=True).collect()}
    assert abs(got[0]) < 1 and got[1] < got[0] - 3
    assert got[2] is None and got[3] is None


def test_odd_rows(spark):
    fitted = model(spark)
    texts = [None, "", "123 !? ٣", "THE CAT", "中文", "the cat " * 20_000, "x"]
    frame = spark.createDataFrame([(i, t, 0.5, "z") for i, t in enumerate(texts)] + [(None, "the", 1.0, "z")],
                                  "doc_id long, text string, score double, LANG_PRED string")
    out = {r["doc_id"]: r for r in language.predict(frame, fitted).collect()}
    assert [out[i]["lang_pred"] for i in range(3)] == ["und"] * 3
    assert out[3]["lang_pred"] == out[5]["lang_pred"] == "en"
    assert out[4]["lang_pred"] in fitted.languages
    assert out[None]["lang_pred"] in fitted.languages
    none = spark.createDataFrame([], DOCS)
    assert language.predict(none, fitted).count() == 0
    empty = language.fit(none)
    assert {r["lang_pred"] for r in language.predict(frame, empty).collect()} == {"und"}


def test_held_out_is_crc32_of_the_id(spark):
    import zlib

    rows = spark.range(200).select(language.F.col("id").alias("doc_id"))
    got = {r["doc_id"] for r in rows.where(language.held_out(rows)).collect()}
    assert got == {i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0}
