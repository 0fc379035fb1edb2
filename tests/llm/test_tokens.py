"""Token counts against the library over whole texts; the cache."""

import random

import pytest

from croptide.llm import tokens

public_tokenizers = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string"
FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(FILE)


def texts():
    rng = random.Random(4)
    alphabet = ["a", "B", "é", "é", "ß", "Σ", "ς", "中", "1", "½", "'s", "'LL", "<|endoftext|>",
                "<|ENDOFTEXT|>", "<|startoftext|>", "-", "...", " ", "\n", "\t", " ", " ",
                "‍", "👍🏽", "́", "İ", "가", "각", "\x85", "\x1c", "ﬁ"]
    fixed = [None, "", " ", "\n\n", "x" * 70_000, "word " * 3000, "Don't  stop 123"]
    return fixed + ["".join(rng.choices(alphabet, k=rng.randrange(1, 40))) for _ in range(400)]


def test_counts_are_the_librarys(spark, library):
    rows = list(enumerate(texts()))
    frame = spark.createDataFrame(rows, DOCS).repartition(4)
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"])
           for r in tokens.count_tokens(frame, FILE).collect()}
    for i, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False))
        assert got[i] == (len((text or "").encode()), n, n > 2048), text


def test_cache_encodes_only_what_is_new(spark, tmp_path, monkeypatch):
    cache = str(tmp_path / "cache")
    first = spark.createDataFrame([(1, "a b"), (2, "a  b\n"), (3, "c")], DOCS)
    second = spark.createDataFrame([(4, "a b"), (5, "d e f"), (5, "d e f")], DOCS)
    assert {r["doc_id"]: r["n_tokens"] for r in
            tokens.count_tokens(first, FILE, cache).collect()} == {1: 2, 2: 2, 3: 1}
    stored = spark.read.parquet(cache)
    assert stored.count() == 2
    # A wrong count planted in the cache comes back: it isn't encoded again.
    stored.limit(0).unionByName(spark.createDataFrame(
        [(tokens.tokenizer_version(FILE), spark.range(1).select(
            tokens.text_digest(tokens.F.lit("planted"))).first()[0], 77)],
        tokens.CACHE_SCHEMA)).write.mode("append").parquet(cache)
    third = second.unionByName(spark.createDataFrame([(6, "planted")], DOCS))
    got = [(r["doc_id"], r["n_tokens"]) for r in
           tokens.count_tokens(third, FILE, cache).orderBy("doc_id").collect()]
    assert got == [(4, 2), (5, 3), (5, 3), (6, 77)]
    assert spark.read.parquet(cache).count() == 4


def test_odd_rows(spark):
    frame = spark.createDataFrame([(None, "a", 1), (None, None, 1), (1, "a", 1)],
                                  DOCS + ", n_tokens int")
    out = tokens.count_tokens(frame, FILE).collect()
    assert sorted(((r["doc_id"] or -1), r["n_tokens"]) for r in out) == [(-1, 0), (-1, 1), (1, 1)]
    assert tokens.count_tokens(spark.createDataFrame([], DOCS), FILE).count() == 0
