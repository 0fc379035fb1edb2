"""Registered queries of the package, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from croptide.llm import (alignment, chat, decontaminate, embeddings, language, licences, mixing, pages,
                          quality, simhash, substrings, tokens, trie)
from croptide.llm.sql import (CHAT_SQL, EMBEDDING_SQL, LICENCE_SQL, MIXING_SQL, QUALITY_SQL,
                              SUBSTRING_SQL, TRIE_SQL)

TOKENIZER = "word_bpe_49k.json"
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.count_tokens(_table(spark, sf_dir, "documents"),
                               public_tokenizers.path(TOKENIZER))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held = language.held_out(docs)
    model = language.fit(docs.where(~held & F.col("doc_id").isNotNull()))
    return language.predict(docs.select("doc_id", held.alias("held_out"), "text"), model).drop(
        "text")


def op4_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op5_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed",
                       F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def document_files(docs: DataFrame) -> DataFrame:
    """Documents as files: ``source/language/hundred/name``.

    Each may be the licence file of its directory: those with a licence of their
    own grant it.
    """
    place = F.concat_ws("/", F.coalesce("source", F.lit("none")),
                        F.coalesce("lang", F.lit("none")),
                        F.floor(F.col("doc_id") / 100).cast("string"))
    return docs.select(
        "doc_id", F.concat(place, F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
        .alias("path"), "text", F.lit(True).alias("is_licence_file"))


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(document_files(_table(spark, sf_dir, "documents")))
    return found.select("doc_id", "path", "license", F.round("score", 9).alias("score"),
                        "origin", "directory")


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(_table(spark, sf_dir, "conversations"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminations(_table(spark, sf_dir, "documents"),
                                        _table(spark, sf_dir, "benchmark"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(_table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", "n_chars")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return alignment.link_statistics(_table(spark, sf_dir, "documents"),
                                     *map(public_tokenizers.path, ALIGNED))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(_table(spark, sf_dir, "conversations"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents")).drop("failed_rule")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_mixing, op2_token_counts, op3_language, op4_embedding_neardup,
        op5_simhash_neardup, op6_substring_dedup, op7_licences, op8_chat,
        op9_decontamination, op10_html, op11_alignment, op12_prefix_trie, op13_quality)}

SQL = {
    "op1_mixing": MIXING_SQL,
    "op4_embedding_neardup": EMBEDDING_SQL,
    "op6_substring_dedup": SUBSTRING_SQL,
    "op7_licences": LICENCE_SQL,
    "op8_chat": CHAT_SQL,
    "op12_prefix_trie": TRIE_SQL,
    "op13_quality": QUALITY_SQL,
}
