"""Token counts through a cache of digests: only texts not seen before are encoded."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from croptide.llm.storage import stage
from croptide.llm.words import Words, chunks, text_buffers

WORD_CACHE = 200_000  # words whose counts a task remembers at most

CACHE_SCHEMA = "version string, digest string, n_tokens long"


def tokenizer_version(path: str) -> str:
    """The tokenizer's identity: a digest of its file."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()[:32]


def text_digest(text: Column) -> Column:
    """Digest of the normalised content: runs of ASCII white space are one space.

    The tokenizer drops white space and never joins what it separates, so texts
    with equal digests have equal counts. Letter case is left alone, because the
    strings of special tokens are matched before lower-casing.
    """
    return F.sha2(F.trim(F.regexp_replace(text, "[\\x20\\x09-\\x0D]+", " ")), 256)


def _load(definition: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _encode_batches(batches: Iterator[pa.RecordBatch], definition) -> Iterator[pa.RecordBatch]:
    """Tokens of each text as the sum over its words, each word encoded once.

    The vocabulary's splitter drops white space, so no token crosses it.
    """
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks
    tokenizer = _load(definition.value)
    known: dict[bytes, int] = {}
    for batch in batches:
        offsets, data = text_buffers(batch.column("text"))
        found = [np.zeros(0, np.int64)]
        for a, b in chunks(offsets):
            own = offsets[a:b + 1] - offsets[a]
            words = Words.split(own, data[offsets[a]:offsets[b]])
            counts = np.zeros(b - a, dtype=np.int64)
            if len(words.start):
                parts = words.data.tobytes().split()
                if len(parts) != len(words.start):  # words that meet at a text's end
                    blob = words.data.tobytes()
                    parts = [blob[s:e] for s, e in zip(words.start.tolist(), words.end.tolist(),
                                                       strict=True)]
                coded = pa.array(parts, pa.binary()).dictionary_encode()
                distinct = coded.dictionary.to_pylist()
                new = [w for w in distinct if w not in known]
                if len(known) + len(new) > WORD_CACHE:
                    known.clear()
                    new = distinct
                for w, e in zip(new, tokenizer.encode_batch_fast(
                        [w.decode() for w in new], add_special_tokens=False), strict=True):
                    known[w] = len(e)
                per_word = np.array([known[w] for w in distinct])[
                    coded.indices.to_numpy(zero_copy_only=False)]
                total = np.append(0, np.cumsum(per_word))
                counts = total[words.first[1:]] - total[words.first[:-1]]
            found.append(counts)
        yield pa.RecordBatch.from_arrays(
            [batch.column("digest"), pa.array(np.concatenate(found))], ["digest", "n_tokens"])


def count_tokens(docs: DataFrame, tokenizer_file: str, cache: str | None = None,
                 limit: int = 2048) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for every row of ``docs``.

    ``tokenizer_file`` is a definition of the ``tokenizers`` library whose
    splitter drops white space; counts are those of encoding the whole text
    without added special tokens. ``cache`` is a Parquet folder of
    ``version, digest, n_tokens`` below a shared file system: known digests are
    read from it and the counts of new ones appended (None: a fresh cache for
    this call). Two runs that append the same digest at once do no harm, as
    equal digests have equal counts. A null text counts as empty; repeated rows
    give repeated rows; an empty table gives an empty one; further columns are
    ignored.
    """
    spark = docs.sparkSession
    version = tokenizer_version(tokenizer_file)
    with open(tokenizer_file, encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    digests = stage(texts.select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
        text_digest(F.col("text")).alias("digest")), "digests")
    known = _read_cache(spark, cache).where(F.col("version") == version).groupBy("digest").agg(
        F.min("n_tokens").alias("n_tokens"))
    # One row per digest before the join, however many copies a text has.
    missing = (digests.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
               .join(known, "digest", "left_anti"))
    # Only the documents that stand for a new digest are encoded. Ids can repeat
    # or be null, so the digest is part of the match.
    chosen = (texts.withColumn("digest", text_digest(F.col("text")))
              .join(missing.withColumnRenamed("digest", "new").withColumnRenamed("doc_id", "id"),
                    F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("new")),
                    "left_semi"))
    counted = chosen.select("digest", "text").mapInArrow(
        partial(_encode_batches, definition=definition), "digest string, n_tokens long")
    fresh = counted.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))
    if cache:
        fresh.select(F.lit(version).alias("version"), "digest", "n_tokens").write.mode(
            "append").parquet(cache)
        counts = _read_cache(spark, cache).where(F.col("version") == version).groupBy(
            "digest").agg(F.min("n_tokens").alias("n_tokens"))
    else:
        counts = stage(fresh, "tokens")
    return digests.join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def _read_cache(spark: SparkSession, cache: str | None) -> DataFrame:
    """The cache's rows; none when the folder does not exist yet."""
    if cache:
        path = spark._jvm.org.apache.hadoop.fs.Path(cache)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            return spark.read.schema(CACHE_SCHEMA).parquet(cache)
    return spark.createDataFrame([], CACHE_SCHEMA)
