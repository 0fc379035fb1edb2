"""Mixing sources to target weights, in words, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from croptide.llm.storage import stage

CEILING = 3  # a source's target is at most so many times its size
WEIGHTS = (5, 2, 1)  # by rank of the source's name, repeating
SMALL = 10_000  # sources that may be broadcast


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; 0 for null.

    White space becomes blanks and each run one blank, so that the words of the
    trimmed text are its blanks and one.
    """
    flat = F.trim(F.regexp_replace(text, "[\\x20\\x09-\\x0D]+", " "))
    blanks = F.length(flat) - F.length(F.replace(flat, F.lit(" "), F.lit("")))
    return F.when(F.length(flat) > 0, blanks + 1).otherwise(0).cast("long")


def weigh(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Add ``weight``: ``weights`` in turn over the names by code point, null last.

    The ranking takes one row per source, not per document.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    table = F.array(*(F.lit(float(w)) for w in weights))
    return sources.withColumn("weight", F.get(table, F.pmod(rank, F.lit(len(weights)))))


def targets(sources: DataFrame, ceiling: int = CEILING) -> DataFrame:
    """Add ``target`` to ``(source, source_size, weight)``.

    The total size is shared by weight; what lies above ``ceiling`` times a
    source's size is shared again among the others by weight, until none is
    above. That is ``min(ceiling * size, level * weight)`` for one level: in
    order of ``size / weight`` the sources up to some place are at the ceiling,
    and the level is what is left over the weights after it.
    """
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(),
                           "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    total = F.sum("source_size").over(everything)
    left = total - ceiling * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    rest = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = left.cast("double") / rest
    open_ = level * F.col("weight") <= ceiling * F.col("source_size")
    placed = sources.withColumn("_level", level).withColumn("_open", open_)
    # The first source that is not at its ceiling sets the level; later ones only lower it.
    at = F.max(F.when(F.col("_open"), F.col("_level"))).over(everything)
    return (placed.withColumn("_at", at)
            .withColumn("target", F.least((F.col("source_size") * ceiling).cast("double"),
                                          F.coalesce(F.col("_at") * F.col("weight"),
                                                     (F.col("source_size") * ceiling)
                                                     .cast("double"))))
            .drop("_level", "_open", "_at"))


def draw(doc_id: Column) -> Column:
    """A number in [0, 1) that depends on the id only: 32 bits of its MD5."""
    head = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 8)
    return F.conv(head, 16, 10).cast("double") / float(1 << 32)


def _with_copies(docs: DataFrame, sizes: DataFrame, weights, ceiling) -> DataFrame:
    """Join each row's source (a null one too) to its target; add ``_copies``.

    ``sizes`` has ``source, size``; the made columns start with an underscore.
    Copies are floor(rate), and one more with the probability of the fraction.
    """
    sources = stage(targets(weigh(
        sizes.groupBy("source").agg(F.sum("size").alias("source_size")), weights), ceiling),
        "sources")
    named = sources.select(F.col("source").alias("_source"),
                           F.col("source_size").alias("_source_size"),
                           F.col("target").alias("_target"))
    if sources.count() <= SMALL:
        named = F.broadcast(named)
    rate = F.when(F.col("_source_size") > 0,
                  F.col("_target") / F.col("_source_size")).otherwise(0.0)
    more = F.when(draw(F.col("doc_id")) < rate - F.floor(rate), 1).otherwise(0)
    return (docs.join(named, F.col("source").eqNullSafe(F.col("_source")))
            .withColumn("_copies", (F.floor(rate) + more).cast("int")))


def mix_sizes(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, ceiling: int = CEILING
              ) -> DataFrame:
    """``(doc_id, size, source, source_size, target, copies, taken)`` for every row.

    ``size`` is the number of words (null text: 0), ``target`` the words that the
    mix should take of the document's source, ``copies`` how often it takes the
    document and ``taken`` the words that makes. The draw depends on ``doc_id``
    only: reruns agree and rows that repeat an id are taken alike; a null id
    draws as the empty string. Sources without words have target 0; an empty
    table gives an empty one; further columns are ignored.
    """
    sized = stage(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")),
                  "sizes")
    return _with_copies(sized, sized, weights, ceiling).select(
        "doc_id", "size", "source", F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"), F.col("_copies").alias("copies"),
        (F.col("size") * F.col("_copies")).alias("taken"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, ceiling: int = CEILING
        ) -> DataFrame:
    """The documents of the mix, each as often as it is taken, numbered by ``copy``.

    Columns of ``docs`` and ``copy`` (1, 2, ...; replaces a column of that
    name). Documents without words count by their source's rate like others.
    Nulls, ties and repeated rows as in ``mix_sizes``.
    """
    made = {"copy", "_source", "_source_size", "_target", "_copies"}
    kept = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c.lower() not in made))
    sizes = docs.select("source", word_count(F.col("text")).alias("size"))
    return (_with_copies(kept, sizes, weights, ceiling).where("_copies > 0")
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
            .select(*(F.col(f"`{c}`") for c in kept.columns), "copy"))
