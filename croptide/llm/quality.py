"""Quality rules as a short-circuit cascade, with DataFrame functions only.

Each rule rejects or passes a document. Whether a document is kept does not depend
on the order of the rules, but the work does: a document is tried until the first
rule rejects it. The order is found on a sample: every rule is timed and its
rejections are noted, then the rule that rejects most per second goes first, and
again among the sample's documents that it leaves.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from croptide.llm.storage import stage

#: Documents that the costs and rejections of the rules are estimated on, about.
SAMPLE = 4_000
RUNS = 2  # timings of each rule on the sample, the least counts
LEAST_SECONDS = 1e-3  # a rule that cannot be told from no rule costs so much
MIN_WORDS = 50
REPEATED_PERCENT = 50
WINDOW = 3

# White space between words; the characters that count as symbols.
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``rejects`` is a condition on the columns of ``measured``; null rejects nothing."""

    name: str
    rejects: Column


@dataclass(frozen=True)
class Estimate:
    """Of one rule on the sample: seconds for all of it, share that it rejects."""

    name: str
    seconds: float
    rejected: float


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _split_words(text: Column) -> Column:
    flat = F.trim(F.regexp_replace(text, "[\\x20\\x09-\\x0D]+", " "))
    return F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(flat, " "))


def _repeated_words(df: DataFrame) -> DataFrame:
    """Add ``n_repeat_words``: words in windows that the text holds more than once.

    Windows are compared as their words joined by blanks; a text whose windows have
    different hashes has no equal ones. Only the other texts are sorted: in order of the windows equal ones are neighbours, and the
    places of these, in order again, say how many words they cover. Every step is
    at most a sort of the text's own windows.
    """
    def windows(make):
        return F.transform(F.sequence(F.lit(0), F.size("words") - WINDOW),
                           lambda i: make(*(F.get("words", i + k) for k in range(WINDOW)), i))

    keyed = df.withColumn("_hashes", F.when(
        F.size("words") >= WINDOW, windows(lambda *x: F.xxhash64(*x[:-1]))))
    placed = keyed.withColumn("_placed", F.when(
        F.size(F.array_distinct("_hashes")) < F.size("_hashes"),
        F.sort_array(windows(lambda *x: F.struct(F.concat_ws(" ", *x[:-1]).alias("w"),
                                                 x[-1].alias("i"))))))

    def again(x: Column, j: Column) -> Column:
        before, after = F.get("_placed", j - 1)["w"], F.get("_placed", j + 1)["w"]
        return F.coalesce(x["w"] == before, F.lit(False)) | F.coalesce(x["w"] == after,
                                                                       F.lit(False))

    starts = placed.withColumn("_starts", F.sort_array(
        F.transform(F.filter("_placed", again), lambda x: x["i"])))
    # Each window covers its words up to the next repeated window.
    covers = F.zip_with("_starts", F.slice("_starts", F.lit(2), F.size("_starts")),
                        lambda a, b: F.coalesce(F.least(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    total = F.aggregate(covers, F.lit(0), lambda s, x: s + x)
    return starts.withColumn("n_repeat_words", F.coalesce(total, F.lit(0)).cast("long")).drop(
        "_hashes", "_placed", "_starts")


def measured(texts: DataFrame) -> DataFrame:
    """Add to a frame with ``text``: ``words``, ``lines`` (those with a word) and ``MEASURES``.

    A null text has no words. Words are runs of characters other than ASCII white
    space; ``n_dup_lines`` counts lines with a word that equal an earlier line.
    """
    text = F.coalesce("text", F.lit(""))
    split = (texts.withColumn("text", text)
             .withColumn("words", _split_words(F.col("text")))
             .withColumn("lines", F.filter(F.split("text", "\n"),
                                           lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))))
    counted = split.select(
        "*", F.size("words").cast("long").alias("n_words"),
        F.length(_without(F.col("text"), BLANKS)).cast("long").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("long")
        .alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"))
    return _repeated_words(counted)


def base_failed() -> Column:
    """Too short, or more than half of it repeats: judged before any rule."""
    return (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * REPEATED_PERCENT)


def standard_rules() -> list[Rule]:
    """Rules for running text in any language that writes blanks between words."""
    n, lines = F.col("n_words"), F.size("lines")

    def letters(kind: str) -> Column:
        return F.length(F.regexp_replace("text", f"[^\\p{{{kind}}}]+", ""))

    def share_of_lines(pattern: str) -> Column:
        return F.size(F.filter("lines", lambda x: x.rlike(pattern)))

    return [
        Rule("word_length", (F.col("word_chars") < n * 2) | (F.col("word_chars") > n * 15)),
        Rule("symbols", F.col("n_symbols") * 10 > n),
        Rule("duplicate_lines", F.col("n_dup_lines") * 10 > lines * 3),
        Rule("capitals", letters("Lu") * 2 > letters("L")),
        Rule("words_without_letter",
             F.size(F.filter("words", lambda w: ~w.rlike("\\p{L}"))) * 5 > n),
        Rule("digits", letters("N") * 10 > F.col("word_chars") * 3),
        Rule("longest_word", F.exists("words", lambda w: F.length(w) > 200)),
        Rule("bullets", share_of_lines("^\\s*[-*•‣◦]") * 10 > lines * 9),
        Rule("ellipses", share_of_lines("(\\.\\.\\.|…)\\s*$") * 10 > lines * 3),
    ]


def sample_of(docs: DataFrame, size: int = SAMPLE) -> DataFrame:
    """About ``size`` rows of ``docs`` that pass the base, measured, as a stage table."""
    n = docs.count()
    part = docs if n <= size else docs.sample(fraction=size / n, seed=11)
    return stage(measured(part.select("text")), "rules").where(~base_failed())


def estimate(sample: DataFrame, rules: Sequence[Rule]) -> tuple[list[Estimate], dict]:
    """Cost and rejections of every rule on a measured sample.

    Also returns how many documents are rejected by exactly which rules, as a
    mapping from tuples of booleans: at most one entry per sampled document.
    """
    outcomes = [F.coalesce(r.rejects, F.lit(False)).alias(f"r{k}") for k, r in enumerate(rules)]
    together = {tuple(row[:-1]): row[-1] for row in sample.select(*outcomes).groupBy(
        *(f"r{k}" for k in range(len(rules)))).count().collect()}
    total = sum(together.values())

    def seconds(condition: Column) -> float:
        took = []
        for _ in range(RUNS):
            start = time.perf_counter()
            sample.agg(F.count_if(condition)).collect()
            took.append(time.perf_counter() - start)
        return min(took)

    nothing = seconds(F.lit(True))
    return [Estimate(r.name, max(seconds(r.rejects) - nothing, LEAST_SECONDS),
                     sum(c for key, c in together.items() if key[k]) / max(total, 1))
            for k, r in enumerate(rules)], together


def best_order(estimates: Sequence[Estimate], together: dict) -> list[str]:
    """Rule names by rejections per cost among what the rules before have left.

    A tie goes to the cheaper rule, then to the earlier one.
    """
    left, rest, order = dict(together), list(range(len(estimates))), []
    while rest:
        def gain(k: int, left=left) -> tuple[float, float]:
            found = sum(c for key, c in left.items() if key[k])
            return found / estimates[k].seconds, -estimates[k].seconds
        first = max(rest, key=lambda k: (gain(k), -k))
        rest.remove(first)
        order.append(estimates[first].name)
        left = {key: c for key, c in left.items() if not key[first]}
    return order


def _once(df: DataFrame) -> DataFrame:
    """Keep later filters above: pushed below, they would compute every column anew."""
    return df.select(F.inline(F.array(F.struct("*"))))


def cascade(measures: DataFrame, rules: Sequence[Rule], order: Sequence[str]) -> DataFrame:
    """Add ``base_failed``, ``kept`` and ``failed_rule`` to a measured frame.

    ``failed_rule`` is the first rule in ``order`` that rejects a document, null
    where none does or the base failed; later rules are not evaluated.
    """
    by_name = {r.name: r for r in rules}
    if sorted(order) != sorted(by_name):
        raise ValueError(f"an order of {sorted(by_name)} is needed, not {list(order)}")
    first = F.when(F.col("base_failed"), F.lit(""))
    for name in order:
        first = first.when(F.coalesce(by_name[name].rejects, F.lit(False)), F.lit(name))
    return (measures.withColumn("base_failed", base_failed())
            .withColumn("failed_rule", first if order else F.when(F.col("base_failed"), F.lit("")))
            .withColumn("kept", F.col("failed_rule").isNull())
            .withColumn("failed_rule", F.nullif("failed_rule", F.lit(""))))


def judge(docs: DataFrame, rules: Sequence[Rule] | None = None,
          order: Sequence[str] | None = None) -> DataFrame:
    """``doc_id``, ``MEASURES``, ``base_failed``, ``kept``, ``failed_rule`` of every row.

    Without an ``order`` one is estimated on a sample of ``docs``; it never changes
    who is kept, only which of several rules is named and how long it takes. A
    null or empty text has no words and fails the base; repeated rows give
    repeated rows; an empty table gives an empty one; further columns are ignored.
    """
    rules = standard_rules() if rules is None else list(rules)
    if order is None:
        order = best_order(*estimate(sample_of(docs), rules))
    return _once(cascade(measured(docs.select("doc_id", "text")), rules, order).select(
        "doc_id", *MEASURES, "base_failed", "kept", "failed_rule"))


def keep_good(docs: DataFrame, rules: Sequence[Rule] | None = None,
              order: Sequence[str] | None = None) -> DataFrame:
    """The rows of ``docs`` that pass the base and every rule, all columns as they are."""
    rules = standard_rules() if rules is None else list(rules)
    if order is None:
        order = best_order(*estimate(sample_of(docs), rules))
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                      F.col("text"))
    return _once(cascade(measured(row), rules, order).select("row", "kept")).where(
        "kept").select("row.*")
