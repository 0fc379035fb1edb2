"""Language identification by a mixture of languages, fitted per document by EM.

A document is a bag of character trigrams drawn from a mixture of languages.
Languages enter its set one by one while the penalised log-likelihood (half the
log of the number of trigrams per further proportion) improves; expectation
maximisation estimates the proportions. The largest proportion gives the
language and the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from croptide.llm.words import chunks, text_buffers

SAMPLE = 4000  # documents per language, about, that the model is fitted on
GRAM_BITS = 16  # trigrams are hashed to this many bits
FEATURES = 2048  # trigrams that tell languages apart best
ROUNDS = 12  # EM steps at most
SMOOTHING = 0.5
UNKNOWN = "und"

_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document and hashed trigram of every position, and whether a document has letters.

    Lower case; runs of other characters than letters count as one space, and
    every text is framed by spaces.
    """
    framed = [f" {t.lower()} " for t in texts]
    sizes = np.fromiter(map(len, framed), np.int64, len(framed))
    points = np.frombuffer("".join(framed).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    doc = np.repeat(np.arange(len(framed)), sizes)
    points = np.where(letter, points, np.uint32(0x20))
    first = np.zeros(len(points), dtype=bool)
    first[np.cumsum(sizes) - sizes] = True
    keep = letter | first
    keep[1:] |= letter[:-1]
    points, doc, letter = points[keep].astype(np.uint64), doc[keep], letter[keep]
    lettered = np.bincount(doc, weights=letter, minlength=len(framed)) > 0
    if len(points) < 3:
        none = np.zeros(0, np.int64)
        return none, none, lettered
    h = (points[:-2] * np.uint64(0x9E3779B97F4A7C15)
         ^ points[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
         ^ points[2:] * np.uint64(0x165667B19E3779F9))
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    gram = (h >> np.uint64(64 - GRAM_BITS)).astype(np.int64)
    whole = doc[:-2] == doc[2:]
    return doc[:-2][whole], gram[whole], lettered


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[str]]]:
    column = batch.column("text")
    offsets, _ = text_buffers(column)
    for a, b in chunks(offsets):
        yield a, b, [t or "" for t in column.slice(a, b - a).to_pylist()]


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts per language of a batch."""
    for batch in batches:
        langs, where = np.unique(np.array(batch.column("lang").to_pylist(), dtype=object),
                                 return_inverse=True)
        total = np.zeros((len(langs), 1 << GRAM_BITS), dtype=np.int64)
        for a, b, texts in _texts(batch):
            doc, gram, _ = _grams(texts)
            np.add.at(total, (where[a:b][doc], gram), 1)
        lang, gram = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs[lang], pa.string()), pa.array(gram), pa.array(total[lang, gram])],
            ["lang", "gram", "n"])


@dataclass
class LanguageModel:
    """Log-likelihoods of the chosen trigrams per language, and the languages' shares."""

    languages: list[str]
    share: np.ndarray
    feature: np.ndarray  # of each hashed trigram, -1 if not chosen
    likelihood: np.ndarray  # features x languages
    typical: np.ndarray  # trigrams x languages: log rate less that of the language's own texts

    @classmethod
    def from_counts(cls, languages: list[str], docs: np.ndarray, counts: np.ndarray
                    ) -> LanguageModel:
        """``counts`` is languages x trigrams."""
        rate = counts + SMOOTHING
        rate = rate / rate.sum(axis=1, keepdims=True)
        # How much a trigram says about the language, all languages alike.
        mean = rate.mean(axis=0)
        gain = (rate * np.log(rate / mean)).sum(axis=0)
        chosen = np.sort(np.argsort(-gain, kind="stable")[:FEATURES])
        feature = np.full(counts.shape[1], -1, dtype=np.int64)
        feature[chosen] = np.arange(len(chosen))
        own = rate[:, chosen] / rate[:, chosen].sum(axis=1, keepdims=True)
        logs, shares = np.log(rate), counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
        typical = logs - (shares * logs).sum(axis=1, keepdims=True)
        return cls(languages, docs / docs.sum(), feature, own.T.copy(),
                   typical.T.astype(np.float32))


def _mixtures(model: LanguageModel, doc: np.ndarray, feature: np.ndarray, n: np.ndarray,
              docs: int) -> np.ndarray:
    """Language proportions per document, from its feature counts (sorted by ``doc``)."""
    langs = len(model.languages)
    share = np.tile(model.share, (docs, 1))
    if not len(doc):
        return share
    rows, starts = np.unique(doc, return_index=True)
    row = np.repeat(np.arange(len(rows)), np.diff(np.append(starts, len(doc))))
    p = model.likelihood[feature]
    total = np.add.reduceat(n, starts)
    single = np.add.reduceat(np.log(p) * n[:, None], starts, axis=0)
    best = single.argmax(axis=1)  # ties: the first in order
    fit = np.zeros((len(rows), langs))
    fit[np.arange(len(rows)), best] = 1
    score = single[np.arange(len(rows)), best]
    active = np.arange(len(rows))  # documents whose set may still grow
    while len(active) and langs > 1:
        live = np.zeros(len(rows), dtype=bool)
        live[active] = True
        part = np.flatnonzero(live[row])
        sub_row = np.cumsum(live)[row[part]] - 1
        sub_start = np.flatnonzero(np.append(True, sub_row[1:] != sub_row[:-1]))
        sub_p, sub_n = p[part], n[part]
        # The language that raises the likelihood fastest joins the set.
        mixed = (sub_p * fit[active][sub_row]).sum(axis=1)
        slope = np.add.reduceat(sub_p * (sub_n / mixed)[:, None], sub_start, axis=0)
        slope[fit[active] > 0] = -np.inf
        join = slope.argmax(axis=1)
        open_ = np.isfinite(slope.max(axis=1)) & (slope.max(axis=1) > total[active])
        trial = fit[active] * 0.8
        trial[np.arange(len(active)), join] += 0.2
        for _ in range(ROUNDS):
            weighted = sub_p * trial[sub_row]
            weighted *= (sub_n / weighted.sum(axis=1))[:, None]
            trial = np.add.reduceat(weighted, sub_start, axis=0) / total[active][:, None]
        mixed = (sub_p * trial[sub_row]).sum(axis=1)
        reached = np.add.reduceat(np.log(mixed) * sub_n, sub_start)
        better = open_ & (reached - score[active] > 0.5 * np.log(np.maximum(total[active], 2)))
        fit[active[better]] = trial[better]
        score[active[better]] = reached[better]
        active = active[better]
        active = active[(fit[active] > 0).sum(axis=1) < langs]
    share[rows] = fit
    return share


def _predict_batches(batches: Iterator[pa.RecordBatch], held, explained: bool
                     ) -> Iterator[pa.RecordBatch]:
    """Adds ``lang_pred`` and ``score``, and ``fit`` if ``explained``."""
    model = LanguageModel(*held.value)
    names = np.array([*model.languages, UNKNOWN], dtype=object)
    for batch in batches:
        predicted, scores, fits = [], [], []
        for _, _, texts in _texts(batch):
            doc, gram, lettered = _grams(texts)
            all_docs, all_grams = doc, gram
            feature = model.feature[gram]
            doc, feature = doc[feature >= 0], feature[feature >= 0]
            pair, n = np.unique(doc * FEATURES + feature, return_counts=True)
            share = _mixtures(model, pair // FEATURES, pair % FEATURES, n.astype(float),
                              len(texts))
            known = lettered & (share.shape[1] > 0)
            top = share.argmax(axis=1) if share.shape[1] else np.zeros(len(texts), int)
            score = share.max(axis=1) if share.shape[1] else np.zeros(len(texts))
            predicted += names[np.where(known, top, len(model.languages))].tolist()
            scores.append(np.where(known, np.clip(score, 0, 1), 0.0))
            if explained:
                told = known[all_docs]
                mean = np.bincount(all_docs[told], minlength=len(texts), weights=model.typical[
                    all_grams[told], top[all_docs[told]]])
                n = np.bincount(all_docs[told], minlength=len(texts))
                fits.append(np.where(n > 0, mean / np.maximum(n, 1), np.nan))
        columns = [*(batch.column(c) for c in batch.schema.names), pa.array(predicted, pa.string()),
                   pa.array(np.concatenate([np.zeros(0), *scores]))]
        names_out = [*batch.schema.names, "lang_pred", "score"]
        if explained:
            columns.append(pa.array(np.concatenate([np.zeros(0), *fits]), from_pandas=True))
            names_out.append("fit")
        yield pa.RecordBatch.from_arrays(columns, names_out)


def fit(labelled: DataFrame, sample: int = SAMPLE) -> LanguageModel:
    """Fit a model on ``(doc_id, text, lang)``; rows without language or text don't count.

    About ``sample`` documents per language are used, chosen by a hash of id
    and text; a language with fewer gives all of them.
    """
    labelled = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select(
        "doc_id", "text", "lang")
    sizes = sorted((r["lang"], r["n"]) for r in labelled.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n")).collect())
    spark = labelled.sparkSession
    share = spark.createDataFrame(
        [(lang, min(1.0, sample / n)) for lang, n in sizes], "lang string, part double")
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    chosen = labelled.join(F.broadcast(share), "lang").where(draw < F.col("part"))
    counts = (chosen.select("lang", "text").mapInArrow(_count_batches,
                                                       "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow())
    names = [lang for lang, _ in sizes]
    place = {lang: i for i, lang in enumerate(names)}
    table = np.zeros((len(names), 1 << GRAM_BITS))
    if counts.num_rows:
        rows = np.array([place[x] for x in counts["lang"].to_pylist()])
        table[rows, counts["gram"].to_numpy()] = counts["n"].to_numpy()
    docs = np.array([n for _, n in sizes], dtype=float)
    return LanguageModel.from_counts(names, docs, table) if names else LanguageModel(
        [], np.zeros(0), np.full(1 << GRAM_BITS, -1), np.zeros((FEATURES, 0)),
        np.zeros((1 << GRAM_BITS, 0), np.float32))


def predict(docs: DataFrame, model: LanguageModel, explained: bool = False) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1), judged by ``text`` alone.

    ``und`` with score 0 when the text is null or has no letter, or nothing was
    learned. A text without any of the model's trigrams gets the most frequent
    language with its share as score. Ties go to the first language in order.
    Existing columns of the two names are replaced; repeated rows give repeated
    rows; an empty table gives an empty one.

    ``explained`` adds ``fit``: how much less likely the text's trigrams, all of
    them, are in the language than those of its own texts, as the mean difference
    of their logarithms. Text of the language is near 0, whatever its length; text
    in no learned language is far below. Null where ``lang_pred`` is ``und``.
    """
    kept = docs.select(*(F.col(f"`{c}`") for c in docs.columns
                         if c.lower() not in ("lang_pred", "score", *["fit"] * explained)))
    # Plain values: broadcasts are pickled by reference to their classes.
    held = docs.sparkSession.sparkContext.broadcast(
        (model.languages, model.share, model.feature, model.likelihood, model.typical))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields]
                       + ["lang_pred string", "score double", *["fit double"] * explained])
    return kept.mapInArrow(partial(_predict_batches, held=held, explained=explained), schema)


def held_out(docs: DataFrame):
    """Whether a document is kept from learning: crc32 of its id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0,
                      F.lit(False))
