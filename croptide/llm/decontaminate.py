"""Benchmark decontamination with SimHash over item-sized windows.

Every window of a document that is as long as a benchmark item is a candidate;
a document shorter than the item is one window as a whole.
Windows that cannot reach the similarity, because too few of their shingles
occur in any item, go first (a bound, nothing is lost). The others get a
SimHash; an index of the items' fingerprints over ``radius + 1`` blocks of bits
finds every item within ``radius`` (two fingerprints that differ in at most
``radius`` bits agree in one block at least), and the exact weighted Jaccard
similarity of the shingles decides.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from croptide.llm.words import Words, chunks, text_buffers, window_hashes, window_starts

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 18  # pairs at similarity 0.8 differ in 9.7 +- 2.9 of 64 bits
SLICE_BYTES = 16 << 20  # of benchmark text that tasks hold at a time

#: Letters, digits and bytes of other alphabets are kept, the rest separates words.
_KEPT = np.zeros(256, dtype=bool)
_KEPT[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _normal_words(offsets: np.ndarray, data: np.ndarray) -> Words:
    """Words of lower-cased text without ASCII punctuation."""
    return Words.split(offsets, _LOWER[data], ~_KEPT)


def _shingles(hashes: np.ndarray, length: int) -> np.ndarray:
    """Shingle hashes from every word; a text shorter than a shingle is one."""
    return window_hashes(hashes, min(SHINGLE, length))


def _fingerprint(total: np.ndarray, start: np.ndarray, n: int) -> np.ndarray:
    """SimHash of ``n`` consecutive shingles, from cumulative bit counts."""
    ones = total[start + n] - total[start]
    return np.packbits(ones * 2 > n, axis=1).view(">u8").ravel().astype(np.uint64)


def _bit_totals(shingles: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(shingles.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    total = np.zeros((len(bits) + 1, 64), dtype=np.int32)
    np.cumsum(bits, axis=0, out=total[1:])
    return total


class ItemIndex:
    """Items of one benchmark slice by length, with a block index per length."""

    def __init__(self, ids: list, texts: list, radius: int = RADIUS):
        self.radius = radius
        edges = np.linspace(0, 64, radius + 2).astype(int)
        self.blocks = [(np.uint64(lo), np.uint64((1 << int(hi - lo)) - 1))
                       for lo, hi in zip(edges[:-1], edges[1:], strict=True)]
        by_length: dict[int, list] = {}
        for item, text in zip(ids, texts, strict=True):
            data = np.frombuffer(text.encode(), np.uint8)
            hashes = _normal_words(np.array([0, len(data)]), data).hashes()
            if len(hashes):
                own = _shingles(hashes, len(hashes))
                by_length.setdefault(len(hashes), []).append((item, own))
        self.lengths = {}
        for length, items in sorted(by_length.items()):
            fps = np.concatenate([_fingerprint(_bit_totals(s), np.zeros(1, int), len(s))
                                  for _, s in items])
            table = []
            for shift, mask in self.blocks:
                held: dict[int, list] = {}
                for k, value in enumerate(((fps >> shift) & mask).tolist()):
                    held.setdefault(value, []).append(k)
                table.append({v: np.array(k) for v, k in held.items()})
            self.lengths[length] = ([i for i, _ in items], fps, table,
                                    [Counter(s.tolist()) for _, s in items])
        sizes = sorted({min(SHINGLE, n) for n in self.lengths})
        self.known = {size: np.unique(np.concatenate(
            [np.array(list(c), dtype=np.uint64) for n, (_, _, _, counts) in self.lengths.items()
             if min(SHINGLE, n) == size for c in counts])) for size in sizes}
        self.marked = {}
        for size, known in self.known.items():
            bits = 1 << max(16, 6 + len(known).bit_length())
            self.marked[size] = np.zeros(bits, dtype=bool)
            self.marked[size][known & np.uint64(bits - 1)] = True

    def knows(self, size: int, shingles: np.ndarray) -> np.ndarray:
        """Which shingles occur in an item with shingles of ``size`` words."""
        marked, known = self.marked[size], self.known[size]
        out = marked[shingles & np.uint64(len(marked) - 1)]
        rows = np.flatnonzero(out)
        at = np.minimum(np.searchsorted(known, shingles[rows]), len(known) - 1)
        out[rows] = known[at] == shingles[rows]
        return out

    def near(self, length: int, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (window, item) within the radius."""
        _, own, table, _ = self.lengths[length]
        pairs = [np.zeros(0, np.int64)]
        for (shift, mask), held in zip(self.blocks, table, strict=True):
            values, back = np.unique((fps >> shift) & mask, return_inverse=True)
            for k, value in enumerate(values.tolist()):
                if value in held:
                    rows = np.flatnonzero(back == k)
                    pairs.append((rows[:, None] * len(own) + held[value]).ravel())
        pair = np.unique(np.concatenate(pairs))
        window, item = pair // len(own), pair % len(own)
        close = np.bitwise_count(fps[window] ^ own[item]) <= self.radius
        return window[close], item[close]


def _weighted_jaccard(a: Counter, b: Counter) -> float:
    """Sum of the smaller over the sum of the larger weights (occurrences)."""
    shared = sum((a & b).values())
    return shared / (sum(a.values()) + sum(b.values()) - shared)


def _search(words: Words, hashes: np.ndarray, doc: int, index: ItemIndex, marks: dict,
            similarity: float) -> dict:
    """Best ``(similarity, start)`` per item of one document."""
    lo, hi = int(words.first[doc]), int(words.first[doc + 1])
    best: dict = {}
    cached: dict = {}
    for length, (items, _, _, weights) in index.lengths.items():
        size = min(SHINGLE, length)
        n = length - size + 1
        # A document shorter than the item is one window of fewer shingles.
        width = min(hi - lo, length)
        m = width - size + 1
        if m < max(1.0, similarity * n - 1e-9):
            continue
        if size not in cached:
            own = window_hashes(hashes[lo:hi], size)
            known = np.append(0, np.cumsum(marks[size][lo:lo + len(own)]))
            cached[size] = (own, known, None)
        own, known, total = cached[size]
        # Of m and n shingles similarity s needs (m + n)s / (1 + s) in common.
        least = (m + n) * similarity / (1 + similarity) - 1e-9
        start = np.flatnonzero(known[m:] - known[:-m] >= least)
        if not len(start):
            continue
        if total is None:
            total = _bit_totals(own)
            cached[size] = (own, known, total)
        window, item = index.near(length, _fingerprint(total, start, m))
        for w, k in zip(window.tolist(), item.tolist(), strict=True):
            s = int(start[w])
            score = _weighted_jaccard(Counter(own[s:s + m].tolist()), weights[k])
            if score >= similarity and score > best.get(items[k], (0.0, 0, 0))[0]:
                best[items[k]] = (score, s, width)
    return best


def _found(batch: pa.RecordBatch, index: ItemIndex, similarity: float
           ) -> Iterator[tuple[int, dict]]:
    """Rows of a batch with the items found in them."""
    offsets, data = text_buffers(batch.column("text"))
    for a, b in chunks(offsets):
        words = _normal_words(offsets[a:b + 1] - offsets[a], data[offsets[a]:offsets[b]])
        hashes = words.hashes()
        marks, touched = {}, np.zeros(b - a, dtype=bool)
        for size in index.known:
            own = window_hashes(hashes, size)
            marks[size] = index.knows(size, own) & window_starts(words.first, size)[:len(own)]
            total = np.append(0, np.cumsum(marks[size]))
            edges = np.minimum(words.first, len(own))
            touched |= total[edges[1:]] > total[edges[:-1]]
        for doc in np.flatnonzero(touched).tolist():
            if found := _search(words, hashes, doc, index, marks, similarity):
                yield a + doc, found


def _match_batches(batches: Iterator[pa.RecordBatch], held, similarity: float
                   ) -> Iterator[pa.RecordBatch]:
    index = ItemIndex(*held.value)
    for batch in batches:
        ids = batch.column("doc_id")
        out = [(ids[row].as_py(), item, *hit) for row, found in _found(batch, index, similarity)
               for item, hit in found.items()]
        if out:
            columns = list(zip(*out, strict=True))
            types = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                ["doc_id", "item_id", "similarity", "start", "n_words"])


def _clean_batches(batches: Iterator[pa.RecordBatch], held, similarity: float
                   ) -> Iterator[pa.RecordBatch]:
    index = ItemIndex(*held.value)
    for batch in batches:
        clean = np.ones(batch.num_rows, dtype=bool)
        clean[[row for row, _ in _found(batch, index, similarity)]] = False
        yield batch.filter(pa.array(clean))


MATCHES = "doc_id long, item_id long, similarity double, start long, n_words long"


def _slices(benchmark: DataFrame) -> Iterator[Broadcast]:
    """The benchmark's items in broadcast slices of about ``SLICE_BYTES`` of text.

    One slice, empty perhaps, when the benchmark is no larger.
    """
    items = benchmark.where("text IS NOT NULL").select(
        F.col("item_id").cast("long"), "text").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(1, -(-int(size) // SLICE_BYTES))
    placed = items.withColumn("slice", F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)))
    for k in range(slices):
        part = placed.where(F.col("slice") == k).orderBy("item_id", "text").toArrow()
        yield benchmark.sparkSession.sparkContext.broadcast(
            (part["item_id"].to_pylist(), part["text"].to_pylist()))


def contaminations(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY
                   ) -> DataFrame:
    """``(doc_id, item_id, similarity, start, n_words)``: the items found in documents.

    One row per row of ``docs`` and item whose best window reaches
    ``similarity``: the weighted Jaccard similarity of shingles of five words
    (weights are occurrences; lower case, ASCII punctuation separates words).
    ``start`` is the first such window's word, ``n_words`` its length: the item's,
    or the document's if that is shorter. Items of fewer than five words match as
    a whole. Null and empty texts and items match
    nothing; a null ``doc_id`` or ``item_id`` is carried along; repeated rows of
    ``docs`` are repeated, repeated items are not; empty tables give an empty
    one; further columns are ignored.

    Tasks hold the benchmark in slices of ``SLICE_BYTES``, each with a pass over
    the documents; usually there is one.
    """
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    parts = [texts.mapInArrow(partial(_match_batches, held=held, similarity=similarity), MATCHES)
             for held in _slices(benchmark)]
    return reduce(DataFrame.unionByName, parts)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame,
                        similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns."""
    for held in _slices(benchmark):
        docs = docs.mapInArrow(partial(_clean_batches, held=held, similarity=similarity),
                               docs.schema)
    return docs
