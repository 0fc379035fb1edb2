"""Repeated passages: anchored by fixed blocks, extended to exact repeats, removed.

Every window of 13 words holds a block of 7 words that starts at a multiple of
7. So the non-overlapping blocks of each document are indexed, every rolling
window of 7 words of every document probes them, and only around hits are windows
of 13 words looked at. Their hashes (72 bits and more) tell the smallest document
that has the same window; chains of such windows are the maximal exact repeats.

Exchanges carry packed hashes per bucket instead of one row per window, and
answers come back packed per group of documents, where they meet the texts. The
number of buckets and groups follows the size of the text, not of any key.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from croptide.llm.storage import release, stage
from croptide.llm.words import Words, chunks, mix, text_buffers, window_hashes, window_starts

WINDOW = 13
BUCKET_BYTES = 32 << 20  # of text per bucket; its index takes a few times as much memory
PACK_BYTES = 4 << 20  # of text whose hashes are packed together
SIEVE_SLOTS = 1 << 18  # words of 64 bits that may be broadcast

PACKED = "bucket int, kind byte, docs binary, counts binary, keys binary"


def block_size(window: int) -> int:
    """The largest block of which every window holds an aligned one."""
    return (window + 1) // 2


def _bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """A bucket by a second mix, independent of the low 32 bits of the key."""
    return (mix(keys ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(buckets)).astype(np.int64)


def _group_of(docs: np.ndarray, groups: int) -> np.ndarray:
    """The group of documents that answers for a document are sent to."""
    return (mix(docs.view(np.uint64)) % np.uint64(groups)).astype(np.int64)


def _pack(docs: np.ndarray, keys: np.ndarray, kinds: np.ndarray, bucket: np.ndarray, width: type
          ) -> Iterator[pa.RecordBatch]:
    """One row per bucket and kind: documents, keys per document, the keys."""
    if not len(keys):
        return
    order = np.lexsort((docs, kinds, bucket))
    bucket, kinds, docs, keys = bucket[order], kinds[order], docs[order], keys[order]
    cut = np.flatnonzero((bucket[1:] != bucket[:-1]) | (kinds[1:] != kinds[:-1])) + 1
    rows = []
    for lo, hi in zip([0, *cut], [*cut, len(keys)], strict=True):
        at = np.flatnonzero(np.append(True, docs[lo + 1:hi] != docs[lo:hi - 1]))
        counts = np.diff(np.append(at, hi - lo)).astype(np.uint32)
        rows.append((int(bucket[lo]), int(kinds[lo]), docs[lo:hi][at].tobytes(),
                     counts.tobytes(), keys[lo:hi].astype(width).tobytes()))
    columns = list(zip(*rows, strict=True))
    types = (pa.int32(), pa.int8(), pa.binary(), pa.binary(), pa.binary())
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
        ["bucket", "kind", "docs", "counts", "keys"])


def _unpack(row: dict, width: type) -> tuple[np.ndarray, np.ndarray]:
    docs = np.frombuffer(row["docs"], np.int64)
    counts = np.frombuffer(row["counts"], np.uint32)
    return np.repeat(docs, counts), np.frombuffer(row["keys"], width)


class _Packer:
    """Gathers keys until their text has ``PACK_BYTES``, then sends them to buckets."""

    def __init__(self, buckets: int, width: type):
        self.buckets, self.width = buckets, width
        self.parts, self.size = [], 0

    def add(self, docs, keys, kind, size) -> Iterator[pa.RecordBatch]:
        if len(keys):
            self.parts.append((docs, keys, np.full(len(keys), kind, np.int8)))
        self.size += size
        if self.size >= PACK_BYTES:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            docs, keys, kinds = (np.concatenate(c) for c in zip(*self.parts, strict=True))
            yield from _pack(docs, keys, kinds, _bucket_of(keys, self.buckets), self.width)
        self.parts, self.size = [], 0


class _Answers:
    """Gathers answers (document, key) and sends them to groups of documents."""

    def __init__(self, groups: int):
        self.groups, self.parts, self.size = groups, [], 0

    def add(self, docs, keys) -> Iterator[pa.RecordBatch]:
        if len(docs):
            self.parts.append((docs, keys))
            self.size += len(docs)
        if self.size >= 1 << 20:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            docs, keys = (np.concatenate(c) for c in zip(*self.parts, strict=True))
            yield from _pack(docs, keys, np.zeros(len(docs), np.int8),
                             _group_of(docs, self.groups), np.uint64)
        self.parts, self.size = [], 0


def _hashed(batch: pa.RecordBatch) -> Iterator[tuple[int, int, Words, np.ndarray]]:
    offsets, data = text_buffers(batch.column("text"))
    for a, b in chunks(offsets):
        own = offsets[a:b + 1] - offsets[a]
        words = Words.split(own, data[offsets[a]:offsets[b]])
        yield a, b, words, words.hashes()


def _anchor_batches(batches: Iterator[pa.RecordBatch], window: int, buckets: int
                    ) -> Iterator[pa.RecordBatch]:
    """Kind 0: aligned blocks; kind 1: every rolling window of a block's size."""
    size = block_size(window)
    packer = _Packer(buckets, np.uint32)
    for batch in batches:
        ids = batch.column("doc_id").to_numpy()
        for a, b, words, hashes in _hashed(batch):
            keys = window_hashes(hashes, size)
            counts = words.counts()
            doc = np.repeat(np.arange(b - a), counts)[:len(keys)]
            place = np.arange(len(keys)) - words.first[doc]
            usable = window_starts(words.first, size)[:len(keys)] & (counts[doc] >= window)
            aligned = usable & (place % size == 0)
            yield from packer.add(ids[a:b][doc[aligned]], keys[aligned], 0, 0)
            yield from packer.add(ids[a:b][doc[usable]], keys[usable], 1, len(words.data))
    yield from packer.flush()


def _least(docs: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the smallest document of each."""
    order = np.lexsort((docs, keys))
    keys, docs = keys[order], docs[order]
    new = np.append(True, keys[1:] != keys[:-1])
    return keys[new], docs[new]


def _later(index, docs, keys) -> np.ndarray:
    """Whether a smaller document has the key."""
    at = np.minimum(np.searchsorted(index[0], keys), len(index[0]) - 1)
    return (index[0][at] == keys) & (index[1][at] < docs)


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    """Rows of each bucket; they come sorted by bucket and kind."""
    bucket, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] != bucket:
                if rows:
                    yield bucket, rows
                bucket, rows = row["bucket"], []
            rows.append(row)
    if rows:
        yield bucket, rows


def _hit_batches(batches: Iterator[pa.RecordBatch], groups: int) -> Iterator[pa.RecordBatch]:
    """The blocks of each document that another one has: probes with a smaller holder
    of the block, and holders whose block a later document probed with success.

    A bucket's packed rows are held, which is a few bytes per word of its text.
    """
    answers = _Answers(groups)
    for bucket, rows in _by_bucket(batches):
        held = [_unpack(r, np.uint32) for r in rows if r["kind"] == 0]
        if not held:
            continue
        docs, keys = (np.concatenate(c) for c in zip(*held, strict=True))
        index, high, hit = _least(docs, keys), np.uint64(bucket << 32), []
        for row in rows:
            if row["kind"]:
                d, k = _unpack(row, np.uint32)
                found = _later(index, d, k)
                hit.append(np.unique(k[found]))
                yield from answers.add(d[found], k[found].astype(np.uint64) | high)
        own = np.isin(keys, np.unique(np.concatenate(hit))) if hit else np.zeros(0, bool)
        if own.any():
            yield from answers.add(docs[own], keys[own].astype(np.uint64) | high)
    yield from answers.flush()


def _repeat_batches(batches: Iterator[pa.RecordBatch], groups: int) -> Iterator[pa.RecordBatch]:
    """The windows of each document that a smaller document has too."""
    answers = _Answers(groups)
    for _, rows in _by_bucket(batches):
        docs, keys = (np.concatenate(c) for c in
                      zip(*(_unpack(r, np.uint64) for r in rows), strict=True))
        index = _least(docs, keys)
        del docs, keys
        for row in rows:
            docs, keys = _unpack(row, np.uint64)
            found = _later(index, docs, keys)
            yield from answers.add(docs[found], keys[found])
    yield from answers.flush()


def _tagged(docs: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """One 64-bit value per document and key, to look pairs up by."""
    return mix(keys ^ mix(docs.view(np.uint64) + np.uint64(1)))


def _with_answers(batches: Iterator[pa.RecordBatch]
                  ) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Text rows with the sorted pairs answered for their group (answers come first)."""
    group, parts, known = None, [], np.zeros(0, np.uint64)
    for batch in batches:
        groups, kinds = batch.column("bucket").to_numpy(), batch.column("kind").to_numpy()
        cut = np.flatnonzero((groups[1:] != groups[:-1]) | (kinds[1:] != kinds[:-1])) + 1
        for lo, hi in zip([0, *cut], [*cut, len(groups)], strict=True):
            if hi == lo:
                continue
            if groups[lo] != group:
                group, parts, known = groups[lo], [], np.zeros(0, np.uint64)
            part = batch.slice(lo, hi - lo)
            if kinds[lo] == 0:
                for row in part.select(["docs", "counts", "keys"]).to_pylist():
                    parts.append(_tagged(*_unpack(row, np.uint64)))
                continue
            if parts:
                known = np.unique(np.concatenate([known, *parts]))
                parts = []
            yield part, known


def _among(known: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), dtype=bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _candidate_batches(batches: Iterator[pa.RecordBatch], window: int, buckets: int
                       ) -> Iterator[pa.RecordBatch]:
    """The windows around the hits of each document."""
    size = block_size(window)
    packer = _Packer(buckets, np.uint64)
    for batch, known in _with_answers(batches):
        ids = batch.column("doc_id").to_numpy()
        for a, b, words, hashes in _hashed(batch):
            keys = window_hashes(hashes, size)
            docs = np.repeat(ids[a:b], words.counts())
            code = (keys & np.uint64(0xFFFFFFFF)) | (
                _bucket_of(keys, buckets).astype(np.uint64) << np.uint64(32))
            at = np.flatnonzero(_among(known, _tagged(docs[:len(keys)], code))
                                & window_starts(words.first, size)[:len(keys)])
            low = np.repeat(words.first[:-1], words.counts())[at]
            near = np.zeros(len(hashes) + 1, dtype=np.int64)
            np.add.at(near, np.maximum(at - (window - size), low), 1)
            np.add.at(near, at + 1, -1)
            whole = window_hashes(hashes, window)
            inside = window_starts(words.first, window)[:len(whole)]
            chosen = np.flatnonzero((np.cumsum(near[:-1])[:len(whole)] > 0) & inside)
            yield from packer.add(docs[chosen], whole[chosen], 0, len(words.data))
    yield from packer.flush()


def _removal_batches(batches: Iterator[pa.RecordBatch], window: int, columns: list[str],
                     spaced: bool) -> Iterator[pa.RecordBatch]:
    """Word counts and the text that stays, per document."""
    for batch, known in _with_answers(batches):
        ids = batch.column("doc_id").fill_null(0).to_numpy()
        n_words, n_removed, kept = [], [], []
        texts = batch.column("text")
        for a, b, words, hashes in _hashed(batch):
            blob, counts = words.data.tobytes(), words.counts()
            gone = np.zeros(len(hashes), dtype=bool)
            if len(known):
                whole = window_hashes(hashes, window)
                docs = np.repeat(ids[a:b], counts)[:len(whole)]
                at = np.flatnonzero(_among(known, _tagged(docs, whole))
                                    & window_starts(words.first, window)[:len(whole)])
                covered = np.zeros(len(hashes) + 1, dtype=np.int64)
                np.add.at(covered, at, 1)
                np.add.at(covered, at + window, -1)
                gone = np.cumsum(covered[:-1]) > 0
            total = np.append(0, np.cumsum(gone))
            removed = total[words.first[1:]] - total[words.first[:-1]]
            for i, n in enumerate(removed.tolist()):
                lo, hi = int(words.first[i]), int(words.first[i + 1])
                if n:
                    stay = np.flatnonzero(~gone[lo:hi]) + lo
                    kept.append(b" ".join([blob[s:e] for s, e in zip(
                        words.start[stay].tolist(), words.end[stay].tolist(), strict=True)]))
                elif not spaced:
                    kept.append((texts[a + i].as_py() or "").encode())
                else:
                    kept.append(b" ".join(blob[words.start[lo]:words.end[hi - 1]].split())
                                if hi > lo else b"")
            n_words += counts.tolist()
            n_removed += removed.tolist()
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in columns), pa.array(n_words, pa.int64()),
             pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
            [*columns, "n_words", "n_removed", "kept_text"])


def _sieve(docs: DataFrame, wanted: DataFrame) -> tuple[DataFrame, Column]:
    """``docs`` with a column that is false only for ids that aren't ``wanted``.

    Ids are hashed to bits of at most ``SIEVE_SLOTS`` words, a table whose size is
    bounded whatever the number of ids; where it fills up, more rows pass.
    """
    def place(doc_id: Column) -> tuple[Column, Column]:
        h = F.xxhash64(doc_id, F.lit(7))
        return F.pmod(h, F.lit(SIEVE_SLOTS)), F.pmod(F.shiftright(h, 32), F.lit(64)).cast("int")

    slot, bit = place(F.col("doc_id"))
    words = wanted.groupBy(slot.alias("_slot")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("_bits"))
    marked = docs.join(F.broadcast(words), slot == F.col("_slot"), "left")
    return marked, F.coalesce(F.getbit("_bits", bit) == 1, F.lit(False))


def _answered(packed: DataFrame, groups: int) -> DataFrame:
    """The distinct documents of packed answers."""
    def ids(batches):
        known = np.zeros(0, np.int64)
        for batch in batches:
            docs = [np.frombuffer(d, np.int64) for d in batch.column("docs").to_pylist()]
            known = np.unique(np.concatenate([known, *docs]))
        yield pa.RecordBatch.from_arrays([pa.array(known)], ["doc_id"])

    return (packed.select("bucket", "docs").repartition(groups, "bucket").select("docs")
            .mapInArrow(ids, "doc_id long"))


def _meet(texts: DataFrame, answers: DataFrame, groups: int) -> DataFrame:
    """Answers and texts of each group together, answers first."""
    # The tasks know a group by the same mix that packed the answers.
    def grouped(batches):
        for batch in batches:
            ids = batch.column("doc_id").fill_null(0).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(_group_of(ids, groups).astype(np.int32)),
                 pa.array(np.ones(len(ids), np.int8)), *batch.columns],
                ["bucket", "kind", *batch.schema.names])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema.fields)
    rows = texts.mapInArrow(grouped, f"bucket int, kind byte, {fields}")
    return (rows.unionByName(answers, allowMissingColumns=True)
            .repartition(groups, "bucket").sortWithinPartitions("bucket", "kind"))


def _groups(texts: DataFrame) -> int:
    """Buckets of ``BUCKET_BYTES`` of text, one per shuffle partition at least."""
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(tasks, -(-int(total) // BUCKET_BYTES))


def repeated_windows(texts: DataFrame, window: int, groups: int) -> DataFrame:
    """Packed answers per group: hashes of the windows that a smaller ``doc_id`` has."""
    spark = texts.sparkSession

    def by_bucket(packed: DataFrame) -> DataFrame:
        return packed.repartition(groups, "bucket").sortWithinPartitions("bucket", "kind")

    anchors = texts.mapInArrow(partial(_anchor_batches, window=window, buckets=groups), PACKED)
    hits = stage(by_bucket(anchors).mapInArrow(partial(_hit_batches, groups=groups), PACKED),
                 "anchors")
    del anchors
    release(spark)
    marked, maybe = _sieve(texts, _answered(hits, groups))
    windows = _meet(marked.where(maybe).select("doc_id", "text"), hits, groups).mapInArrow(
        partial(_candidate_batches, window=window, buckets=groups), PACKED)
    found = stage(by_bucket(windows).mapInArrow(partial(_repeat_batches, groups=groups), PACKED),
                  "windows")
    del marked, maybe, windows
    release(spark)
    return found


def remove_repeats(docs: DataFrame, window: int = WINDOW, spaced: bool = True) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text`` instead of ``text``.

    A word goes when it lies in a window of ``window`` words whose sequence also
    starts in a document with a smaller ``doc_id``; windows are judged on the
    input. The kept words are joined by one space; without ``spaced`` a text that
    loses nothing stays as it is. A null text has no words and gives an empty one. A
    null ``doc_id`` is smaller or larger than no other: such rows lose nothing
    and cause no removal. Rows that repeat a ``doc_id`` don't affect each other.
    An empty table gives an empty one. Columns ``n_words``, ``n_removed``,
    ``kept_text``, ``bucket``, ``kind``, ``docs``, ``counts`` and ``keys`` of the
    input are dropped. Only documents that may lose something are shuffled.
    """
    made = {"n_words", "n_removed", "kept_text", "bucket", "kind", "docs", "counts", "keys"}
    own = docs.select(*(F.col("doc_id").cast("long") if c == "doc_id" else F.col(f"`{c}`")
                        for c in docs.columns if c.lower() not in made))
    named = own.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text")
    groups = _groups(named)
    repeats = repeated_windows(named, window, groups)
    fields = [f for f in own.schema.fields if f.name != "text"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields]
                       + ["n_words long", "n_removed long", "kept_text string"])
    remove = partial(_removal_batches, window=window, columns=[f.name for f in fields],
                     spaced=spaced)
    marked, maybe = _sieve(own, _answered(repeats, groups))
    touched = marked.where(maybe & F.col("doc_id").isNotNull()).select(*own.columns)
    alone = marked.where(~(maybe & F.col("doc_id").isNotNull())).select(
        F.lit(0).alias("bucket"), F.lit(1).cast("byte").alias("kind"), *own.columns)
    return (_meet(touched, repeats, groups).mapInArrow(remove, schema)
            .unionByName(alone.mapInArrow(remove, schema)))
