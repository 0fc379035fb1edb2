"""Two tokenizers' tokens of the same text, aligned by their bytes.

Byte offsets at which a token of A and a token of B both end cut the text into
groups. They are found by divide and conquer: a common end near the middle of an
interval is located by bisection, both halves are treated in the same way, and an
interval without a common end inside is a group.

Before a single blank or line feed between two other characters there is always such
an end, as no token of either vocabulary crosses it. So texts are cut there first and
each distinct piece is encoded and divided once.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from croptide.llm.storage import stage
from croptide.llm.words import chunks, text_buffers

BLOCK_BYTES = 1 << 20  # text of the documents that are counted together (one at least)
PIECE_CACHE = 200_000  # pieces that a task remembers, and those of a block
RUN = 2_000  # pieces encoded as one text

# Pieces that begin and end so that others can come before and after them; none holds
# the character that B writes for a blank.
_JOINS = re.compile(rb"(?!.*\xe2\x96\x81)[ \n](?:[\x21-\x7e]|[\xc3-\xdf\xe4-\xf4].)"
                    rb"(?:.{0,200}(?:[\x21-\x7e]|[\xc3-\xdf][\x80-\xbf]))?", re.DOTALL)

BLANK = "▁"  # stands for a blank in B's pieces


def shared_ends(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the tokens, in A and in B, whose ends are shared; the last ones' are.

    All open intervals are halved at a time. Each tries the ends of A from its
    middle outwards, by bisection among B's; what lies on both sides of the first
    shared one are intervals of the next round, and one without is a group.
    """
    low, high = np.array([0]), np.array([len(a_ends) - 1])  # ends strictly inside
    cuts = [high]
    while len(low):
        middle, found = (low + high - 1) // 2, np.full(len(low), -1)
        far = np.maximum(middle - low, high - 1 - middle)
        step, open_ = 0, np.flatnonzero(high > low)
        while len(open_):
            for side in (-step, step) if step else (0,):
                at = middle[open_] + side
                inside = (at >= low[open_]) & (at < high[open_]) & (found[open_] < 0)
                tried, at = open_[inside], at[inside]
                shared = b_ends[np.searchsorted(b_ends, a_ends[at])] == a_ends[at]
                found[tried[shared]] = at[shared]
            step += 1
            open_ = open_[(found[open_] < 0) & (far[open_] >= step)]
        cut = found >= 0
        cuts.append(found[cut])
        low, high = (np.concatenate([low[cut], found[cut] + 1]),
                     np.concatenate([found[cut], high[cut]]))
    in_a = np.sort(np.concatenate(cuts))
    return in_a, np.searchsorted(b_ends, a_ends[in_a])


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of tokens whose bytes overlap, for two lists that end at the same offset.

    Between two neighbouring ends of either side lies one token of each.
    """
    of_a, of_b = np.zeros((2, int(a_ends[-1]) + 1), dtype=bool)
    of_a[a_ends], of_b[b_ends] = True, True
    ends = np.flatnonzero(of_a | of_b)
    of_a, of_b = of_a[ends], of_b[ends]
    return np.cumsum(of_a) - of_a, np.cumsum(of_b) - of_b


def byte_level_table() -> dict[str, int]:
    """The characters that byte-level vocabularies write for bytes.

    Printable characters of Latin-1 stand for their own byte, the other bytes in
    order for the code points from 256 on.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}


@dataclass(slots=True)
class Columns:
    """Encoded and divided pieces, one after another."""

    counts: np.ndarray  # n_a, n_b, n_groups, n_links of each; zeros: not given back whole
    links: np.ndarray  # A's id * 2**32 + B's id
    texts: list[bytes]  # groups as ``a1,a2|b1;a3|b2;``

    @classmethod
    def joined(cls, parts: list[Columns]) -> Columns:
        return cls(np.concatenate([p.counts for p in parts]),
                   np.concatenate([p.links for p in parts]), [t for p in parts for t in p.texts])

    def links_of(self, at: np.ndarray) -> np.ndarray:
        """The links of the pieces ``at``, one piece after another."""
        sizes = self.counts[:, 3]
        return self.links[_ragged((np.cumsum(sizes) - sizes)[at], sizes[at])]

    def take(self, at: np.ndarray) -> Columns:
        return Columns(self.counts[at], self.links_of(at),
                       list(map(self.texts.__getitem__, at.tolist())))


def _nothing(n: int) -> Columns:
    return Columns(np.zeros((n, 4), np.int64), np.zeros(0, np.int64), [b""] * n)


class Pieces:
    """Encoded pieces of a task; remembers short ones."""

    def __init__(self, a_definition: str, b_model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks
        self.a = Tokenizer.from_str(a_definition)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        table = byte_level_table()
        self.a_bytes = {i: bytes(table[c] for c in t) if all(c in table for c in t) else t.encode()
                        for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if BLANK in piece.lstrip(BLANK):
                raise ValueError(f"a piece crosses a blank: {piece!r}")
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i)
                                else piece.replace(BLANK, " ").encode())
        self.a_bytes = [self.a_bytes.get(i, b"") for i in range(max(self.a_bytes) + 1)]
        self.a_sizes, self.b_sizes = (np.array([len(v) for v in side])
                                      for side in (self.a_bytes, self.b_bytes))
        # Each id of A and then of B, as one that isn't and one that is its group's last.
        self.names = [f"{i}{end}" for n, ends in ((len(self.a_sizes), ",|"),
                                                  (len(self.b_sizes), ",;"))
                      for i in range(n) for end in ends]
        self.name_sizes = np.array([len(n) for n in self.names])
        self.place: dict[bytes, int] = {}  # of the remembered pieces, in their order
        self.known = _nothing(0)
        self.used, self.calls = np.zeros(0, np.int64), 0  # the last call that asked for each

    def encode(self, keys: list[bytes]) -> tuple[Columns, np.ndarray]:
        """Pieces that start with a blank, which B adds itself, or with a line feed.

        Returns columns and where each of ``keys`` is in them. Pieces are remembered
        for the next calls, but long ones; when they are too many, the half of
        ``PIECE_CACHE`` that was used last stays.
        """
        self.calls += 1
        if len(self.place) > PIECE_CACHE:
            stay = np.sort(np.argsort(self.used, kind="stable")[-(PIECE_CACHE // 2):])
            kept = list(map(list(self.place).__getitem__, stay.tolist()))
            self.place = dict(zip(kept, range(len(kept)), strict=True))
            self.known, self.used = self.known.take(stay), self.used[stay]
        new = dict.fromkeys([k for k in keys if k not in self.place])
        together = list(filter(_JOINS.fullmatch, new))
        alone = [k for k in new if not _JOINS.fullmatch(k)] if len(together) < len(new) else []
        parts = [self.known]
        for at in range(0, len(together), RUN):
            run = together[at:at + RUN]
            parts.append(self._run(run) or Columns.joined([self._alone(k) for k in run]))
        if together:
            self.place.update(zip(together, range(len(self.place), len(self.place)
                                                  + len(together)), strict=True))
            self.known = Columns.joined(parts)
            self.used = np.append(self.used, np.zeros(len(together), np.int64))
        place, every = self.place, self.known
        if alone:
            every = Columns.joined([every, *map(self._alone, alone)])
            rest = dict(zip(alone, range(len(place), len(place) + len(alone)), strict=True))
            at = np.array([place[k] if k in place else rest[k] for k in keys], dtype=np.int64)
        else:
            at = np.array(list(map(place.__getitem__, keys)), dtype=np.int64)
        self.used[at[at < len(place)]] = self.calls
        return every, at

    def _ids(self, text: str) -> tuple[list[int], list[int]]:
        # This call of the library computes no offsets, which nothing here needs.
        a = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        if text[0] == " ":
            return a, self.b.encode(text[1:], num_threads=1)
        # The blank that B puts before a line feed is a token of its own.
        return a, self.b.encode(text, num_threads=1)[1:]

    def _alone(self, key: bytes) -> Columns:
        return self._divided([key], *self._ids(key.decode("utf-8", "replace"))) or _nothing(1)

    def _run(self, keys: list[bytes]) -> Columns | None:
        try:
            return self._divided(keys, *self._ids(b"".join(keys).decode()))
        except UnicodeDecodeError:
            return None

    def _divided(self, keys: list[bytes], a: list[int], b: list[int]) -> Columns | None:
        """Pieces that follow each other in one text; None if its tokens are not those of theirs."""
        whole = b"".join(keys)
        if (b"".join(map(self.a_bytes.__getitem__, a)) != whole
                or b"".join(map(self.b_bytes.__getitem__, b)) != whole):
            return None
        a, b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        in_a, in_b = shared_ends(a_ends, b_ends)
        bounds = np.cumsum([len(k) for k in keys])
        last = np.searchsorted(a_ends[in_a], bounds)  # each piece's last group
        if (a_ends[in_a[last]] != bounds).any():
            return None
        x, y = overlaps(a_ends, b_ends)
        # Names in the order of groups, A's before B's, each with what follows it.
        ends_a, ends_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        ends_a[in_a], ends_b[in_b] = True, True
        order = np.empty(len(a) + len(b), dtype=np.int64)
        order[np.arange(len(a)) + np.append(0, in_b + 1)[np.cumsum(ends_a) - ends_a]] = (
            a * 2 + ends_a)
        order[np.arange(len(b)) + (in_a + 1)[np.cumsum(ends_b) - ends_b]] = (
            2 * len(self.a_sizes) + b * 2 + ends_b)
        names = "".join(map(self.names.__getitem__, order.tolist())).encode()
        to_a, to_b = in_a[last] + 1, in_b[last] + 1
        ends = np.cumsum(self.name_sizes[order])[to_a + to_b - 1].tolist()
        counts = np.diff(np.stack([to_a, to_b, last + 1, np.searchsorted(x, to_a)], axis=1),
                         axis=0, prepend=0)
        return Columns(counts, a[x] << 32 | b[y],
                       [names[i:j] for i, j in zip([0, *ends], ends, strict=False)])


def cut_before(data: np.ndarray) -> np.ndarray:
    """Where a single blank or line feed has other characters on both sides.

    Characters that may be Unicode white space (lead bytes C2, E1, E2, E3) are not
    told apart and count as such, which only leaves a piece longer.
    """
    n = len(data)
    cut = np.zeros(n, dtype=bool)
    if n < 3:
        return cut
    ascii_ = (data > 0x20) & (data < 0x7F)
    lead = (data >= 0xC3) & ((data < 0xE1) | (data > 0xE3))
    ends = ascii_.copy()
    ends[1:] |= (data[1:] >= 0x80) & (data[1:] < 0xC0) & (data[:-1] >= 0xC3) & (data[:-1] < 0xE0)
    here = (data == 0x20) | (data == 0x0A)
    cut[1:-1] = here[1:-1] & ends[:-2] & (ascii_ | lead)[2:]
    return cut


def pieces_of(offsets: np.ndarray, data: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Pieces of consecutive texts with a blank before each, and where each text's begin.

    A text begins with its blank, so that nothing is cut across two texts. An empty
    one has no pieces.
    """
    filled = np.diff(offsets) > 0
    data = np.insert(data, offsets[:-1][filled], 0x20)
    offsets = offsets + np.append(0, np.cumsum(filled))
    begins = offsets[:-1][filled]
    cut = cut_before(data)
    cut[begins] = True
    starts = np.flatnonzero(cut)
    ends = np.append(starts, len(data)).astype(np.int64)
    pieces = pa.Array.from_buffers(pa.large_binary(), len(starts),
                                   [None, pa.py_buffer(ends), pa.py_buffer(data)])
    return pieces, np.searchsorted(starts, offsets)


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places ``starts[k] .. starts[k] + lengths[k] - 1`` for all ``k``, one after another."""
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - before, lengths)


def _pack(values: np.ndarray) -> bytes:
    """Numbers from 0 in the least width that holds them, compressed."""
    kind = np.min_scalar_type(int(values.max(initial=0)))
    raw = values.astype(kind).tobytes()
    return struct.pack(_HEAD, kind.itemsize, len(raw)) + pa.Codec("zstd").compress(raw, asbytes=True)


def _unpack(data: bytes) -> np.ndarray:
    width, size = struct.unpack_from(_HEAD, data)
    raw = pa.Codec("zstd").decompress(data[struct.calcsize(_HEAD):], decompressed_size=size,
                                      asbytes=True)
    return np.frombuffer(raw, np.dtype(f"u{width}")).astype(np.int64)


_HEAD = "<bq"  # bytes of one number and of all
_BLOCK = ("block long, docs array<struct<doc_id: long, n_a: long, n_b: long, n_groups: long, "
          "n_links: long, groups_sha256: string, n_pieces: long>>, pieces binary, "
          "piece_links binary, piece_sizes binary, pairs array<long>, held array<long>")
_DOC = pa.struct([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                  ("n_groups", pa.int64()), ("n_links", pa.int64()),
                  ("groups_sha256", pa.string()), ("n_pieces", pa.int64())])


def _listed(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _distinct(values: np.ndarray) -> np.ndarray:
    """Sorted, each value once; sorts ``values`` in place."""
    values.sort()
    new = np.ones(len(values), dtype=bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return values[new]


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and the number of each value among them."""
    coded = pa.array(values).dictionary_encode()
    found = coded.dictionary.to_numpy()
    order = np.argsort(found)
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.arange(len(order))
    return found[order], number[coded.indices.to_numpy()]


def _block(number: int, ids: pa.Array, offsets: np.ndarray, data: np.ndarray,
           coder: Pieces) -> pa.RecordBatch:
    """One block: its documents, their pieces as codes, and how many documents hold each pair."""
    texts, first = pieces_of(offsets, data)
    coded = texts.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    pieces = Columns.take(*coder.encode(coded.dictionary.to_pylist()))
    n_a, n_b, n_groups, sizes = pieces.counts.T
    doc = np.repeat(np.arange(len(ids)), np.diff(first))
    ok = np.bincount(doc, weights=n_groups[codes] == 0, minlength=len(ids)) == 0
    codes, doc = codes[ok[doc]], doc[ok[doc]]
    counts = np.bincount(doc, minlength=len(ids))
    ends = np.cumsum(counts)

    def per_doc(values: np.ndarray) -> pa.Array:
        total = np.append(0, np.cumsum(values[codes]))
        return pa.array(total[ends] - total[ends - counts])

    order, at, digests = codes.tolist(), 0, []
    for n in counts.tolist():
        own = b"".join(map(pieces.texts.__getitem__, order[at:at + n]))
        digests.append(hashlib.sha256(own[:-1]).hexdigest() if n else "")
        at += n
    pairs, local = _numbered(pieces.links)
    # A document holds a pair once, however often a piece or a link occurs in it.
    owner, piece = np.divmod(_distinct(doc * max(len(sizes), 1) + codes), max(len(sizes), 1))
    links = local[_ragged((np.cumsum(sizes) - sizes)[piece], sizes[piece])]
    held = _distinct(np.repeat(owner, sizes[piece]) * max(len(pairs), 1) + links)
    per_pair = np.bincount(held % max(len(pairs), 1), minlength=len(pairs))
    docs = pa.StructArray.from_arrays(
        [ids, per_doc(n_a), per_doc(n_b), per_doc(n_groups), per_doc(sizes), pa.array(digests),
         pa.array(counts)], fields=list(_DOC))
    return pa.RecordBatch.from_arrays(
        [pa.array([number]), _listed(docs), pa.array([_pack(codes)]), pa.array([_pack(local)]),
         pa.array([_pack(sizes)]), _listed(pa.array(pairs)), _listed(pa.array(per_pair))],
        ["block", "docs", "pieces", "piece_links", "piece_sizes", "pairs", "held"])


def _block_batches(batches: Iterator[pa.RecordBatch], files) -> Iterator[pa.RecordBatch]:
    coder = Pieces(*files.value)
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        offsets, data = text_buffers(batch.column("text"))
        for a, b in chunks(offsets, BLOCK_BYTES):
            yield _block(number, batch.column("doc_id").slice(a, b - a),
                         offsets[a:b + 1] - offsets[a], data[offsets[a]:offsets[b]], coder)
            number += 1


def _sum_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over the links of every document, by way of the sums of its pieces."""
    for batch in batches:
        for k in range(batch.num_rows):
            docs = batch.column("docs")[k].values
            answers = batch.column("answers")[k].values
            counts = np.zeros(len(batch.column("pairs")[k].values or []), dtype=np.int64)
            best = counts.copy()
            if answers is not None and len(answers):
                at = answers.field("at").to_numpy()
                counts[at] = answers.field("count").to_numpy()
                best[at] = answers.field("best").to_numpy(zero_copy_only=False)
            codes, links, sizes = (_unpack(batch.column(c)[k].as_py())
                                   for c in ("pieces", "piece_links", "piece_sizes"))
            ends = np.cumsum(sizes)
            n = docs.field("n_pieces").to_numpy()
            out = []
            for values in (best, counts):
                upto = np.append(0, np.cumsum(values[links]))[np.append(0, ends)]
                total = np.append(0, np.cumsum(np.diff(upto)[codes]))
                out.append(pa.array(total[np.cumsum(n)] - total[np.cumsum(n) - n]))
            yield pa.RecordBatch.from_arrays(
                [*(docs.field(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")), *out,
                 docs.field("groups_sha256")],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                 "groups_sha256"])


def _group_batches(batches: Iterator[pa.RecordBatch], files) -> Iterator[pa.RecordBatch]:
    coder = Pieces(*files.value)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()),
                               ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
    for batch in batches:
        offsets, data = text_buffers(batch.column("text"))
        for lo, hi in chunks(offsets):
            texts, first = pieces_of(offsets[lo:hi + 1] - offsets[lo],
                                     data[offsets[lo]:offsets[hi]])
            (pieces, places), out = coder.encode(texts.to_pylist()), []
            for k in range(hi - lo):
                own, groups, at = places[first[k]:first[k + 1]], [], 0
                for p in own.tolist() if pieces.counts[own, 2].all() else []:
                    for group in pieces.texts[p][:-1].split(b";"):
                        x, y = ([int(i) for i in side.split(b",")] for side in group.split(b"|"))
                        end = at + sum(len(coder.a_bytes[i]) for i in x)
                        groups.append({"start": at, "end": end, "a": x, "b": y})
                        at = end
                out.append(groups)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(lo, hi - lo), pa.array(out, kind)],
                ["doc_id", "groups"])


def _inputs(docs: DataFrame, a_file: str, b_file: str):
    with open(a_file, encoding="utf-8") as a, open(b_file, "rb") as b:
        files = docs.sparkSession.sparkContext.broadcast((a.read(), b.read()))
    return docs.select(F.col("doc_id").cast("long"), "text"), files


def alignments(docs: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """``(doc_id, groups)``: byte spans of blank and text with the ids of A and B in each.

    See ``link_statistics`` for what counts as a text without tokens: it has no groups.
    """
    texts, files = _inputs(docs, a_file, b_file)
    return texts.mapInArrow(
        partial(_group_batches, files=files),
        "doc_id long, groups array<struct<start: long, end: long, a: array<int>, b: array<int>>>")


def link_statistics(docs: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """Groups and links of two tokenizers' tokens, a row per row of ``docs``.

    ``a_file`` is a byte-level BPE of the ``tokenizers`` library that is given a
    blank and the text, ``b_file`` a sentencepiece model that adds the blank
    itself; neither adds special tokens, and their strings are plain text. A
    null or empty text, and one whose bytes a tokenizer doesn't give back, has
    no tokens: zeros and an empty digest. Counts of pairs are of documents
    (rows) over the whole table. Repeated rows give repeated rows, ids may be
    null, further columns are ignored, an empty table gives an empty one. A text
    of any length is one row of a block.

    Documents are worked on in blocks. A block sends each of its pairs once, with
    its number of documents, and gets the count of each over all blocks back.
    """
    texts, files = _inputs(docs, a_file, b_file)
    blocks = stage(texts.mapInArrow(partial(_block_batches, files=files), _BLOCK), "blocks")
    own = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "held")).alias("at", "x"))
    counts = stage(own.groupBy(F.col("x.pairs").alias("pair")).agg(
        F.sum("x.held").alias("count")).withColumn("a", F.shiftright("pair", 32)), "pairs")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    scored = counts.join(most, "a").select("pair", "count",
                                           (F.col("count") == F.col("most")).alias("best"))
    answers = (own.select("block", "at", F.col("x.pairs").alias("pair")).join(scored, "pair")
               .groupBy("block").agg(F.collect_list(F.struct("at", "count", "best"))
                                     .alias("answers")))
    return blocks.drop("held").join(answers, "block", "left").mapInArrow(
        _sum_batches, "doc_id long, n_a long, n_b long, n_groups long, n_links long, "
        "n_best long, count_sum long, groups_sha256 string")
