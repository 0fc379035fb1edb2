"""SimHash near-duplicates: fingerprints of word shingles, linked within a radius.

Pairs within ``radius`` bits are found through an embedding: the fingerprint is
cut into segments and replaced by their bit counts. A flipped bit moves one count
by one, so the Manhattan distance of two embeddings never exceeds the Hamming
distance of the fingerprints. A grid over the embedding then finds every pair
within ``radius`` by looking into the cells that are near enough, and the exact
distance decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from croptide.llm.components import connected_components
from croptide.llm.storage import release, stage
from croptide.llm.words import chunks, text_buffers

SEED = 42
SEGMENTS = 8  # of 64 / 8 bits each
CELL = 2  # counts per cell and axis
BLOCK = 2048  # fingerprints of one cell compared in one task


def shingle_hashes(text: bytes, size: int, seed: int = SEED) -> list[bytes]:
    """XXH64 digests (big endian) of the shingles of a text, repeats included."""
    words = text.lower().split()  # of bytes: A-Z only, ASCII white space only
    if len(words) < size:
        parts = [b" ".join(words)] if words else []
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    return list(map(partial(xxhash.xxh64_digest, seed=seed), parts))


def majority_bits(digests: list[bytes], counts: np.ndarray) -> np.ndarray:
    """Fingerprints of consecutive groups of digests; an empty group gives zero."""
    out = np.zeros(len(counts), dtype=np.uint64)
    filled = np.flatnonzero(counts)
    if len(filled):
        bits = np.unpackbits(np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 8), axis=1)
        starts = (np.cumsum(counts) - counts)[filled]
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
        packed = np.packbits(ones * 2 > counts[filled, None], axis=1)
        out[filled] = packed.view(">u8").ravel()
    return out


def _fingerprint_batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, data = text_buffers(batch.column("text"))
        found = [np.zeros(0, np.uint64)]
        for a, b in chunks(offsets):
            digests, counts = [], []
            for i in range(a, b):
                own = shingle_hashes(data[offsets[i]:offsets[i + 1]].tobytes(), size)
                digests += own
                counts.append(len(own))
            found.append(majority_bits(digests, np.array(counts)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.concatenate(found).view(np.int64))],
            ["doc_id", "fp"])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``(doc_id, fp)``; null and empty texts have fingerprint zero."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        partial(_fingerprint_batches, size=shingle), "doc_id long, fp long")


def _cell_moves(radius: int) -> list[list[int]]:
    """Steps along the axes with the least distance that a step can mean."""
    most = (radius + CELL - 1) // CELL
    moves = [[]]
    for _ in range(SEGMENTS):
        moves = [m + [s] for m in moves for s in range(-most, most + 1)
                 if sum((abs(x) - 1) * CELL + 1 for x in (*m, s) if x) <= radius]
    return moves


def _embed_batches(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """The home cell of each fingerprint and the later cells within reach."""
    width = 64 // SEGMENTS
    shifts = np.arange(SEGMENTS, dtype=np.uint64) * np.uint64(width)
    side = (width // CELL) + 1
    place = side ** np.arange(SEGMENTS)
    moves = np.array(_cell_moves(radius))
    codes = moves @ place
    order = np.argsort(codes, kind="stable")
    moves, codes = moves[order], codes[order]
    moves, codes = moves[codes > 0], codes[codes > 0]
    for batch in batches:
        fp = batch.column("fp").to_numpy().view(np.uint64)
        for at in range(0, len(fp), 4096):
            part = fp[at:at + 4096]
            counts = np.bitwise_count(
                (part[:, None] >> shifts) & np.uint64(2**width - 1)).astype(np.int64)
            cell = counts // CELL
            home = cell @ place
            keys, owners = [home], [part]
            for move, code in zip(moves, codes, strict=True):
                # Distance from the point to the nearest point of the cell.
                far = np.zeros(len(part), dtype=np.int64)
                fits = np.ones(len(part), dtype=bool)
                for axis in np.flatnonzero(move):
                    to = cell[:, axis] + move[axis]
                    fits &= (to >= 0) & (to < side)
                    low = to * CELL
                    high = np.minimum(low + CELL - 1, width)
                    far += np.maximum(low - counts[:, axis], 0)
                    far += np.maximum(counts[:, axis] - high, 0)
                fits &= far <= radius
                keys.append(home[fits] + code)
                owners.append(part[fits])
            kinds = np.repeat([0, 1], [len(home), sum(map(len, keys)) - len(home)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys)), pa.array(kinds.astype(np.int8)),
                 pa.array(np.concatenate(owners).view(np.int64))], ["cell", "probe", "fp"])


def _forest(left: np.ndarray, right: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the pairs ``near`` (rows, columns) connect, no cycles."""
    i, j = near
    nodes, ends = np.unique(np.concatenate([left[i], right[j]]), return_inverse=True)
    a, b = ends[:len(i)], ends[len(i):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    other = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[other], nodes[label[other]]


def _compare(home: np.ndarray, probe: np.ndarray, radius: int, own: bool):
    """Edges between a block of fingerprints and others; ``own``: within the block."""
    width = max(1, (1 << 22) // max(1, len(home)))
    found_a, found_b = [], []
    for at in range(0, len(probe), width):
        part = probe[at:at + width]
        near = np.bitwise_count(home[:, None] ^ part[None, :]) <= radius
        i, j = np.nonzero(near)
        if own:
            keep = home[i] != part[j]
            i, j = i[keep], j[keep]
        if len(i):
            a, b = _forest(home, part, (i, j))
            found_a.append(a)
            found_b.append(b)
    return found_a, found_b


def _join_cells(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Edges of each cell block; rows come sorted by block, its fingerprints first."""
    open_key, home, waiting = None, np.zeros(0, np.uint64), []

    def edges(a, b):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(a).view(np.int64)),
             pa.array(np.concatenate(b).view(np.int64))], ["a", "b"])

    for batch in batches:
        cell, part = batch.column("cell").to_numpy(), batch.column("part").to_numpy()
        probe = batch.column("probe").to_numpy().astype(bool)
        fp = batch.column("fp").to_numpy().view(np.uint64)
        if not len(fp):
            continue
        cut = np.flatnonzero((cell[1:] != cell[:-1]) | (part[1:] != part[:-1])) + 1
        out_a, out_b = [], []
        for lo, hi in zip([0, *cut], [*cut, len(fp)], strict=True):
            key = (cell[lo], part[lo])
            if key != open_key:
                open_key, home = key, np.zeros(0, np.uint64)
            first = lo + int(np.searchsorted(probe[lo:hi], True))
            if first > lo:  # a block of at most about BLOCK fingerprints
                home = np.concatenate([home, fp[lo:first]])
                a, b = _compare(home, fp[lo:first], radius, own=True)
                out_a += a
                out_b += b
            if len(home) and hi > first:
                a, b = _compare(home, fp[first:hi], radius, own=False)
                out_a += a
                out_b += b
        if out_a:
            yield edges(out_a, out_b)


def link_fingerprints(nodes: DataFrame, radius: int = 3) -> DataFrame:
    """Edges ``(a, b)`` that connect all distinct fingerprints within ``radius`` bits.

    Returns enough pairs to connect whatever is linked, not every pair. A cell
    with many fingerprints is cut into parts, and what probes it (its own
    fingerprints of later parts included) goes to each of its parts.
    """
    spark = nodes.sparkSession
    placed = nodes.mapInArrow(partial(_embed_batches, radius=radius),
                              "cell long, probe byte, fp long")
    sizes = (placed.where("probe = 0").groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") > BLOCK)
             .select("cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts")))
    full = stage(sizes, "cells")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    cut = placed.join(full, "cell", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    # A fingerprint lives in its own part and probes the parts after it.
    spread = cut.withColumn("own", own).select(
        "cell", "fp", F.col("probe").cast("int").alias("kind"), "own",
        F.explode(F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(
            F.sequence(F.lit(0), F.col("parts") - 1))).alias("part"))
    rows = (spread.where("kind = 1 OR part >= own")
            .select("cell", "part", "fp",
                    F.when((F.col("kind") == 1) | (F.col("part") > F.col("own")), 1)
                    .otherwise(0).cast("byte").alias("probe")))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    return (rows.repartition(tasks, "cell", "part")
            .sortWithinPartitions("cell", "part", "probe")
            .mapInArrow(partial(_join_cells, radius=radius), "a long, b long"))


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs`` (columns ``doc_id, text``).

    Documents are linked when their fingerprints differ in at most ``radius``
    bits; ``component_id`` is the smallest ``doc_id`` reachable. Copies share a
    fingerprint and are linked through it, whatever their number. Null and
    empty texts have fingerprint zero and are linked like any other. A null
    ``doc_id`` never names a component, unless no other id is in it; repeated
    rows give repeated rows; an empty table gives an empty one. Further columns
    are ignored.
    """
    spark = docs.sparkSession
    prints = stage(fingerprints(docs, shingle), "prints")
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    edges = stage(link_fingerprints(nodes.select("fp"), radius), "links")
    release(spark)
    parts = connected_components(edges, "a", "b")
    named = nodes.join(parts.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return prints.join(named.join(least, "component").select("fp", "component_id"), "fp").select(
        "doc_id", "fp", "component_id")


def leading_rows(docs: DataFrame, leaders: DataFrame) -> DataFrame:
    """The rows of some ids, of repeats the one with the smallest text; null ids too."""
    columns = docs.columns
    row = F.struct(*(F.col(f"`{c}`") for c in columns))
    led = (docs.join(leaders, "doc_id", "left_semi").groupBy("doc_id")
           .agg(F.min_by(row, F.coalesce("text", F.lit(""))).alias("row")).select("row.*"))
    return led.select(*columns).unionByName(docs.where("doc_id IS NULL"))


def keep_first(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """One document per component, the one with the smallest id; columns of ``docs``.

    Rows that repeat the leading id are repeats of it: the one with the smallest
    text stays. Rows with a null ``doc_id`` are kept, as no id tells them apart.
    """
    found = near_duplicates(docs, shingle, radius)
    return leading_rows(docs, found.where("doc_id = component_id").select("doc_id").distinct())
