"""Near-duplicate vectors: random hyperplanes in several tables, exact cosines.

A table cuts space by ``bits`` hyperplanes; vectors on the same side of all of
them share a bucket. Two vectors at cosine 0.98 fall into a common bucket of a
table of 14 bits with probability 0.40, so that 24 tables miss them with
probability 5e-6 (much less when they are closer). Every pair that shares a
bucket is verified in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from croptide.llm.components import connected_components
from croptide.llm.storage import release, stage

TABLES = 24
BITS = 14
BLOCK = 1024  # vectors of one part of a bucket
SEED = 97


def _normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as packed doubles; null where nothing can be compared."""
    for batch in batches:
        column = batch.column("embedding")
        flat = column.flatten().cast(pa.float64())
        null = flat.is_null().to_numpy(zero_copy_only=False)
        values = flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
        sizes = np.array([0 if n is None else n for n in
                          column.value_lengths().to_pylist()], dtype=np.int64)
        ends = np.cumsum(sizes)
        good = np.isfinite(values) & ~null
        packed = []
        for n, end in zip(sizes, ends, strict=True):
            own = slice(end - n, end)
            v = values[own]
            usable = n > 0 and good[own].all() and v.any()
            if usable:
                top = np.abs(v).max()
                if not 1e-100 < top < 1e100:  # keep squares in range
                    v = v / top
            packed.append((v + 0.0).tobytes() if usable else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("label"), pa.array(packed, pa.binary())],
            ["vec_id", "label", "vec"])


def _hash_batches(batches: Iterator[pa.RecordBatch], tables: int, bits: int
                  ) -> Iterator[pa.RecordBatch]:
    """The bucket of each class in every table, 32 bits each."""
    planes: dict[int, np.ndarray] = {}
    weights = 1 << np.arange(bits, dtype=np.int64)
    for batch in batches:
        vecs = batch.column("vec").to_pylist()
        sizes = np.array([len(v) // 8 for v in vecs], dtype=np.int64)
        sigs = np.zeros((len(vecs), tables), dtype=np.int32)
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            x = np.frombuffer(b"".join(vecs[i] for i in rows), np.float64).reshape(-1, size)
            if size not in planes:
                rng = np.random.default_rng([SEED, int(size)])
                planes[size] = rng.standard_normal((size, tables * bits))
            side = (x @ planes[size] > 0).reshape(len(rows), tables, bits)
            sigs[rows] = side @ weights
        arrays = [batch.column(c) for c in ("label", "rep", "copies", "vec")]
        yield pa.RecordBatch.from_arrays(
            [*arrays, pa.array([s.tobytes() for s in sigs], pa.binary()),
             pa.array(sizes.astype(np.int32)),
             pa.array(list(sigs), pa.list_(pa.int32()))],
            ["label", "rep", "copies", "vec", "sigs", "size", "bucket"])


def _connect(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest position reachable from each of ``n`` positions."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        for at in (i, j, label[i], label[j]):
            np.minimum.at(new, at, low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    return label


def _verify(rows: list[tuple], table: int, first: int, second: int, threshold: float):
    """Links of one block of a bucket: per class the copies linked, and a forest.

    ``rows`` are (part, rep, copies, vec, sigs). In a block of two parts only
    pairs across the parts count. A pair counts in the first table it shares.
    """
    part = np.array([r[0] for r in rows])
    rep = np.array([r[1] for r in rows])
    copies = np.array([r[2] for r in rows])
    x = np.frombuffer(b"".join(r[3] for r in rows), np.float64).reshape(len(rows), -1)
    sigs = np.frombuffer(b"".join(r[4] for r in rows), np.int32).reshape(len(rows), -1)
    x = x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
    left = np.flatnonzero(part == first)
    right = left if first == second else np.flatnonzero(part == second)
    near = x[left] @ x[right].T >= threshold
    i, j = np.nonzero(near)
    i, j = left[i], right[j]
    keep = i < j if first == second else i >= 0
    i, j = i[keep], j[keep]
    if not len(i):
        return None
    label = _connect(len(rows), i, j)
    fresh = np.ones(len(i), dtype=bool)
    for t in range(table):
        fresh &= sigs[i, t] != sigs[j, t]
    linked = np.zeros(len(rows), dtype=np.int64)
    np.add.at(linked, i[fresh], copies[j[fresh]])
    np.add.at(linked, j[fresh], copies[i[fresh]])
    told = np.flatnonzero((linked > 0) | (label != np.arange(len(rows))))
    return rep[told], rep[label[told]], linked[told]


def _verify_batches(batches: Iterator[pa.RecordBatch], threshold: float
                    ) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by block; one block is held at a time."""
    names = ("label", "size", "tbl", "bucket", "lo", "hi")
    open_key, rows = None, []

    def close():
        if len(rows) > 1:
            found = _verify(rows, open_key[2], open_key[4], open_key[5], threshold)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found],
                                                 ["a", "b", "n"])

    for batch in batches:
        keys = np.stack([batch.column(n).to_numpy() for n in names], axis=1).astype(np.int64)
        cut = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        body = [batch.column(n) for n in ("part", "rep", "copies", "vec", "sigs")]
        for lo, hi in zip([0, *cut], [*cut, len(keys)], strict=True):
            if hi == lo:
                continue
            key = tuple(keys[lo])
            if key != open_key:
                yield from close()
                open_key, rows = key, []
            if hi - lo == 1 and not rows and hi < len(keys):
                continue  # alone in its bucket
            rows = rows + list(zip(*(c.slice(lo, hi - lo).to_pylist() for c in body),
                                   strict=True))
    yield from close()


def links(classes: DataFrame, threshold: float, tables: int = TABLES, bits: int = BITS
          ) -> DataFrame:
    """``(a, b, n)``: class ``a`` has ``n`` more linked vectors; ``a``-``b`` connect.

    ``classes`` has ``label, rep, copies, vec``. A bucket of more than ``BLOCK``
    classes is cut into parts, and every two parts meet in a block of their own.
    """
    spark = classes.sparkSession
    hashed = stage(classes.mapInArrow(
        partial(_hash_batches, tables=tables, bits=bits),
        "label int, rep long, copies long, vec binary, sigs binary, size int, "
        "bucket array<int>"), "hashed")
    key = ["label", "size", "tbl", "bucket"]
    counted = (hashed.select("label", "size", F.posexplode("bucket").alias("tbl", "bucket"))
               .groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK))
    full = stage(counted.select(*key, F.ceil(F.col("n") / BLOCK).cast("int").alias("parts")),
                 "buckets")
    spread = (hashed.select("label", "size", "rep", "copies", "vec", "sigs",
                            F.posexplode("bucket").alias("tbl", "bucket"))
              .join(full, key, "left")
              .withColumn("parts", F.coalesce("parts", F.lit(1)))
              .withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))))
    rows = spread.select(*key, F.least("part", "other").alias("lo"),
                         F.greatest("part", "other").alias("hi"),
                         "part", "rep", "copies", "vec", "sigs")
    block = [*key, "lo", "hi"]
    return (rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *block)
            .sortWithinPartitions(*block)
            .mapInArrow(partial(_verify_batches, threshold=threshold),
                        "a long, b long, n long"))


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, tables: int = TABLES,
                    bits: int = BITS) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors``.

    Columns ``vec_id, embedding, label``; others are ignored. Vectors are
    compared within a label (not null) and length. A vector that is null, empty
    or zero, or holds null or non-finite components, links with nothing, nor
    does a row with a null ``vec_id``: no links, its own id as component. Equal
    vectors are one class with a number of copies, so that copies cost nothing;
    a row that repeats a ``vec_id`` counts as one more copy (with another
    vector: the links of both are added up). An empty table gives an empty one.
    """
    spark = vectors.sparkSession
    kind = dict(vectors.dtypes)["embedding"]
    typed = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("int"),
                           F.col("embedding") if kind.startswith("array<") else
                           F.col("embedding").cast("array<double>"))
    packed = stage(typed.mapInArrow(_normalise, "vec_id long, label int, vec binary"), "vectors")
    usable = packed.where("vec_id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL")
    classes = stage(usable.groupBy("label", "vec").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "classes")
    found = stage(links(classes, threshold, tables, bits), "links")
    release(spark)
    partners = found.groupBy("a").agg(F.sum("n").alias("partners"))
    parts = connected_components(found, "a", "b")
    named = (classes.join(partners, F.col("rep") == F.col("a"), "left").drop("a")
             .join(parts, F.col("rep") == F.col("node"), "left")
             .select("label", "vec", (F.coalesce("partners", F.lit(0)) + F.col("copies") - 1)
                     .alias("links"), F.coalesce("component", "rep").alias("component")))
    alone = packed.where("vec_id IS NULL OR label IS NULL OR vec IS NULL").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    grouped = usable.join(named, ["label", "vec"]).select(
        "vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id"))
    return grouped.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
