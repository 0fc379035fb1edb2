"""The trie of conversation prefixes, with totals of subtrees rolled up in depth bands.

A node is a sequence of leading turns; it is named by its depth and its smallest
member. Totals of a subtree go up in bands of ``HEIGHT`` depths: every node is
exploded to its ancestors in its own band only, so to ``HEIGHT`` rows at most. The
nodes on top of the bands then form a trie that is ``HEIGHT`` times less deep and is
rolled up in the same way; its completed totals go to the ancestors in the band
above each top. A trie of depth ``d`` takes ``log(d) / log(HEIGHT)`` levels.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from croptide.llm.mixing import word_count
from croptide.llm.skew import join_by_weight
from croptide.llm.storage import stage
from croptide.operators.numbering import number_rows

HEIGHT = 32  # depths per band
SPAN = 1_024  # turns of one conversation that one window holds
COPIES = 4_096  # repeats of one row made at a time
ENDS_BITS = 10  # ids are joined in ranges of 2**ENDS_BITS before they are hashed
BORROW, EVERY = 4, 20  # leading turns come from the first of EVERY, fewer than BORROW

NODE = ["conv_id", "depth"]


def _borrowed(conv_id: Column) -> Column:
    """How many leading turns of its first a conversation begins with."""
    return F.crc32(conv_id.cast("string").cast("binary")) % BORROW


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, row`` and digests of every message, in order over the whole table.

    Messages go by turn, null first; of equal turns by role, then by digest.
    Repeats are counted before they are shuffled and made again behind it.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), "turn", role.alias("role"),
        F.xxhash64(role, text).alias("t1"), F.xxhash64(F.lit(1), role, text).alias("t2"),
        word_count(text).alias("words"))
    keys = ["conv_id", "turn", "role", "t1", "t2"]
    counted = turns.groupBy(*keys).agg(F.first("words").alias("words"),
                                       F.count(F.lit(1)).alias("k"))
    last = F.col("k") - 1
    one_by_one = counted.withColumn("block", F.explode(F.sequence(
        F.lit(0), (last / COPIES).cast("long")))).withColumn("copy", F.explode(F.sequence(
            F.col("block") * COPIES, F.least(last, F.col("block") * COPIES + COPIES - 1))))
    return number_rows(one_by_one.drop("k", "block"), F.col("conv_id"),
                       F.col("turn").asc_nulls_first(), "role", "t1", "t2", "copy").select(
        "conv_id", "row", "t1", "t2", "words")


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations, and all their ids.

    The first ``h`` turns are those of conversation ``c - c % 20``, ``h`` a digest
    of ``c`` below 4; the conversation's own turns after its first ``h`` follow.
    """
    sizes = turns.groupBy("conv_id").agg(F.min("row").alias("start"),
                                         F.count(F.lit(1)).alias("n"))
    first = F.col("conv_id") - F.col("conv_id") % EVERY
    lengths = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = stage(sizes.withColumn("base", first).join(lengths, "base", "left").select(
        "conv_id", "base", "start", "n", _borrowed(F.col("conv_id")).alias("h"),
        F.least(_borrowed(F.col("conv_id")), F.coalesce("base_n", F.lit(0))).alias("lent")),
        "conversations")
    placed = join_by_weight(turns, convs.drop("base"), ["conv_id"], "n").withColumn(
        "pos", F.col("row") - F.col("start"))
    heads = placed.where((F.col("conv_id") % EVERY == 0) & (F.col("pos") < BORROW - 1)).select(
        F.col("conv_id").alias("base"), "pos", "t1", "t2", "words")
    lent = convs.where("lent > 0").select("conv_id", "base", "lent").join(heads, "base").where(
        "pos < lent").select("conv_id", "pos", "t1", "t2", "words")
    own = placed.where("pos >= h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("lent")).alias("pos"), "t1", "t2", "words")
    return lent.unionByName(own), convs.select("conv_id")


def prefixes(turns: DataFrame) -> DataFrame:
    """``(conv_id, depth, k1, k2, words)`` of every prefix but the empty one.

    The key of a prefix is the exclusive or of hashes of its turns with their
    places, 128 bits in all; sums over spans and within them need no more than
    ``SPAN`` turns at a time.
    """
    hashed = turns.select(
        "conv_id", "pos", "words", F.floor(F.col("pos") / SPAN).alias("span"),
        F.xxhash64("pos", "t1", "t2").alias("z1"),
        F.xxhash64(F.lit(7), "t2", "pos", "t1").alias("z2"))
    spans = hashed.groupBy("conv_id", "span").agg(F.bit_xor("z1").alias("s1"),
                                                  F.bit_xor("z2").alias("s2"))
    earlier = Window.partitionBy("conv_id").orderBy("span").rowsBetween(
        Window.unboundedPreceding, -1)
    before = spans.select("conv_id", "span", F.bit_xor("s1").over(earlier).alias("b1"),
                          F.bit_xor("s2").over(earlier).alias("b2")).where("span > 0")
    within = Window.partitionBy("conv_id", "span").orderBy("pos").rowsBetween(
        Window.unboundedPreceding, 0)
    return (hashed.withColumn("w1", F.bit_xor("z1").over(within))
            .withColumn("w2", F.bit_xor("z2").over(within))
            .join(before, ["conv_id", "span"], "left")
            .select("conv_id", (F.col("pos") + 1).alias("depth"), "words",
                    *(F.col(f"w{i}").bitwiseXOR(F.coalesce(f"b{i}", F.lit(0)).cast("long"))
                      .alias(f"k{i}") for i in (1, 2))))


def roll_up(paths: DataFrame, weights: DataFrame, values: list[str],
            height: int = HEIGHT) -> DataFrame:
    """Sums of ``values`` over the subtree of every node, the node included.

    ``paths`` has ``(conv_id, depth, rep)``: the node ``(rep, depth)`` that
    ``conv_id`` passes, for every depth from 0 to that of its last node; a node's
    own row has ``rep = conv_id``. ``weights`` has ``(conv_id, depth, *values)``, a
    row per node.
    """
    bands = stage(paths.groupBy("conv_id", F.floor(F.col("depth") / height).alias("band"))
                  .agg(F.transform(F.sort_array(F.collect_list(F.struct("depth", "rep"))),
                                   lambda x: x["rep"]).alias("reps")), "bands")
    sums = [F.sum(v).alias(v) for v in values]

    def to_ancestors(nodes: DataFrame, reps: Column) -> DataFrame:
        """Rows of nodes with their ``band``, summed at each node of ``reps``."""
        return (nodes.join(bands, ["conv_id", "band"])
                .select("band", *values, F.posexplode(reps).alias("at", "ancestor"))
                .groupBy(F.col("ancestor").alias("conv_id"),
                         (F.col("band") * height + F.col("at")).alias("depth")).agg(*sums))

    inside = stage(to_ancestors(
        weights.withColumn("band", F.floor(F.col("depth") / height)),
        F.slice("reps", F.lit(1), (F.col("depth") % height + 1).cast("int"))), "rolled")
    deepest = inside.agg(F.max("depth")).first()[0]
    if deepest is None or deepest < height:
        return inside
    upper = (F.col("depth") / height).cast("long").alias("depth")
    tops = roll_up(paths.where(F.col("depth") % height == 0).select("conv_id", upper, "rep"),
                   inside.where(F.col("depth") % height == 0).select("conv_id", upper, *values),
                   values, height)
    # A top's total is complete now; it goes to its ancestors in the band above.
    above = tops.where("depth > 0").select("conv_id", (F.col("depth") - 1).alias("band"), *values)
    return stage(inside.unionByName(to_ancestors(above, F.col("reps"))).groupBy(*NODE).agg(*sums),
                 "totals")


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node of rows sorted by node and range; holds one digest's state."""
    node, state = None, None
    for batch in batches:
        done = []
        for conv, depth, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (conv, depth) != node:
                if node:
                    done.append((*node, state.hexdigest()))
                node, state = (conv, depth), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield _digests(done)
    if node:
        yield _digests([(*node, state.hexdigest())])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(
        [dict(zip(("conv_id", "depth", "ends_sha256"), r, strict=True)) for r in rows],
        pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()),
                   ("ends_sha256", pa.string())]))


def end_digests(ends: DataFrame) -> DataFrame:
    """``(conv_id, depth, ends_sha256)`` of nodes at which ``member`` rows end.

    A digest is made of all ids in order, so those of one node meet in one task;
    they come joined in ranges, in order, and are hashed as they come.
    """
    joined = ends.groupBy("conv_id", "depth", F.shiftright("member", ENDS_BITS).alias("range")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("member")),
                                 lambda x: x.cast("string")), ",").alias("ids"))
    tasks = max(int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return (joined.repartition(tasks, *NODE).sortWithinPartitions(*NODE, "range")
            .select(*NODE, "ids")
            .mapInArrow(_hash_batches, "conv_id long, depth long, ends_sha256 string"))


def prefix_trie(conversations: DataFrame, height: int = HEIGHT) -> DataFrame:
    """All nodes of the trie of rebuilt conversations, from ``conv_id, turn, role, text``.

    Columns: ``conv_id`` (the smallest member) and ``depth``, which name the node;
    ``parent_conv_id``; ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``;
    ``ends_sha256`` of the members that end there. Rows without a ``conv_id`` belong
    to no conversation and are ignored; a null role or text is empty. Messages of
    one turn go by role, then by a digest of role and text; repeated rows are so
    many messages. Text of any length is read once, to a digest and a word count.
    An empty table has no nodes, not even a root; further columns are ignored.
    """
    turns, ids = rebuilt_turns(numbered_turns(conversations))
    rows = stage(prefixes(turns), "prefixes")
    keys = ["depth", "k1", "k2"]
    nodes = stage(rows.groupBy(*keys).agg(
        F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("n_convs"),
        F.first("words").alias("words")), "nodes")
    least, n = ids.agg(F.min("conv_id"), F.count(F.lit(1))).first()
    root = conversations.sparkSession.createDataFrame(
        [(least, 0, n, 0)] if n else [], "conv_id long, depth long, n_convs long, words long")
    zero = F.lit(0).cast("long")
    paths = stage(
        join_by_weight(rows.select("conv_id", *keys), nodes.select(*keys, "rep", "n_convs"), keys,
                       "n_convs").select("conv_id", "depth", "rep")
        .unionByName(ids.select("conv_id", zero.alias("depth"),
                                F.lit(least).cast("long").alias("rep"))), "paths")
    table = nodes.select(F.col("rep").alias("conv_id"), "depth", "n_convs", "words").unionByName(
        root)
    parents = paths.select("conv_id", (F.col("depth") + 1).alias("depth"),
                           F.col("rep").alias("parent_conv_id"))
    linked = stage(table.join(parents, NODE, "left"), "linked")
    children = linked.where("parent_conv_id IS NOT NULL").groupBy(
        F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children"))
    known = linked.join(children, NODE, "left").withColumn(
        "n_children", F.coalesce("n_children", zero))
    weights = known.select(
        *NODE, (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
    totals = roll_up(paths, weights, ["n_leaves", "saved_tokens"], height)
    last = paths.groupBy("conv_id").agg(F.max(F.struct("depth", "rep")).alias("end")).select(
        F.col("end.rep").alias("conv_id"), "end.depth", F.col("conv_id").alias("member"))
    return (known.join(totals, NODE).join(end_digests(last), NODE, "left")
            .select(*NODE, "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest()))
                    .alias("ends_sha256")))
