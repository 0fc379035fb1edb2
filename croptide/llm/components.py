"""Connected components of an edge table, by alternating star contractions.

Every round replaces the edges by shorter ones with two grouped minima and two
equi-joins; nothing is collected but two numbers that tell whether a round
changed anything. Groupings combine before the shuffle and the joins have a side
with one row per node, so a node with very many edges is split by AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from croptide.llm.storage import stage


def _distinct(df: DataFrame) -> DataFrame:
    return df.where("u != v").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of each node to the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return _distinct(both.join(least, "u").where("v > u")
                     .select(F.col("v").alias("u"), F.least("u", "m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return _distinct(edges.join(least, "u")
                     .select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")))


def _fingerprint(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` of every node that has an edge to another node.

    ``component`` is the smallest node reachable. Edges with a null end and
    loops are ignored; repeated edges and either direction are fine. An empty
    table gives an empty one.
    """
    current = stage(_distinct(
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))), "edges")
    before = _fingerprint(current)
    while before[0]:
        current = stage(_small_star(_large_star(current)), "edges")
        now = _fingerprint(current)
        if now == before:
            break
        before = now
    leaves = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select("v").distinct().select(F.col("v").alias("node"),
                                                  F.col("v").alias("component"))
    return leaves.unionByName(roots)
