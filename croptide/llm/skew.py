"""Joins whose keys may hold very many rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT = 4_096  # keys that hold more than 1 / HOT of all rows; there are fewer than HOT


def join_by_weight(rows: DataFrame, totals: DataFrame, keys: list[str], n: str,
                   hot_keys: int | None = None) -> DataFrame:
    """Inner join with one row per key that knows its number ``n`` of ``rows``.

    Keys with more than ``1 / HOT`` of all rows number fewer than ``HOT``: these are
    broadcast, so that no task gets all rows of such a key. The rest is shuffled.
    Both frames are read more than once, so they should be stage tables.
    """
    bound = (totals.agg(F.sum(n)).first()[0] or 0) // (hot_keys or HOT)
    hot = F.broadcast(totals.where(F.col(n) > bound))
    rest = rows.join(hot.select(*keys), keys, "left_anti")
    return rows.join(hot, keys).unionByName(rest.join(totals.where(F.col(n) <= bound), keys))
