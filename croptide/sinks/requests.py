"""What stored partitions hold: the request that each was made by, kept beside them.

A folder's name says only part of that. The rest (months, days, box, hours ...) is
a row of a small table below the store, which readers of the store don't see.
"""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from croptide.sinks.tables import partition_files, write_missing_partitions

log = logging.getLogger(__name__)

_FOLDER = "_requests"
_SCHEMA = "partition string, request string, written double"

Key = tuple[str | None, ...]


class RequestMismatch(ValueError):
    """A partition is stored already, and by another request."""


def stored_requests(spark: SparkSession, path: str) -> dict[Key, dict]:
    """The last request noted for each partition; one row per write and partition."""
    folder = f"{path}/{_FOLDER}"
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return {}
    rows = spark.read.schema(_SCHEMA).json(folder).collect()
    return {tuple(json.loads(r["partition"])): json.loads(r["request"])
            for r in sorted(rows, key=lambda r: r["written"])}


def _note(spark: SparkSession, path: str, partitions: Collection[Key], request: Mapping) -> None:
    now, text = time.time(), json.dumps(request, sort_keys=True)
    rows = [(json.dumps(p), text, now) for p in sorted(partitions, key=str)]
    if rows:
        spark.createDataFrame(rows, _SCHEMA).coalesce(1).write.mode("append").json(
            f"{path}/{_FOLDER}")


def store_request(df: DataFrame, path: str, keys: Sequence[str], request: Mapping,
                  wanted: Mapping[str, Collection], overwrite: bool = False,
                  on_mismatch: str = "keep") -> str:
    """``write_missing_partitions`` that knows what the stored partitions are made of.

    ``request`` (plain JSON values) is noted for every partition that is written.
    ``wanted`` has the values of keys that ``df`` can have; of the stored
    partitions among them, those noted with another request, or with none, are
    kept with a warning, refused (``error``) or written anew (``replace``).
    ``overwrite`` writes all partitions of ``df`` anew and asks for nothing.
    """
    if on_mismatch not in ("keep", "error", "replace"):
        raise ValueError(f"on_mismatch must be keep, error or replace, not {on_mismatch!r}")
    spark = df.sparkSession
    request = json.loads(json.dumps(request))
    before = partition_files(spark, path, keys)
    texts = {k: {str(v) for v in values} for k, values in wanted.items()}
    differing = []
    if not overwrite and before:
        noted = stored_requests(spark, path)
        differing = [p for p in sorted(before, key=str) if noted.get(p) != request and all(
            v in texts[k] for k, v in zip(keys, p, strict=True) if k in texts)]
    if differing and on_mismatch == "error":
        raise RequestMismatch(
            f"stored by another request: {[dict(zip(keys, p, strict=True)) for p in differing]}")
    if differing and on_mismatch == "keep":
        log.warning("kept, though stored by another request: %s",
                    [dict(zip(keys, p, strict=True)) for p in differing])
    write_missing_partitions(df, path, overwrite, keys,
                             replace=differing if on_mismatch == "replace" else ())
    after = partition_files(spark, path, keys)
    _note(spark, path, [p for p, files in after.items() if files != before.get(p)], request)
    return path
