"""Partitioned and wide tables."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Collection, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from croptide.constants import CUBE_COORDS, INDEX_ATTRIBUTES, INDEX_NAMES
from croptide.session import stage_path

log = logging.getLogger(__name__)

# Existing (variable, year) keys up to this many become a pushed-down filter.
MAX_LITERAL_KEYS = 5_000
#: Fixed value: the folder of a NULL partition.
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def replace_table(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Have ``write`` make a table aside and put it in the place of ``path``.

    Until the new table is complete the old one stays and can be read, also by
    ``write`` itself; if writing fails, nothing has changed. The swap is two
    renames. Where a run was ended between them, the next one first puts the old
    table back. Both wait beside the table under names that readers skip.
    """
    fs, target = _place(spark, path)
    parent, name = target.getParent(), target.getName()
    made = spark._jvm.org.apache.hadoop.fs.Path

    def beside(kind: str, what: str):
        return made(parent, f"_{name}.{kind}-{what}")

    if not fs.exists(target):
        left = fs.globStatus(beside("old", "*")) or ()
        if len(left) == 1:
            log.warning("%s was being replaced; its old table is put back", path)
            fs.rename(left[0].getPath(), target)
    run = uuid.uuid4().hex[:12]
    new, old = beside("new", run), beside("old", run)
    try:
        write(new.toString())
        if not fs.exists(made(new, "_SUCCESS")):
            raise OSError(f"the new table of {path} is not complete")
        held = fs.exists(target)
        if held and not fs.rename(target, old):
            raise OSError(f"{path} could not be moved aside")
        if not fs.rename(new, target):
            if held:
                fs.rename(old, target)
            raise OSError(f"the new table of {path} could not be put in place")
    except BaseException:
        fs.delete(new, True)
        raise
    if held:
        fs.delete(old, True)
    return path


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def write_index_store(df: DataFrame, path: str) -> str:
    """The index cube as Parquet by year: FLOAT indices, SMALLINT heatwave count.

    An existing store is replaced once the new one is complete, so that a run
    that fails leaves it as it was. ``rebalance`` lets adaptive execution split
    large years and merge small ones into files of the advisory size, whatever
    the number of upstream tasks.
    """
    names = [n for n in INDEX_NAMES if n in df.columns]
    typed = df.select(
        *CUBE_COORDS,
        *(F.col(n).cast("smallint" if n == "HeatwaveIndex" else "float")
          .alias(n, metadata=INDEX_ATTRIBUTES[n]) for n in names),
        F.year("date").alias("year"))
    ordered = typed.hint("rebalance", "year").sortWithinPartitions(
        "year", *CUBE_COORDS[1:3], "date")
    return replace_table(df.sparkSession, path, ordered.write.partitionBy("year").parquet)


def write_features(df: DataFrame, directory: str, base: str, parquet: bool = True,
                   csv: bool = False, order: str | None = None) -> dict:
    """A wide table as Parquet and/or CSV; returns status and paths.

    An empty table is not written. One format failing does not stop the other.
    ``df`` is evaluated once, into a stage table that answers whether it is empty
    and that both formats are written from.
    """
    result = {"status": "success", "message": "features written",
              "output_parquet_path": None, "output_csv_path": None,
              "error_details": None}
    staged = None
    if len(df.columns) >= 2:
        path = stage_path(df.sparkSession, "features")
        df.write.parquet(path)
        staged = df.sparkSession.read.schema(df.schema).parquet(path)
    if staged is None or staged.isEmpty():
        result["message"] = "nothing to write: the table is empty"
        return result
    df = staged.orderBy(order) if order else staged

    def attempt(key: str, path: str, write) -> None:
        try:
            write(path)
            result[key] = path
        except Exception as e:  # one format must not take the other down
            log.warning("writing %s failed: %s", path, e)
            result["error_details"] = str(e)

    if parquet:
        attempt("output_parquet_path", f"{directory}/{base}.parquet",
                lambda p: df.write.mode("overwrite").parquet(p))
    if csv:
        attempt("output_csv_path", f"{directory}/{base}.csv",
                lambda p: df.write.mode("overwrite").option("header", True).csv(p))
    return result


def partition_files(spark: SparkSession, path: str, keys: Sequence[str]
                    ) -> dict[tuple[str | None, ...], frozenset[str]]:
    """Names of the data files of every key partition below ``path``.

    Keys are text as folder names have it (None for NULL). Only folders are
    listed, no file is opened.
    """
    fs, pattern = _place(spark, "/".join([path, *(f"{k}=*" for k in keys), "*"]))
    found: dict[tuple[str | None, ...], set[str]] = {}
    for status in fs.globStatus(pattern) or ():
        file = status.getPath()
        if file.getName()[0] in "_.":
            continue
        parts, folder = [], file.getParent()
        for key in reversed(keys):
            value = unquote(folder.getName()[len(key) + 1:])
            parts.append(None if value == _NULL_FOLDER else value)
            folder = folder.getParent()
        found.setdefault(tuple(reversed(parts)), set()).add(file.getName())
    return {k: frozenset(v) for k, v in found.items()}


def existing_keys(spark: SparkSession, path: str, keys: Sequence[str]
                  ) -> list[tuple[str | None, ...]]:
    """The key partitions with a data file below ``path``, in order."""
    return sorted(partition_files(spark, path, keys), key=str)


def write_missing_partitions(df: DataFrame, path: str, overwrite: bool = False,
                             keys: Sequence[str] = ("variable", "year"),
                             max_literal_keys: int | None = None,
                             replace: Collection[tuple] = ()) -> str:
    """Write the partitions (of variable and year by default) that do not exist yet.

    Existing ones are kept and their rows are not even read where the input is
    partitioned alike, because up to ``max_literal_keys`` kept keys become a
    filter; more are an anti-join. ``overwrite`` replaces the partitions that
    occur in ``df`` and leaves all others alone, ``replace`` does so for some.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    max_literal_keys = max_literal_keys or MAX_LITERAL_KEYS
    done = [] if overwrite else [k for k in existing_keys(df.sparkSession, path, keys)
                                 if k not in set(replace)]
    if len(done) > max_literal_keys:
        have = df.sparkSession.createDataFrame(
            done, ", ".join(f"_have_{k} string" for k in keys))
        same = [F.col(k).cast("string").eqNullSafe(F.col(f"_have_{k}")) for k in keys]
        df = df.join(have, reduce(lambda a, b: a & b, same), "left_anti")
    elif done:
        kept = F.lit(False)
        for row in done:
            match = F.lit(True)
            for k, value in zip(keys, row, strict=True):
                # Of the column's own type, so that the filter reaches the scan.
                match &= F.col(k).eqNullSafe(F.lit(value).cast(df.schema[k].dataType))
            kept |= match
        df = df.filter(~kept)
    (df.select(*rest, *keys).hint("rebalance", *keys)
     .write.mode("overwrite" if overwrite or replace else "append")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*keys).parquet(path))
    return path
