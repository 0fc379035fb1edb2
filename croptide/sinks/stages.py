"""Named stage tables: resume after a failure, cut long lineages."""

from __future__ import annotations

import hashlib
import logging
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from croptide.session import stage_root

log = logging.getLogger(__name__)


def _folder(spark: SparkSession, name: str, directory: str | None) -> str:
    return f"{directory or stage_root(spark)}/stage_{name}"


def _file_system(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def materialize_stage(spark: SparkSession, make: Callable[[], DataFrame], name: str,
                      directory: str | None = None, force: bool = False) -> DataFrame:
    """Read a finished stage back, or compute and write it first.

    The table lies in the shared folder of ``spark.checkpoint.dir``, so later
    steps read files instead of recomputing when executors are lost. A stage
    without its success marker, or one that cannot be read, is computed again.
    The name has to say what the stage is made of (``fingerprint``). A stage is
    written aside and then renamed, so of two runs that make it at once the
    first one's stays and neither sees half of the other's.
    """
    path = _folder(spark, name, directory)
    fs, marker = _file_system(spark, f"{path}/_SUCCESS")
    if not force and fs.exists(marker):
        try:
            return spark.read.parquet(path)
        except Exception as e:  # unreadable stages are recomputed
            log.warning("stage %s ignored: %s", name, e)
    aside = f"{path}.{uuid.uuid4().hex[:12]}"
    make().write.parquet(aside)
    target = marker.getParent()
    if fs.exists(marker) and not force:
        return spark.read.parquet(aside)  # another run was faster; same rows
    fs.delete(target, True)
    done = fs.rename(_file_system(spark, aside)[1], target)
    return spark.read.parquet(path if done else aside)


def _files(df: DataFrame) -> str:
    """A digest of the files in the folders a frame reads, aggregated by Spark.

    Each file counts by its path, length and time of change. The listing is
    Spark's own, distributed where there are many folders; no file is opened,
    as a column that isn't asked for isn't read.
    """
    folders = sorted({file.rsplit("/", 1)[0] for file in df.inputFiles()})
    if not folders:
        return ""
    found = (df.sparkSession.read.format("binaryFile").option("recursiveFileLookup", True)
             .load(folders).select("path", "length", "modificationTime"))
    one = F.xxhash64("path", "length", F.unix_micros("modificationTime"))
    n, mixed, total = found.agg(F.count(F.lit(1)), F.bit_xor(one),
                                F.sum(one.cast("decimal(20,0)"))).first()
    return f"{n} {mixed} {total}"


def fingerprint(*inputs) -> str:
    """A short digest of frames and plain values.

    A frame counts by its files, their sizes and times, and its schema; one that
    is not read from files by its plan.
    """
    digest = hashlib.sha256()
    for item in inputs:
        if isinstance(item, DataFrame):
            files = _files(item)
            digest.update(files.encode())
            item = item.schema.json() if files else item.semanticHash()
        digest.update(repr(item).encode())
    return digest.hexdigest()[:16]


def clear_stages(spark: SparkSession, names: Iterable[str],
                 directory: str | None = None) -> None:
    """Remove stage tables, as after a run that succeeded."""
    for name in names:
        fs, path = _file_system(spark, _folder(spark, name, directory))
        fs.delete(path, True)
