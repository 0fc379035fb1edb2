"""Stage tables in the shared folder: they cut lineage and survive lost executors."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from croptide.session import stage_path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as a table below ``spark.checkpoint.dir`` and read it back."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now.

    It deletes them when the driver's garbage collector finds their plans
    unused, which on a quiet driver can be much later than the disk fills.
    """
    gc.collect()
    spark._jvm.System.gc()


def set_aside(docs: DataFrame, *used: str) -> DataFrame:
    """``docs`` with all columns but those ``used`` under made-up names.

    So an operator's own column names clash with none; ``put_back`` undoes it.
    """
    return docs.select(*(F.col(f"`{c}`").alias(c if c in used else f"aside_{k}")
                         for k, c in enumerate(docs.columns)))


def put_back(frame: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs`` from a frame made by ``set_aside``, some of them ``changed``."""
    held = set(frame.columns)
    return frame.select(*(
        changed.get(c, F.col(f"aside_{k}" if f"aside_{k}" in held else c)).alias(c)
        for k, c in enumerate(docs.columns)))
