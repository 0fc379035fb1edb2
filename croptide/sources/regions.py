"""Region outlines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RING_TYPE = "array<struct<x:double,y:double>>"


def read_regions(spark: SparkSession, path: str,
                 file_format: str = "parquet") -> DataFrame:
    """(region, region_abbr, ring); several rows per region are its parts or holes."""
    df = spark.read.format(file_format).load(path)
    missing = {"region", "region_abbr", "ring"} - set(df.columns)
    if missing:
        raise ValueError(f"region table lacks {sorted(missing)}")
    return df.select(F.col("region").cast("int"), F.col("region_abbr").cast("string"),
                     F.col("ring").cast(RING_TYPE))
