"""Numbering rows of a table in order, without a window over the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from croptide.session import local_table, stage_path

_PLACES = 33  # bits of a monotonic id that count rows within a partition


def number_rows(df: DataFrame, *order: Column | str, name: str = "row") -> DataFrame:
    """Add ``name``: the place of every row in ``order``, from 0, as a stage table.

    The rows are cut into ranges of the order and numbered within; what lies
    before a range is a sum of counts, one per range, and only these pass
    through the driver. Rows that tie in the whole order lie in one range and
    get their numbers in any order.
    """
    spark = df.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    path = stage_path(spark, "numbered")
    (df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
     .withColumn("_id", F.monotonically_increasing_id()).write.parquet(path))
    placed = spark.read.parquet(path).withColumn("_range", F.shiftright("_id", _PLACES).cast("int"))
    before, offsets = 0, []
    for part, count in sorted(placed.groupBy("_range").count().collect()):
        offsets.append((part, float(before)))
        before += count
    starts = local_table(spark, offsets, "_range int, _before double")
    place = F.col("_id").bitwiseAND((1 << _PLACES) - 1) + F.col("_before").cast("long")
    return placed.join(starts, "_range").select(*df.columns, place.alias(name))
