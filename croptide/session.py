"""Session set-up, the shared stage folder and size-checked broadcasts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A pinned table passes through the driver and is broadcast, so it is only
# pinned when a count proves that it has at most this many rows.
PIN_ROW_LIMIT = 200_000

_ARROW = {"int": pa.int32(), "double": pa.float64(), "date": pa.date32(),
          "string": pa.string(), "boolean": pa.bool_()}
_STAGE_CONF = "spark.checkpoint.dir"
_local_root: str | None = None


def build_session(app: str = "croptide", cpus: int | None = None) -> SparkSession:
    """A session for tests and local runs; a cluster brings its own settings.

    Only ``cpus`` makes it local. Everything else is what the engine expects of
    any session: adaptive execution (coalescing, skew splits, run-time
    broadcast) and UTC.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Recording the Python call site of every expression slows plan building.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if cpus:
        builder = (
            builder.master(f"local[{cpus}]")
            .config("spark.sql.shuffle.partitions", str(cpus))
            .config("spark.driver.memory", "8g")
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
        )
    return builder.getOrCreate()


def stage_root(spark: SparkSession) -> str:
    """The shared folder for stage tables, read from ``spark.checkpoint.dir``.

    A temporary folder stands in only when the setting is absent *and* the
    session is local (it goes with the process); on a cluster a machine-local
    folder would lose stages.
    """
    global _local_root
    configured = spark.conf.get(_STAGE_CONF, None) or spark.sparkContext.getConf().get(
        _STAGE_CONF
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_STAGE_CONF} to a folder every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="croptide-stages-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-used path below the stage root."""
    return f"{stage_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def pin_within(df: DataFrame, max_rows: int = PIN_ROW_LIMIT) -> DataFrame | None:
    """A small table evaluated once and ready to broadcast; None if it is larger.

    At most ``max_rows + 1`` rows are fetched to learn the size. Within the
    bound the rows become a local relation, so the plan that produced them does
    not run again in every join.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return None
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def pin_small(df: DataFrame, max_rows: int = PIN_ROW_LIMIT) -> DataFrame:
    """``pin_within``, or the frame itself, lazy and marked for a sort-merge join.

    So no size estimate can broadcast a larger one after all.
    """
    pinned = pin_within(df, max_rows)
    return df.hint("merge") if pinned is None else pinned


def local_table(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A small driver-made table as a local relation, ready to broadcast."""
    fields = T.StructType.fromDDL(schema)
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    table = pa.table([pa.array(c, _ARROW[f.dataType.simpleString()])
                      for c, f in zip(columns, fields, strict=True)], fields.names)
    return F.broadcast(spark.createDataFrame(table, fields))
