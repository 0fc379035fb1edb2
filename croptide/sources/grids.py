"""Grid folders and index stores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from croptide.constants import CUBE_COORDS
from croptide.functions.climate import null_if_nan
from croptide.operators.normalize import COORD_COLUMNS, find_coords, find_time, normalize_time

#: Coordinates besides time and place that grid files can have.
OTHER_COORDS = ("level", "pressure_level", "product_type", "year")

_NO_DATA = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _load(spark: SparkSession, path: str, file_format: str,
          schema: T.StructType | str | None) -> DataFrame:
    reader = spark.read.format(file_format)
    if schema is not None:
        reader = reader.schema(schema)
    if file_format == "csv":
        # Columns go by position, so a file with another header is an error.
        reader = reader.option("header", True).option("enforceSchema", False)
    elif file_format == "parquet":
        reader = reader.option("mergeSchema", True)
    try:
        df = reader.load(path)
    except AnalysisException as e:
        if e.getCondition() in _NO_DATA:
            raise FileNotFoundError(f"no grid files in {path}") from e
        raise
    if not df.columns:
        raise FileNotFoundError(f"no grid files in {path}")
    return df


def _clear_nan(df: DataFrame) -> DataFrame:
    """Floating columns with NaN mapped to NULL; other columns untouched."""
    floating = {f.name for f in df.schema.fields
                if isinstance(f.dataType, T.DoubleType | T.FloatType)}
    return df.select(*(
        null_if_nan(F.col(f"`{c}`")).alias(c, metadata=df.schema[c].metadata)
        if c in floating else F.col(f"`{c}`")
        for c in df.columns
    ))


def _one_name_per_axis(df: DataFrame) -> DataFrame:
    """Latitude and longitude columns that files spell differently, made one each."""
    for names in (("lat", "latitude"), ("lon", "longitude")):
        short, long = (next((c for c in df.columns if c.lower() == n), None) for n in names)
        if short and long:
            df = df.withColumn(long, F.coalesce(long, short)).drop(short)
    return df


def data_variables(df: DataFrame, time_col: str = "valid_time",
                   coords: Sequence[str] = ()) -> list[str]:
    """The numeric columns that are not coordinates.

    Coordinates are the time and space columns, however they are spelled, level,
    product, cube positions and ``coords``.
    """
    known = {c for c in (*CUBE_COORDS, *OTHER_COORDS, *coords,
                         *find_coords(df.columns).values(), find_time(df.columns, time_col))}
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in known]


def _files_differ(df: DataFrame, variables: Sequence[str]) -> bool:
    """Whether some file has values of some of the variables only.

    One row per file is shuffled, and a single row reaches the driver.
    """
    held = [F.bool_or(F.col(f"`{v}`").isNotNull() & ~F.isnan(F.col(f"`{v}`").cast("double")))
            for v in variables]
    per_file = df.groupBy(F.col("_metadata.file_path")).agg(F.array(*held).alias("held"))
    some = F.array_contains("held", True) & F.array_contains("held", False)
    return not per_file.where(some).limit(1).isEmpty()


def combine_by_coords(df: DataFrame, variables: Sequence[str]) -> DataFrame:
    """One row per coordinates, each variable from the rows that hold it.

    All other columns are the coordinates; a missing coordinate equals a missing
    one. Rows that hold different values of one variable are an error. Values
    combine before the shuffle, so coordinates shared by very many files reach
    it as one row per task.
    """
    coords = [c for c in df.columns if c not in variables]
    place = F.concat_ws(", ", *(F.concat(F.lit(f"{c}="), F.col(f"`{c}`").cast("string"))
                                for c in coords))

    def only(v: str):
        differ = F.raise_error(F.concat(F.lit(f"conflicting values of {v} at "), place))
        return F.when(F.min(f"`{v}`") != F.max(f"`{v}`"), differ.cast(df.schema[v].dataType)
                      ).otherwise(F.max(f"`{v}`")).alias(v, metadata=df.schema[v].metadata)

    return df.groupBy(*(F.col(f"`{c}`") for c in coords)).agg(*(only(v) for v in variables)).select(
        *(F.col(f"`{c}`") for c in df.columns))


def read_grid(spark: SparkSession, path: str, time_col: str = "valid_time",
              file_format: str = "parquet",
              schema: T.StructType | str | None = None,
              coords: Sequence[str] = ()) -> DataFrame:
    """All files of a folder as one grid, with its time column named ``time_col``.

    The columns are those of all files. Files of the same variables only add
    rows, so their union needs no shuffle and no sort; the order of time is
    restored by the windows that need it. Where files hold different variables,
    rows of equal coordinates become one (``combine_by_coords``); ``coords`` names
    numeric coordinates other than time, place, level and product. A folder with
    one variable is never looked at for that, one with several once. Columns of
    one name have one type, and text files have the same header; anything else is
    an error.
    """
    df = _one_name_per_axis(_load(spark, path, file_format, schema))
    variables = data_variables(df, time_col, coords)
    cleared = _clear_nan(df)
    if len(variables) > 1 and _files_differ(df, variables):
        cleared = combine_by_coords(cleared, variables)
    return normalize_time(cleared, expected=time_col)


def read_index_store(spark: SparkSession, path: str,
                     time_col: str = "date") -> DataFrame:
    """An index store without the variables that do not vary over time.

    A folder holds one table per shape, so a variable without a time dimension
    sits in a table without a time column: such a table is an error here, and
    columns marked ``{"dims": "space"}`` in their metadata are dropped.
    """
    df = _load(spark, path, "parquet", None)
    time_name = find_time(df.columns, time_col, hints=("time", "day", "date"))
    coords = set(CUBE_COORDS) | set(COORD_COLUMNS) | {time_name, "year"}
    keep = [f.name for f in df.schema.fields
            if f.name in coords or f.metadata.get("dims") != "space"]
    return _clear_nan(df.select(*(F.col(f"`{c}`") for c in keep)))
