"""Sources and sinks: panel tables and metric tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.scalar import nan_to_null


def read_panel(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               fmt: str | None = None) -> DataFrame:
    """Read a panel table (Parquet by default, headered CSV for ``.csv``); NaN becomes null.

    Pass an explicit ``schema`` for CSV on large inputs: inference costs a full extra scan.
    """
    fmt = fmt or ("csv" if path.endswith(".csv") else "parquet")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        df = reader.option("header", True).option("inferSchema", schema is None).csv(path)
    else:
        df = reader.format(fmt).load(path)
    return nan_to_null(df)


def write_panel(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Write a panel table. CSV gets a header and no index; Parquet is the default."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_metrics(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A metrics table as JSON lines (one object per row); one file for small tables."""
    df.coalesce(1).write.mode(mode).json(path)


def read_metrics(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)
