"""Table sources (S6, S7) and the driver's parquet tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """Full scan of a staged table: a catalog name or a parquet folder."""
    if "/" in name_or_path or name_or_path.endswith(".parquet"):
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def rows_to_df(spark: SparkSession, rows: Iterable, schema: T.StructType | str) -> DataFrame:
    """Small in-memory rows with an explicit schema (samples, tests)."""
    return spark.createDataFrame(list(rows), schema)


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables, e.g. ``customer``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
