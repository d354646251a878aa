"""Small DataFrame helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, by: list[str] | None = None, files: int | None = None) -> DataFrame:
    """``df`` as a Parquet table under the shared checkpoint folder: cuts lineage, gives real sizes.

    ``files``: tasks that write it at most, for a table known to be small (a task for a few rows costs more than these).
    """
    path = fresh_path(df.sparkSession, name)
    writer = (df.coalesce(files) if files else df).write
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def columns(df: DataFrame) -> list[Column]:
    """The columns of ``df``, whatever characters their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` begins like it."""
    while any(c.lower().startswith(name.lower()) for c in df.columns):
        name = f"_{name}"
    return name


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(parts)


def add_columns(df: DataFrame, ddl: str, text: str,
                fn: Callable[[pa.Array], dict[str, object]]) -> DataFrame:
    """All columns of ``df`` and those of ``ddl``, which ``fn`` computes from whole batches of column ``text``."""
    extra = StructType.fromDDL(ddl)
    clash = {c.lower() for c in extra.names} & {c.lower() for c in df.columns}
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = fn(b.column(at))
            yield pa.RecordBatch.from_arrays([*b.columns, *(
                got[c] if isinstance(got[c], pa.Array) else pa.array(got[c]) for c in extra.names)],
                names=[*b.schema.names, *extra.names])

    at = df.columns.index(text)
    return map_batches(df, run, extra)


def map_batches(df: DataFrame, run: Callable, extra: StructType) -> DataFrame:
    """``df.mapInArrow(run)`` for a ``run`` that adds the columns ``extra``; ``df``'s may have any names."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])  # mapInArrow resolves names, which may hold dots
    out = plain.mapInArrow(run, StructType([*plain.schema.fields, *extra.fields]))
    return out.toDF(*df.columns, *extra.names)
