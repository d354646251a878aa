"""Table sinks (K1-K3) and graph snapshots.

A graph snapshot is three parquet folders: ``vertices`` (wide: id, label,
properties) in id order, ``edges`` (label, start_id, end_id, mgm) partitioned
by label in start_id order, and ``edges_in``, the same edges in end_id order.
Orders are global (range-partitioned), so a lookup of a few vertices reads
one label's folder, and skips files and row groups by their min/max
statistics on either side of an edge. ``versions`` publishes snapshots.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import freeze


def create_table_as(df: DataFrame, name: str) -> None:
    """K1: CTAS; fails if the table exists."""
    df.write.mode("error").saveAsTable(name)


def replace_table(df: DataFrame, name: str, bucket_by: tuple[str, ...] = (), buckets: int = 0) -> None:
    """K2: drop-if-exists + create. Optionally bucketed and sorted by key
    (``bucket_by``), so later joins/merges on that key do not shuffle this side."""
    w = df.write.mode("overwrite")
    if bucket_by and buckets:
        w = w.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    w.saveAsTable(name)


def create_swapped(df: DataFrame, name: str) -> None:
    """K2 for tables that readers see whole at any time: the rows go to a table of their own, ``name`` is a view of it."""
    stage = f"{name}__{uuid.uuid4().hex}"
    df.write.mode("error").saveAsTable(stage)
    _point(df.sparkSession, name, stage)


def _point(spark: SparkSession, name: str, stage: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {stage}")


def _stage_of(spark: SparkSession, name: str) -> str:
    """The table that the view ``name`` of ``create_swapped`` points to."""
    text = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'View Text'").first()["data_type"]
    return text.split(" FROM ")[1].strip()


def insert_overwrite(df: DataFrame, name: str) -> None:
    """K3: replace a table's contents, also when ``df`` reads that same table.

    For a view made by ``create_swapped`` the rows are written once, to a new table, and then the view is
    pointed at it: a reader or a crash sees the old rows or the new ones. The old table stays, for
    readers that still scan it, until ``drop_old_stages``.

    A plain table has no such pointer: Spark refuses to overwrite a table its own query reads, so the result is
    first frozen in the checkpoint folder (which cuts the plan's link to the table), then written over it.
    """
    spark = df.sparkSession
    if spark.catalog.getTable(name).tableType != "VIEW":
        freeze(df).write.mode("overwrite").insertInto(name, overwrite=True)
        return
    fields = spark.table(name).schema.fields
    stage = f"{name}__{uuid.uuid4().hex}"
    rows = df.toDF(*[f"c{i}" for i in range(len(fields))])  # by position, as an insert takes its columns
    rows.select(*[F.col(f"c{i}").cast(f.dataType).alias(f.name) for i, f in enumerate(fields)]).write.mode("error").saveAsTable(stage)
    _point(spark, name, stage)


def drop_old_stages(spark: SparkSession, name: str) -> list[str]:
    """Drop the tables that the view ``name`` no longer points to (no reader and no writer of it may be at work)."""
    database, _, short = name.rpartition(".")
    now = _stage_of(spark, name).rpartition(".")[2].strip("`").lower()
    old = [t.name for t in spark.catalog.listTables(database or None)
           if t.tableType != "VIEW" and t.name.lower().startswith(f"{short.lower()}__") and t.name.lower() != now]
    for t in old:
        spark.sql(f"DROP TABLE {f'{database}.{t}' if database else t}")
    return old


def write_snapshot(vertices: DataFrame, edges: DataFrame, path: str, vertices_stored: bool = False) -> None:
    """Write a graph snapshot below ``path`` (a fresh folder).

    A range layout reads its input twice (to find the ranges, then to write), and edges have two layouts:
    so both inputs are stored once, and what they are made of runs once; the edges in runs of their ends, which
    compress well here and in both shuffles. ``vertices_stored``: the vertices are
    read from a table already, as those of ``stage_all`` are, and need not be stored again.
    """
    vertices = vertices if vertices_stored else freeze(vertices, "snapshot-vertices")
    edges = freeze(edges.sortWithinPartitions("end_id"), "snapshot-edges")
    (vertices.repartitionByRange("id").sortWithinPartitions("id").write.parquet(f"{path}/vertices"))
    for name, key in (("edges", "start_id"), ("edges_in", "end_id")):
        (edges.repartitionByRange("label", key).sortWithinPartitions("label", key)
         .write.partitionBy("label").parquet(f"{path}/{name}"))


_EDGES = "start_id bigint, end_id bigint, mgm int, label string"


def _edges(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_EDGES).parquet(path).select("label", "start_id", "end_id", "mgm")


def read_snapshot(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(vertices, edges) of a snapshot written by ``write_snapshot``."""
    return spark.read.parquet(f"{path}/vertices"), _edges(spark, f"{path}/edges")


def read_in_edges(spark: SparkSession, path: str) -> DataFrame:
    """The snapshot's edges as laid out by end_id, for lookups of in-edges."""
    return _edges(spark, f"{path}/edges_in")


def next_version(base: str) -> str:
    """A fresh folder name for the next snapshot under ``base`` (never overwrite the one being read)."""
    return f"{base.rstrip('/')}/v-{uuid.uuid4().hex}"
