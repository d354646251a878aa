"""Typed adjacency records (G1): a vertex with its edges as nested columns.

``build_records`` gives one row per vertex: its columns, ``in_edges`` and
``out_edges``, arrays of (label, other, mgm) in the order of the adjacency
line. Stored as Parquet in id order (``write_records``), the neighbours of a
vertex, in either direction, are read from its own row: a traversal explodes
the arrays of its start vertices and needs no join with the edges.

A hub's arrays are cut into slices: its first row (``slice`` 0) holds its columns and
no edges, and overflow rows hold the edges, each slice within one range of
neighbours. So no row outgrows ``hub_degree`` edges by more than a range
partition's share, and a hub is built and read by many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.predicates import has_neq
from .adjacency import _RANK_LABEL, DEFAULT_HUB_DEGREE, _lit_map, _side_label, half_edges, hub_ids, stored_edges

_EDGES = "array<struct<label:string,other:bigint,mgm:int>>"


def _arrays() -> list[Column]:
    """in_edges and out_edges of grouped half-edges (slot, edge), in the order of edge label, other, mgm."""
    return [F.sort_array(F.collect_list(F.when(F.col("slot") % 2 == out, F.col("edge")))).cast(_EDGES).alias(name)
            for name, out in (("in_edges", 0), ("out_edges", 1))]


def _with_edge(half: DataFrame) -> DataFrame:
    label = F.element_at(_lit_map(_RANK_LABEL), F.shiftright("slot", 1))
    return half.withColumn("edge", F.struct(label.alias("label"), "other", "mgm"))


def build_records(vertices: DataFrame, edges: DataFrame, hub_degree: int = DEFAULT_HUB_DEGREE,
                  edges_stored: bool = False) -> DataFrame:
    """G1: (id, label, properties..., slice, in_edges, out_edges); see the module.

    ``vertices``: (id, label, properties...), ids unique. A half-edge lands on the vertex with its id and the
    endpoint label of its edge label; others are left out, as in ``build_adjacency``. So is ``edges_stored``.
    """
    edges = stored_edges(edges, edges_stored)
    hubs = hub_ids(edges, hub_degree)
    half = half_edges(edges).select("id", _side_label().alias("label"), "slot", "other", "mgm")
    # shuffled as fixed-width rows: nothing is collected before the shuffle, where few halves of a vertex meet
    plain = half.join(F.broadcast(hubs), "id", "left_anti").repartition("id", "label")
    plain = _with_edge(plain).groupBy("id", "label").agg(*_arrays())
    none = F.array().cast(_EDGES)
    first = vertices.join(plain, ["id", "label"], "left").select(
        *vertices.columns, F.lit(0).cast("bigint").alias("slice"),
        *(F.coalesce(c, none).alias(c) for c in ("in_edges", "out_edges")))
    # hubs: ranges of neighbours, of which a large one is cut once more by the position in its task
    ranged = half.join(F.broadcast(hubs), "id", "left_semi").repartitionByRange("id", "label", "slot", "other", F.coalesce("mgm", F.lit(-1)))
    position = F.shiftright(F.monotonically_increasing_id(), 12)  # 4096 rows of a partition
    sliced = (_with_edge(ranged.sortWithinPartitions("id", "label", "slot", "other", "mgm").withColumn("piece", position))
              .groupBy("id", "label", "piece").agg(*_arrays()))
    known = vertices.select("id", "label").join(F.broadcast(hubs), "id", "left_semi")
    overflow = sliced.join(known, ["id", "label"], "left_semi")
    overflow = overflow.select("id", "label", (F.col("piece") + 1).alias("slice"), "in_edges", "out_edges")
    return first.unionByName(overflow, allowMissingColumns=True)


def write_records(records: DataFrame, path: str) -> None:
    """Store records in id order, so a lookup of a few vertices skips files and row groups."""
    records.repartitionByRange("id", "slice").sortWithinPartitions("id", "slice").write.parquet(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _started(records: DataFrame, start, edges: Column, label: str | None) -> DataFrame:
    """(id, e) per edge of the start set; other labels' edges go before the join, which moves what is left of a record."""
    mine = edges if label is None else F.filter(edges, lambda x: x["label"] == label)
    rows = records.select("id", mine.alias("_mine")).where(F.size("_mine") > 0)
    if isinstance(start, DataFrame):
        rows = rows.join(start.select("id"), "id", "left_semi")
    else:
        rows = rows.where(F.col("id").isin(list(start)))
    return rows.select("id", F.explode("_mine").alias("e"))


def out_of(records: DataFrame, start, label: str | None = None) -> DataFrame:
    """Out-edges (label, start_id, end_id, mgm) of the start set (ids or a frame with ``id``), from their records."""
    e = _started(records, start, F.col("out_edges"), label)
    return e.select("e.label", F.col("id").alias("start_id"), F.col("e.other").alias("end_id"), "e.mgm")


def both_of(records: DataFrame, start, label: str | None = None) -> DataFrame:
    """(start_id, nbr_id) over out- and in-edges, bag semantics, from the start vertices' records."""
    e = _started(records, start, F.concat("out_edges", "in_edges"), label)
    return e.select(F.col("id").alias("start_id"), F.col("e.other").alias("nbr_id"))


def vertices_of(records: DataFrame) -> DataFrame:
    """The vertex columns of records."""
    return records.where("slice = 0").drop("slice", "in_edges", "out_edges")


def edges_of(records: DataFrame, side: str = "out_edges") -> DataFrame:
    """(label, start_id, end_id, mgm) of every edge, from the one side or the other of all records."""
    e = records.select("id", F.explode(side).alias("e"))
    ends = ("id", "e.other") if side == "out_edges" else ("e.other", "id")
    return e.select("e.label", F.col(ends[0]).alias("start_id"), F.col(ends[1]).alias("end_id"), "e.mgm")


def record_neighbours(records: DataFrame, names, label: str, pred: Column, start_label: str | None = None) -> DataFrame:
    """N1 from records: (start_id, nbr_id, nbr_name) of the neighbours of the named vertices for which ``pred`` holds."""
    v = vertices_of(records)
    start = v if start_label is None else v.where(F.col("label") == start_label)
    if isinstance(names, DataFrame):
        start = start.join(names.select(F.col(names.columns[0]).alias("name")), "name", "left_semi")
    else:
        start = start.where(F.col("name").isin(list(names)))
    near = v.where(pred).select(F.col("id").alias("nbr_id"), F.col("name").alias("nbr_name"))
    return both_of(records, start, label).join(near, "nbr_id").select("start_id", "nbr_id", "nbr_name")


def record_count_other_v(records: DataFrame, start, label: str, neq_name: str, per_start: bool = False) -> DataFrame:
    """N2 from records: out-neighbours over ``label`` with another name than ``neq_name``, counted (per start vertex)."""
    far = vertices_of(records).where(has_neq("name", neq_name)).select(F.col("id").alias("end_id"))
    hits = out_of(records, start, label).join(far, "end_id")
    if per_start:
        return hits.groupBy("start_id").agg(F.count(F.lit(1)).alias("cnt"))
    return hits.agg(F.count(F.lit(1)).alias("cnt"))
