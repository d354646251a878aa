"""Neighbourhood queries (J7, J8, J10, N1-N3) over a vertex/edge snapshot.

``vertices``: (id, label, name, properties...); ``edges``: (label,
start_id, end_id, mgm). A start set is either a list of ids (becomes a
pushed-down ``IN`` filter on the edge scan, so a sorted snapshot skips row
groups) or a DataFrame with an ``id`` column (a join; AQE broadcasts it
when its measured size is small, otherwise it is a sort-merge join).

Expansion is a hash join, which already fetches the far vertices' properties
in bulk: there is no per-vertex property lookup to batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import has_neq
from ..functions.projections import project_or_constant


def start_by_names(vertices: DataFrame, names, label: str | None = None, index=None) -> DataFrame:
    """``V().has([label,] 'name', within(names))`` -> the start vertices.

    ``names`` is a list (literal IN) or a DataFrame of names (semi-join). With a name index
    (``sinks.names.NameIndex``) the names' ids come from their buckets, and the vertices are read by id: for
    listed names a pushed-down filter, that of a snapshot in id order skips files and row groups by.
    """
    v = vertices if label is None else vertices.where(F.col("label") == label)
    if index is not None:
        if isinstance(names, DataFrame):
            return v.join(index.find(names.select(F.col(names.columns[0]).alias("name")), label).select("id"), "id", "left_semi")
        return v.where(F.col("id").isin(index.ids(list(names), label)))
    if isinstance(names, DataFrame):
        return v.join(names.select(F.col(names.columns[0]).alias("name")), "name", "left_semi")
    return v.where(F.col("name").isin(list(names)))


def _restrict(edges: DataFrame, start, col: str, label: str | None) -> DataFrame:
    e = edges if label is None else edges.where(F.col("label") == label)
    if isinstance(start, DataFrame):
        return e.join(start.select(F.col("id").alias(col)), col, "left_semi")
    return e.where(F.col(col).isin(list(start)))


def out_e(edges: DataFrame, start, label: str | None = None) -> DataFrame:
    """J8 (first half): out-edges of the start set, as stored."""
    return _restrict(edges, start, "start_id", label)


def in_e(edges: DataFrame, start, label: str | None = None) -> DataFrame:
    """In-edges of the start set, as stored."""
    return _restrict(edges, start, "end_id", label)


def other_v(edges_from: DataFrame, vertices: DataFrame, props: Sequence[str] = ("name",),
            far: str = "end_id") -> DataFrame:
    """J8 (second half): each edge with its far vertex's properties (``other_*`` columns)."""
    v = vertices.select(F.col("id").alias(far), *[F.col(p).alias(f"other_{p}") for p in props])
    return edges_from.join(v, far)


def both(edges: DataFrame, start, label: str | None = None, edges_in: DataFrame | None = None) -> DataFrame:
    """(start_id, nbr_id) over out- and in-edges, bag semantics.

    Each side is restricted to the start set before the two are put together, so
    only the start set's edges are ever moved. ``edges_in`` may name a copy of the
    edges laid out by end_id (``read_in_edges``), which the in side then reads. A
    self-loop on a start vertex yields it twice.
    """
    out = out_e(edges, start, label).select("start_id", F.col("end_id").alias("nbr_id"))
    back = in_e(edges if edges_in is None else edges_in, start, label)
    return out.unionByName(back.select(F.col("end_id").alias("start_id"), F.col("start_id").alias("nbr_id")))


def both_from(edges: DataFrame, start: DataFrame, label: str | None = None,
              edges_in: DataFrame | None = None) -> DataFrame:
    """As ``both``, carrying the columns of the start rows (start_id, unique, and any others) along."""
    e = edges if label is None else edges.where(F.col("label") == label)
    i = e if edges_in is None else edges_in if label is None else edges_in.where(F.col("label") == label)
    out = e.select("start_id", F.col("end_id").alias("nbr_id")).join(start, "start_id")
    back = i.select(F.col("end_id").alias("start_id"), F.col("start_id").alias("nbr_id")).join(start, "start_id")
    return out.unionByName(back)


def match_pattern(vertices: DataFrame, edges: DataFrame, a_label: str, edge_label: str, b_label: str,
                  a_props: Sequence[str] = ("name",), b_props: Sequence[str] = ("name",)) -> DataFrame:
    """(a:A)-[e:E]->(b:B) as one row per edge with a_*/b_* properties and mgm."""
    a = vertices.where(F.col("label") == a_label).select(
        F.col("id").alias("start_id"), *[F.col(p).alias(f"a_{p}") for p in a_props])
    b = vertices.where(F.col("label") == b_label).select(
        F.col("id").alias("end_id"), *[F.col(p).alias(f"b_{p}") for p in b_props])
    e = edges.where(F.col("label") == edge_label)
    return e.join(a, "start_id").join(b, "end_id")


def neighbours_filtered(vertices: DataFrame, edges: DataFrame, names, label: str, pred: Column,
                        start_label: str | None = None, props: Sequence[str] = ("name",),
                        edges_in: DataFrame | None = None, index=None) -> DataFrame:
    """``V().has('name', within(names)).both(label).<pred>``.

    Output: start_id, nbr_id and the neighbour's ``props`` (bag: a
    neighbour reached twice appears twice). ``edges_in``: the edges as laid out by end_id, which the in side
    then reads. ``index``: a name index; listed names then become ids that both edge layouts are filtered by.
    """
    if index is not None and not isinstance(names, DataFrame):
        start = index.ids(list(names), start_label)
    elif index is not None:
        start = index.find(names.select(F.col(names.columns[0]).alias("name")), start_label)
    else:
        start = start_by_names(vertices, names, start_label)
    nb = both(edges, start, label, edges_in)
    v = vertices.where(pred).select(F.col("id").alias("nbr_id"), *[F.col(p).alias(f"nbr_{p}") for p in props])
    return nb.join(v, "nbr_id")


def count_other_v(vertices: DataFrame, edges: DataFrame, start, label: str, neq_name: str,
                  per_start: bool = False) -> DataFrame:
    """``V(start).outE(label).otherV().has('name', neq(x)).count()``.

    One row (``cnt``) for the whole start set, or (start_id, cnt) per start
    vertex with ``per_start``. The far vertex lookup is one hash join;
    counting is map-side combined.
    """
    far = vertices.where(has_neq("name", neq_name)).select(F.col("id").alias("end_id"))
    hits = out_e(edges, start, label).join(far, "end_id")
    if per_start:
        return hits.groupBy("start_id").agg(F.count(F.lit(1)).alias("cnt"))
    return hits.agg(F.count(F.lit(1)).alias("cnt"))


def hub(edges: DataFrame, label: str, direction: str = "out") -> DataFrame:
    """The vertex with the most edges of ``label`` in one direction (ties: smallest id), as (id, degree).

    A top-1: each task keeps its best row, so only one row per task moves.
    """
    col = "start_id" if direction == "out" else "end_id"
    deg = edges.where(F.col("label") == label).groupBy(F.col(col).alias("id")).agg(F.count(F.lit(1)).alias("degree"))
    return deg.orderBy(F.col("degree").desc(), F.col("id")).limit(1)


def pairs_report(vertices: DataFrame, edges: DataFrame, names, label: str, columns: dict[str, str],
                 start_label: str | None = None, default: str = "null", edges_in: DataFrame | None = None,
                 index=None) -> DataFrame:
    """start/neighbour pairs as flat rows, missing properties as ``default``.

    ``columns`` maps output name -> ``m1.<prop>`` (start) or ``m2.<prop>``
    (neighbour). ``edges_in`` and ``index`` as in ``neighbours_filtered``.
    """
    props = sorted({src.split(".", 1)[1] for src in columns.values()})
    start = start_by_names(vertices, names, start_label, index)
    if index is not None and not isinstance(names, DataFrame):
        ids = index.ids(list(names), start_label)  # the edges are filtered by the same ids as the vertices
        edges_in = (edges if edges_in is None else edges_in).where(F.col("end_id").isin(ids))
        edges = edges.where(F.col("start_id").isin(ids))
    start = start.select(F.col("id").alias("start_id"), *[F.col(p).alias(f"m1.{p}") for p in props])
    m2 = vertices.select(F.col("id").alias("nbr_id"), *[F.col(p).alias(f"m2.{p}") for p in props])
    j = both_from(edges, start, label, edges_in).join(m2, "nbr_id")
    return project_or_constant(j, {out: f"`{src}`" for out, src in columns.items()}, default)
