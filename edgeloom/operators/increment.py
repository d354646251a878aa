"""Increments that reach the queried graph: vertices with ids, edges between ids.

The state is a loaded snapshot: vertices (id, label, name, properties) and
edges (label, start_id, end_id, mgm). A delta comes by name. Existing ids
never change; new names get the numbers after the largest id, in name order,
by the same spread-out numbering as a first load, over the new names only.
What cannot be taken is returned, with a reason, next to the new state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import freeze
from .ids import assign_dense_ids
from .merge import merge_edges, merge_vertices


def extend_ids(vertices: DataFrame, names: DataFrame, top: int | None = None) -> DataFrame:
    """(id, name) for those ``names`` that no vertex has: ids from the largest one, or the known ``top``, up."""
    new = names.select("name").where(F.col("name").isNotNull()).distinct().join(
        vertices.select("name"), "name", "left_anti")
    top = vertices.select(F.coalesce(F.max("id"), F.lit(0)).alias("top")).scalar() if top is None else F.lit(top)
    return assign_dense_ids(new).select((F.col("id") + top).alias("id"), "name")


def vertex_rejects(vertices: DataFrame, delta: DataFrame) -> DataFrame:
    """(label, name, error) of the delta keys that cannot be vertices of the graph.

    Names are unique over all labels: a name that another label holds already, or that the delta gives under
    several labels, is refused; so is a row without a name or label. One row per distinct key.
    """
    keys = delta.select("label", "name").distinct()
    held = vertices.select("name", F.col("label").alias("_held"))
    several = (keys.where(F.col("name").isNotNull() & F.col("label").isNotNull()).groupBy("name")
               .agg((F.count(F.lit(1)) > 1).alias("_several")))
    error = (F.when(F.col("name").isNull(), "no name").when(F.col("label").isNull(), "no label")
             .when(F.col("_held") != F.col("label"), "name of another label")
             .when(F.col("_held").isNull() & F.col("_several"), "several labels"))
    return (keys.join(held, "name", "left").join(several, "name", "left")
            .select("label", "name", error.alias("error")).where(F.col("error").isNotNull()))


def increment_vertices(vertices: DataFrame, delta: DataFrame, ord_col: str = "ord", top: int | None = None) -> DataFrame:
    """G6 on a loaded graph: the next vertices (id, label, name, properties).

    ``delta``: (label, name, properties..., ord). Existing vertices keep their id; refused keys
    (``vertex_rejects``) change nothing. With the largest id known (``top``), ``vertices`` may be only those
    that hold a name of the delta: then the result is what becomes of these.
    """
    bad = vertex_rejects(vertices, delta).select("label", "name")
    good = delta.join(bad, ["label", "name"], "left_anti").dropna("any", subset=["label", "name"])
    good = freeze(good, "accepted-delta")  # read for the new names and for the merge
    merged = merge_vertices(vertices, good, ord_col=ord_col)
    ids = extend_ids(vertices, good, top).withColumnRenamed("id", "_new_id")
    out = merged.join(ids, "name", "left").withColumn("id", F.coalesce("id", "_new_id"))
    return out.select("id", "label", "name", *[c for c in merged.columns if c not in ("id", "label", "name")])


def increment_edges(edges: DataFrame, vertices: DataFrame, delta: DataFrame, ord_col: str = "ord") -> DataFrame:
    """G7 on a loaded graph: the next edges (label, start_id, end_id, mgm), one per key.

    ``delta``: (start_name, label, end_name, mgm, ord). Both ends are looked up by name, in any label; an
    edge with an unknown end is left out (``dangling_edges`` returns it). ``edges`` may hold copies, as an
    append leaves them: of several mgm the largest stays, since a snapshot keeps no order.
    """
    return upsert_resolved(edges, resolve_delta(delta, vertices, ord_col))


def resolve_delta(delta: DataFrame, vertices: DataFrame, ord_col: str = "ord") -> DataFrame:
    """(label, start_id, end_id, mgm, ord) of the delta edges both of whose ends are there."""
    ids = vertices.select("name", "id")
    return (delta.join(ids.withColumnRenamed("id", "start_id"), delta["start_name"] == ids["name"]).drop("name")
            .join(ids.withColumnRenamed("id", "end_id"), F.col("end_name") == F.col("name"))
            .select("label", "start_id", "end_id", "mgm", F.col(ord_col).alias("ord")))


def upsert_resolved(edges: DataFrame, resolved: DataFrame) -> DataFrame:
    """The next edges, from stored ones (copies are folded) and resolved delta edges."""
    state = edges.groupBy("label", "start_id", "end_id").agg(F.max("mgm").alias("mgm"))
    return merge_edges(state, resolved, keys=("start_id", "label", "end_id"), state_folded=True).select(
        "label", "start_id", "end_id", "mgm")
