"""The batch load as one plan (G8): raw text -> staged tables -> ids -> resolved edges.

Each text line is parsed once, into a staged table that holds the good rows
and the refused lines with their reason; vertices, edges and ``rejects`` are
read from it. Other materialisation points: the id map (frozen by
``assign_dense_ids``) and the id-attached vertices, which every edge
resolution reads. Names still found under two labels after the conflict
removal are reported in ``remaining`` (the gate before loading).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ids import assign_dense_ids, attach_ids, union_names
from ..operators.quality import conflicts_by_name, remove_conflicting
from ..operators.resolve import graph_edges, resolve_all
from ..operators.stage import split_staged, stage_vertices_wide, union_staged
from ..schema import CALL, EDGE_LABELS, VERTEX_LABELS, WIFI, columns_for
from ..session import freeze
from ..sources.text import parse_edge_rows, parse_vertex_lines, with_load_errors
from .graph import wide_vertices


@dataclass
class LoadedGraph:
    ids: DataFrame                      # (id, name)
    vertices: dict[str, DataFrame]      # label -> (id, staged columns...)
    resolved: dict[str, DataFrame]      # edge label -> (start_id, end_id[, mgm])
    conflicts: DataFrame                # (name, count)
    staged_vertices: dict[str, DataFrame] | None = None   # before conflict removal
    staged_edges: dict[str, DataFrame] | None = None      # by name
    remaining: DataFrame | None = None  # (name, count): still under several labels after the removal
    rejects: DataFrame | None = None    # (source, line, error) of refused text lines

    @property
    def edges(self) -> DataFrame:
        """All resolved edges as (label, start_id, end_id, mgm)."""
        return graph_edges(self.resolved)

    def wide_vertices(self) -> DataFrame:
        """All vertices as (id, label, every property column; absent ones null)."""
        return wide_vertices(self.vertices)


def load_graph(staged_vertices: dict[str, DataFrame], staged_edges: dict[str, DataFrame],
               give_way: str = WIFI, materialize: bool = False) -> LoadedGraph:
    """Conflicts -> removal from ``give_way`` -> dense ids -> attach -> resolve.

    With ``materialize`` the id-attached vertices are written once: every
    edge label's resolution reads them, and a stored table carries the size
    statistics from which the planner picks its joins. Their number by label says which ids are hashed.
    """
    n_vertices = None
    conflicts = conflicts_by_name(staged_vertices)
    clean = dict(staged_vertices)
    clean[give_way] = remove_conflicting(clean[give_way], conflicts)
    ids = assign_dense_ids(union_names(*clean.values()))
    if materialize:  # one join of the id map for all labels, stored once
        wide = freeze(attach_ids(union_staged(clean), ids), "vertex-ids")
        with_ids = {label: wide.where(F.col("label") == label).select("id", *columns_for(label)) for label in clean}
        n_vertices = {r["label"]: r["count"] for r in wide.groupBy("label").count().collect()}
    else:
        with_ids = {label: attach_ids(v, ids) for label, v in clean.items()}
    resolved = resolve_all(staged_edges, with_ids, n_vertices)
    return LoadedGraph(ids=ids, vertices=with_ids, resolved=resolved, conflicts=conflicts,
                       staged_vertices=staged_vertices, staged_edges=staged_edges,
                       remaining=conflicts_by_name(clean))


def stage_text(vertex_lines: DataFrame, edge_lines: dict[str, DataFrame] | DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every text line parsed once: staged vertex rows and staged edge rows, good and refused.

    Vertices: (label, staged columns..., line, error); edges: (label, start_name, end_name, mgm, line, error).
    ``line`` is kept for refused lines only. ``edge_lines`` is one text DataFrame per edge label (the export
    writes one file per label), or one holding all labels; there a line with another label is refused.
    """
    v = with_load_errors(parse_vertex_lines(vertex_lines), VERTEX_LABELS)
    vertices = stage_vertices_wide(v, "error", "line")
    if isinstance(edge_lines, dict):
        parts = [parse_edge_rows(lines, "call" if label == CALL else "plain").withColumn("label", F.lit(label))
                 for label, lines in edge_lines.items()]
        edges = reduce(DataFrame.unionByName, parts)
    else:
        edges = parse_edge_rows(edge_lines, "labelled")
        edges = edges.withColumn("error", F.coalesce("error", F.when(
            ~F.coalesce(F.col("label").isin(*EDGE_LABELS), F.lit(False)), F.lit("unknown label"))))
    bad = F.col("error").isNotNull()
    return (vertices.withColumn("line", F.when(bad, F.col("line"))),
            edges.select("label", "start_name", "end_name", "mgm", F.when(bad, F.col("line")).alias("line"), "error"))


def stage_all(vertex_lines: DataFrame, edge_lines, give_way: str = WIFI) -> LoadedGraph:
    """The whole batch load from raw text, with the refused lines in ``rejects``."""
    wide, edges = stage_text(vertex_lines, edge_lines)
    wide, edges = freeze(wide, "staged-vertices"), freeze(edges, "staged-edges")
    good = edges.where(F.col("error").isNull())
    by_label = {label: good.where(F.col("label") == label).select(
        "start_name", "end_name", *(["mgm"] if label == CALL else [])) for label in EDGE_LABELS}
    g = load_graph(split_staged(wide.where(F.col("error").isNull())), by_label, give_way, materialize=True)
    g.rejects = reduce(DataFrame.unionByName, [
        t.where(F.col("error").isNotNull()).select(F.lit(name).alias("source"), "line", "error")
        for name, t in (("vertices", wide), ("edges", edges))])
    return g
