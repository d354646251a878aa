"""Adjacency lines kept up to date: after an increment, only the lines it touches are folded again.

A line shows its vertex' properties and, of every edge, the label, the other
end's id and mgm. So a changed vertex changes its own line, a changed edge
the lines of both of its ends, and nothing else.

The touched ids may be most of a large graph's, too many for a broadcast. So they are kept as a packed set
(``idset``), by which stored lines and edges are picked without being shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.graph import by_label
from ..sinks.layers import Graph, layers_of
from .adjacency import build_adjacency, vertex_records
from .idset import IdSet, pack_ids


def touched_ids(graph: Graph, since: Graph | None = None) -> DataFrame:
    """(id) whose line may have changed by the layers of ``graph`` that ``since`` did not have: the change feed."""
    old = set(layers_of(since.commit)) if since else set()
    folders = [graph.commit.parts[k] for k in layers_of(graph.commit) if k not in old]
    ids = [graph.spark.createDataFrame([], "id bigint")]
    for f in folders:
        ids.append(graph.spark.read.parquet(f"{f}/vertices").select("id"))
        ids.append(graph.spark.read.parquet(f"{f}/edges").select(F.explode(F.array("start_id", "end_id")).alias("id")))
    return reduce(DataFrame.unionByName, ids).distinct()


def fold_touched(graph: Graph, touched: DataFrame, ids: IdSet | None = None) -> DataFrame:
    """The adjacency (``build_adjacency``) of the touched vertices only; reads the parts that they and their edges are in.

    A touched vertex takes its out sides from the edges laid out by start and its in sides from those laid out by end, so
    no edge is taken twice. ``ids``: the touched ids as a set, if it is there already.
    """
    ids = ids or pack_ids(touched, "id")
    parts = graph.parts_of("vertices", touched)  # all tables are cut at the same ids
    mine = ids.of(graph.rows("vertices", parts), "id")
    out, back = ids.of(graph.rows("edges", parts), "start_id"), ids.of(graph.rows("edges_in", parts), "end_id")
    share = min(1.0, touched.count() / max(1, int(graph.commit.parts["top"])))
    return build_adjacency(vertex_records(by_label(mine)), out, edges_stored=True, in_edges=back, n_edges=graph.most("edges"),
                           share=share)


def refold(lines: DataFrame, graph: Graph, touched: DataFrame, encode) -> DataFrame:
    """The lines (id, label, ...) of ``graph``: those of touched vertices are made anew, by ``encode`` of their
    adjacency, the others are taken over."""
    ids = pack_ids(touched, "id")
    return ids.of(lines, "id", "left_anti").unionByName(encode(fold_touched(graph, touched, ids)))
