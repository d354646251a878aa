"""Registered queries over layered graphs, their name index, and states in parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.predicates import has_eq, or_
from ..operators.traverse import count_other_v, neighbours_filtered, pairs_report
from ..operators.merge import merge_edges, merge_vertices
from ..schema import MOBILE
from ..session import freeze, fresh_folder
from ..sinks.layers import Graph, fold_layers, increment, layers_of, read_graph, write_graph
from ..sinks.parts import merge_into_parts, read_parts
from . import fixtures as fx
from .catalog import register
from .q_load import graph
from .q_merge import _EDGE_CTES, _INCREMENT_CTES, _VERTEX_CTES, _loaded, _merge_inputs
from .q_query import _BOTH_CALL, NEQ_NAME

#: small parts and buckets, so that the tables of a test have several
_PART_IDS, _BUCKET_NAMES = 500, 200


def _delta(spark, sf_dir):
    calls = fx.call_keyed(spark, sf_dir).where((F.col("ord") % 3 == 0) | (F.col("ord") % 4 == 0))
    return freeze(_merge_inputs(spark, sf_dir)[1], "vertex-delta"), freeze(calls, "edge-delta")


def _incremented(spark, sf_dir, fold: bool = False) -> Graph:
    """The loaded graph with its delta in two layers, by the parity of the key; read as layers, or folded."""
    base = fresh_folder(spark, "layered")
    write_graph(spark, base, *_loaded(spark, sf_dir), part_ids=_PART_IDS, bucket_names=_BUCKET_NAMES)
    v_delta, e_delta = _delta(spark, sf_dir)
    early = (F.col("ord") % 2) == 0
    # a new edge may need a vertex of the same layer only, so all vertices come first
    increment(spark, base, v_delta, e_delta.where(early))
    increment(spark, base, v_delta.limit(0), e_delta.where(~early))
    if fold:
        fold_layers(spark, base)
    return read_graph(spark, base)


@register("layered_vertices", "select id, label, name, merchant_name, status from inext", extra_ctes=_INCREMENT_CTES)
def q_layered_vertices(spark, sf_dir):
    return _incremented(spark, sf_dir).vertices.select("id", "label", "name", "merchant_name", "status")


# the two layers take the delta in the order of (parity, ord)
_LAYERED_EDGES = """
select label, start_id, end_id, coalesce(late, early, stored) as mgm from (
  select coalesce(s.label, d.label) as label, coalesce(s.start_id, d.start_id) as start_id, coalesce(s.end_id, d.end_id) as end_id,
    s.mgm as stored, early, late
  from iold_edge s full join (
    select e.label, a.id as start_id, b.id as end_id,
      arg_max(mgm, ord) filter (where mgm is not null and ord % 2 = 0) as early,
      arg_max(mgm, ord) filter (where mgm is not null and ord % 2 = 1) as late
    from ckey e join inext a on a.name = start_name join inext b on b.name = end_name
    where ord % 3 = 0 or ord % 4 = 0 group by all
  ) d on d.label = s.label and d.start_id = s.start_id and d.end_id = s.end_id)
"""


@register("layered_edges", _LAYERED_EDGES, extra_ctes=_INCREMENT_CTES)
def q_layered_edges(spark, sf_dir):
    return _incremented(spark, sf_dir).edges


@register("folded_edges_in", _LAYERED_EDGES, extra_ctes=_INCREMENT_CTES)
def q_folded_edges_in(spark, sf_dir):
    """The layout by end_id after a fold: every part that the layers touched was written anew."""
    g = _incremented(spark, sf_dir, fold=True)
    assert not layers_of(g.commit)
    return g.edges_in


@register("folded_vertices", "select id, label, name, merchant_name, status from inext", extra_ctes=_INCREMENT_CTES)
def q_folded_vertices(spark, sf_dir):
    return _incremented(spark, sf_dir, fold=True).vertices.select("id", "label", "name", "merchant_name", "status")


@register("layered_rejects", """
select to_json({'label': label, 'name': name})::varchar as line, error from ibad
union all
select to_json({'start_name': start_name, 'label': label, 'end_name': end_name})::varchar, concat('missing: ',
  case when start_name in (select name from inext) then 'end' when end_name in (select name from inext) then 'start' else 'both' end)
from ckey where (ord % 3 = 0 or ord % 4 = 0)
  and (start_name not in (select name from inext) or end_name not in (select name from inext))
""", extra_ctes=_INCREMENT_CTES)
def q_layered_rejects(spark, sf_dir):
    g = _incremented(spark, sf_dir)
    folders = [g.commit.parts[k] for k in layers_of(g.commit)]
    return spark.read.parquet(*[f"{f}/rejects" for f in folders])


@register("layered_count_other_v", f"""
select start_id, count(*) as cnt from inext_edge join inext on id = end_id and name <> '{NEQ_NAME}' group by start_id
""", extra_ctes=_INCREMENT_CTES)
def q_layered_count_other_v(spark, sf_dir):
    """N2 over a base and two layers."""
    g = _incremented(spark, sf_dir)
    return count_other_v(g.vertices, g.edges, g.vertices.select("id"), "CALL", NEQ_NAME, per_start=True)


# --------------------------------------------------------------------------- name index
def _indexed(spark, sf_dir) -> Graph:
    g, base = graph(spark, sf_dir), fresh_folder(spark, "indexed")
    write_graph(spark, base, g.wide_vertices(), g.edges, part_ids=_PART_IDS, bucket_names=_BUCKET_NAMES)
    return read_graph(spark, base)


_SINGLE_CALL = _BOTH_CALL.replace("from edges where", "from (select distinct label, start_id, end_id from edges) where")


@register("index_names", "select name, id, label from vwide where name is not null")
def q_index_names(spark, sf_dir):
    """Every name looked up in the index, buckets by buckets."""
    g = _indexed(spark, sf_dir)
    return g.names.find(g.vertices.select("name"))


@register("index_neighbours_filtered", """
select b.start_id, b.nbr_id, v.name as nbr_name from both_call b join vwide v on v.id = b.nbr_id
where b.start_id in (select id from service) and (v.is_register = 'true' or v.is_risk = 'true')
""", extra_ctes=_SINGLE_CALL)
def q_index_neighbours_filtered(spark, sf_dir):
    """N1 whose start comes from the name index, with both edge layouts."""
    g = _indexed(spark, sf_dir)
    names = g.vertices.where((F.col("label") == MOBILE) & has_eq("is_service", "true")).select("name")
    pred = or_(has_eq("is_register", "true"), has_eq("is_risk", "true"))
    return neighbours_filtered(g.vertices, g.edges, names, "CALL", pred, start_label=MOBILE, edges_in=g.edges_in, index=g.names)


@register("index_pairs_report", """
select a.name as c_name, v.name as mobile, coalesce(v.is_risk, 'null') as is_risk from both_call b
join service a on a.id = b.start_id join vwide v on v.id = b.nbr_id
""", extra_ctes=_SINGLE_CALL)
def q_index_pairs_report(spark, sf_dir):
    """N3 whose start comes from the name index, with both edge layouts."""
    g = _indexed(spark, sf_dir)
    names = g.vertices.where((F.col("label") == MOBILE) & has_eq("is_service", "true")).select("name")
    cols = {"c_name": "m1.name", "mobile": "m2.name", "is_risk": "m2.is_risk"}
    return pairs_report(g.vertices, g.edges, names, "CALL", cols, MOBILE, edges_in=g.edges_in, index=g.names)


# --------------------------------------------------------------------------- states in parts
def _parts(spark, keys, state, delta, empty, load, merge):
    """The state loaded, and then the delta merged, into parts that split as they grow."""
    folder = fresh_folder(spark, "parts")
    parts: dict[str, str] = {}
    for k, (rows, into) in enumerate(((state, load), (delta, merge))):
        change = merge_into_parts(spark, parts, keys, freeze(rows, "rows"), empty, into, f"{folder}/{k}", part_rows=300)
        parts = {p: f for p, f in parts.items() if p not in change["drop"]} | change["parts"]
    return read_parts(spark, parts)


@register("parts_merge_vertices", "select * from merged", extra_ctes=_VERTEX_CTES)
def q_parts_merge_vertices(spark, sf_dir):
    state, delta = _merge_inputs(spark, sf_dir)
    return _parts(spark, ["label", "name"], state, delta, state.schema, lambda _, rows: rows, merge_vertices)


@register("parts_merge_edges", "select start_name, label, end_name, coalesce(came, stored) as mgm from efold", extra_ctes=_EDGE_CTES)
def q_parts_merge_edges(spark, sf_dir):
    k, vertices = fx.call_keyed(spark, sf_dir), fx.mobile(spark, sf_dir).select("name")

    def merge(state, delta):
        return merge_edges(state, delta, vertices, state_folded=True)

    return _parts(spark, ["start_name", "label", "end_name"], k.where(F.col("ord") % 3 != 0),
                  k.where((F.col("ord") % 3 == 0) | (F.col("ord") % 4 == 0)), "start_name string, label string, end_name string, mgm int",
                  merge, merge)
