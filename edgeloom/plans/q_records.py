"""Registered queries over typed records, refolded lines, maintained counts, split joins and swapped tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import has_eq, or_
from ..operators.adjacency import build_adjacency, encode_adjacency, vertex_records
from ..operators.counts import (EDGE_COUNTS, EDGE_KEYS, NAME_COUNTS, NAME_KEYS, add_counts, counted_conflicts, counted_duplicates,
                                counted_uniqueness, edge_counts, name_counts)
from ..operators.records import (build_records, edges_of, read_records, record_count_other_v, record_neighbours, vertices_of,
                                 write_records)
from ..operators.refold import refold, touched_ids
from ..operators.resolve import resolve_edges_split
from ..schema import EDGE_ENDPOINTS, MOBILE
from ..session import freeze, fresh_folder
from ..sinks.layers import increment, read_graph, write_graph
from ..sinks.parts import merge_into_parts, read_parts
from ..sinks.tables import create_swapped, drop_old_stages, insert_overwrite
from . import fixtures as fx
from .catalog import ORACLE, register
from .graph import by_label
from .q_load import graph
from .q_query import _BOTH_CALL, NEQ_NAME

#: a low bound, so that the tables of a test have hubs
_HUB = 40


def _records(spark, sf_dir) -> DataFrame:
    g, path = graph(spark, sf_dir), fresh_folder(spark, "records")
    write_records(build_records(g.wide_vertices(), g.edges, _HUB), path)
    return read_records(spark, path)


@register("record_in_edges", """
select e.label, e.start_id, e.end_id, e.mgm from edges e join ends on ends.label = e.label join vwide v on v.id = e.end_id and v.label = dst
""")
def q_record_in_edges(spark, sf_dir):
    """Every edge, from the in side of the stored records."""
    return edges_of(_records(spark, sf_dir), "in_edges")


@register("record_vertices", "select id, label, name, status, is_white from vwide")
def q_record_vertices(spark, sf_dir):
    return vertices_of(_records(spark, sf_dir)).select("id", "label", "name", "status", "is_white")


@register("record_neighbours_filtered", """
select b.start_id, b.nbr_id, v.name as nbr_name from both_call b join vwide v on v.id = b.nbr_id
where b.start_id in (select id from service) and (v.is_register = 'true' or v.is_risk = 'true')
""", extra_ctes=_BOTH_CALL)
def q_record_neighbours_filtered(spark, sf_dir):
    """N1 from records: no join with the edges."""
    records = _records(spark, sf_dir)
    names = vertices_of(records).where((F.col("label") == MOBILE) & has_eq("is_service", "true")).select("name")
    return record_neighbours(records, names, "CALL", or_(has_eq("is_register", "true"), has_eq("is_risk", "true")), MOBILE)


@register("record_count_other_v", f"""
select start_id, count(*) as cnt from edges join vwide on id = end_id and name <> '{NEQ_NAME}'
where edges.label = 'CALL' group by start_id
""")
def q_record_count_other_v(spark, sf_dir):
    """N2 from records, over all vertices."""
    records = _records(spark, sf_dir)
    return record_count_other_v(records, vertices_of(records), "CALL", NEQ_NAME, per_start=True)


# --------------------------------------------------------------------------- refold
@register("refolded_lines", "select id, label, line from adj_lines")
def q_refolded_lines(spark, sf_dir):
    """The lines of a graph that lacks statuses and edges, brought up to date after the increment that adds them."""
    g, base = graph(spark, sf_dir), fresh_folder(spark, "refold")
    vertices, edges = freeze(g.wide_vertices(), "vertices"), freeze(g.edges.sortWithinPartitions("start_id"), "edges", packed=True)
    late_v, late_e = (F.col("label") == MOBILE) & (F.col("id") % 9 == 0), F.col("start_id") % 7 == 3
    write_graph(spark, base, vertices.withColumn("status", F.when(~late_v, F.col("status"))), edges.where(~late_e), part_ids=500,
                stored=True)
    before = read_graph(spark, base)
    lines = freeze(encode_adjacency(build_adjacency(vertex_records(by_label(before.vertices)), before.edges, edges_stored=True,
                                                    in_edges=before.edges_in, n_edges=before.most("edges"))), "lines", packed=True)
    names = vertices.select("id", "name")
    e_delta = (edges.where(late_e).join(names.toDF("start_id", "start_name"), "start_id").join(names.toDF("end_id", "end_name"), "end_id")
               .select("start_name", "label", "end_name", "mgm", F.coalesce("mgm", F.lit(-1)).alias("ord")))
    increment(spark, base, vertices.where(late_v).select("label", "name", "status", F.col("id").alias("ord")), e_delta)
    now = read_graph(spark, base)
    return refold(lines, now, freeze(touched_ids(now, before), "touched"), encode_adjacency)


# a layered graph holds an edge once
ORACLE["refolded_lines"] = ORACLE["refolded_lines"].replace(
    "from edges join ends on ends.label = edges.label",
    "from (select label, start_id, end_id, max(mgm) as mgm from edges group by all) edges join ends on ends.label = edges.label")


# --------------------------------------------------------------------------- counts
def _counted(spark, keys, batches, empty) -> DataFrame:
    """Counts of several batches, each added to the parts it touches."""
    folder, parts = fresh_folder(spark, "counts"), {}
    for k, rows in enumerate(batches):
        change = merge_into_parts(spark, parts, keys, freeze(rows, "counted"), empty, add_counts, f"{folder}/{k}", part_rows=500)
        parts = {p: f for p, f in parts.items() if p not in change["drop"]} | change["parts"]
    return read_parts(spark, parts)


def _staged_names(spark, sf_dir):
    staged = fx.staged_vertices(spark, sf_dir)
    return [name_counts(v.select(F.lit(label).alias("label"), "name")) for label, v in staged.items()]


_NAMES = """
staged AS (select 'MOBILE' as label, name from mobile union all select 'DEVICE', name from device union all select 'WIFI', name from wifi_raw)
"""


@register("counted_conflicts", "select name, count(distinct label) as n_labels from staged group by name having count(distinct label) > 1",
          extra_ctes=_NAMES)
def q_counted_conflicts(spark, sf_dir):
    """A2 from counts that three appends built up."""
    return counted_conflicts(_counted(spark, NAME_KEYS, _staged_names(spark, sf_dir), NAME_COUNTS))


_PER_NAME = """
per AS (select label, name, count(*) as n from staged group by all union all select 'ALL', name, count(*) from staged group by name)
"""


@register("counted_uniqueness", """
select label, sum(n)::bigint as n_rows, count(name) as n_distinct_names, count(name) filter (where n > 1) as n_repeated_names,
  coalesce(sum(n) filter (where name is null), 0)::bigint as n_null_names from per group by label
""", extra_ctes=_NAMES.rstrip() + "," + _PER_NAME)
def q_counted_uniqueness(spark, sf_dir):
    """Q2 from counts."""
    return counted_uniqueness(_counted(spark, NAME_KEYS, _staged_names(spark, sf_dir), NAME_COUNTS))


@register("counted_duplicates", """
select label, start_id, end_id, count(*) as copies from edges where label in ('CALL', 'USE') group by all having count(*) > 1
""")
def q_counted_duplicates(spark, sf_dir):
    """A6 from counts: all edges added, those of two labels taken away again."""
    e = freeze(graph(spark, sf_dir).edges, "edges")  # counted twice
    gone = edge_counts(e.where(F.col("label").isin("HAS", "USE_WIFI")), sign=-1)
    return counted_duplicates(_counted(spark, EDGE_KEYS, [edge_counts(e), gone], EDGE_COUNTS))


# --------------------------------------------------------------------------- joins and tables
@register("resolve_split", "select start_id, end_id, mgm from edges where label = 'CALL'")
def q_resolve_split(spark, sf_dir):
    """J2 with the edges of heavy names dealt out."""
    g = graph(spark, sf_dir)
    start, end = EDGE_ENDPOINTS["CALL"]
    return resolve_edges_split(fx.call(spark, sf_dir), g.vertices[start], g.vertices[end], share=0.002, salts=7)


@register("swapped_table", "select name, merchant_name, status + 1 as status from mobile where status is not null")
def q_swapped_table(spark, sf_dir):
    """K3 on a swapped table that reads itself, twice, the old tables dropped."""
    name = f"swapped_{uuid.uuid4().hex}"
    create_swapped(fx.mobile(spark, sf_dir).select("name", "merchant_name", "status"), name)
    insert_overwrite(spark.table(name).where("status is not null"), name)
    drop_old_stages(spark, name)
    insert_overwrite(spark.table(name).select("name", "merchant_name", F.col("status") + 1), name)
    return spark.table(name)
