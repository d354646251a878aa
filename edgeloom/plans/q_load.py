"""Registered queries of the load path: ingest, staging, quality, ids, resolve, adjacency."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.projections import bulk_header
from ..operators.adjacency import (build_adjacency, decode_edges, decode_vertices, encode_adjacency,
                                   vertex_records)
from ..operators.ids import number_rows, union_names
from ..operators.quality import (conflict_report, conflicting_names, count_edges_on, distinct_simple_edges,
                                 remove_conflicting, tagged_names, uniqueness_report)
from ..operators.stage import add_name_digest, stage_device, stage_mobile
from ..schema import (CALL, DEVICE, EDGE_LABELS, MOBILE, MOBILE_COLUMNS, MOBILE_EXPORT_COLUMNS, MOBILE_INT_COLUMNS,
                      WIDE_VERTEX_COLUMNS, WIFI)
from ..sinks.text import export_edges, export_vertices
from ..sources.text import ingest_call_edges, ingest_edges, ingest_labelled_edges, ingest_vertices
from . import fixtures as fx
from ..operators.resolve import unresolved_edges
from .catalog import register
from .graph import wide_vertices
from .pipeline import load_graph, stage_all

MOBILE_COLS_SQL = ", ".join(MOBILE_COLUMNS)
WIDE_SQL = ", ".join(("id", "label", *WIDE_VERTEX_COLUMNS))


def graph(spark: SparkSession, sf_dir: str):
    """The loaded fixture graph (ids assigned, edges resolved)."""
    return load_graph(fx.staged_vertices(spark, sf_dir), fx.staged_edges(spark, sf_dir), materialize=True)


def vertex_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exported vertex text of all three labels, as the source database writes it."""
    return reduce(DataFrame.union, [
        export_vertices(fx.mobile(spark, sf_dir, with_key=True), MOBILE),
        export_vertices(fx.device(spark, sf_dir), DEVICE),
        export_vertices(fx.wifi(spark, sf_dir), WIFI),
    ]).withColumnRenamed("line", "value")


def edge_lines(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Exported edge text, one DataFrame per label."""
    edges = fx.staged_edges(spark, sf_dir)
    return {label: export_edges(e, label).withColumnRenamed("line", "value") for label, e in edges.items()}


def _n_props_sql(cols) -> str:
    return "cast(" + " + ".join(f"(case when {c} is not null then 1 else 0 end)" for c in cols) + " as int)"


# --------------------------------------------------------------------------- raw text
@register("ingest_vertices", f"""
select 'MOBILE' as label, '11.' || cast(k as varchar) as gid, name,
  {_n_props_sql(MOBILE_EXPORT_COLUMNS)} as n_props from mobile
union all
select 'DEVICE', '10.' || cast(k as varchar), name, {_n_props_sql(['name', 'is_exception', 'is_white'])} from device
union all
select 'WIFI', '12.' || cast(k as varchar), name, {_n_props_sql(['name', 'is_exception', 'is_white'])} from wifi_raw
""")
def q_ingest_vertices(spark, sf_dir):
    v = ingest_vertices(vertex_lines(spark, sf_dir))
    return v.select("label", "gid", F.col("attrs")["name"].alias("name"), F.size("attrs").alias("n_props"))


@register("stage_mobile", f"select {MOBILE_COLS_SQL} from mobile")
def q_stage_mobile(spark, sf_dir):
    return stage_mobile(ingest_vertices(vertex_lines(spark, sf_dir)))


@register("stage_device", """
select 'DEVICE' as label, name, is_exception, is_white from device
union all select 'WIFI', name, is_exception, is_white from wifi_raw
""")
def q_stage_device(spark, sf_dir):
    v = ingest_vertices(vertex_lines(spark, sf_dir))
    return stage_device(v, DEVICE).select(F.lit(DEVICE).alias("label"), "*").unionByName(
        stage_device(v, WIFI).select(F.lit(WIFI).alias("label"), "*"))


@register("ingest_edges", """
select start_name, label, end_name from named where label <> 'CALL'
""")
def q_ingest_edges(spark, sf_dir):
    lines = edge_lines(spark, sf_dir)
    return reduce(DataFrame.union, [ingest_edges(lines[label]) for label in ("HAS", "USE", "USE_WIFI")])


@register("ingest_call_edges", "select start_name, end_name, mgm from call_e")
def q_ingest_call_edges(spark, sf_dir):
    return ingest_call_edges(edge_lines(spark, sf_dir)[CALL])


@register("ingest_labelled_edges", """
select start_name, label, end_name, mgm from named
""")
def q_ingest_labelled_edges(spark, sf_dir):
    lines = edge_lines(spark, sf_dir)
    return ingest_labelled_edges(reduce(DataFrame.union, [lines[label] for label in EDGE_LABELS]))


@register("name_digest", "select name, name as nm_pass, sha1(name) as nm_sha1 from mobile")
def q_name_digest(spark, sf_dir):
    return add_name_digest(fx.mobile(spark, sf_dir).select("name"))


# --------------------------------------------------------------------------- names, conflicts, ids
@register("union_names", "select distinct name from vwide")
def q_union_names(spark, sf_dir):
    sv = fx.staged_vertices(spark, sf_dir)
    conf = conflicting_names(tagged_names(sv))
    return union_names(sv[DEVICE], remove_conflicting(sv[WIFI], conf), sv[MOBILE])


@register("tagged_names", "select distinct name, lower(left(label, 1)) as type from vertex")
def q_tagged_names(spark, sf_dir):
    return tagged_names(fx.staged_vertices(spark, sf_dir))


@register("conflicting_names", "select name, labels as count from clash")
def q_conflicting_names(spark, sf_dir):
    return conflicting_names(tagged_names(fx.staged_vertices(spark, sf_dir)))


@register("conflict_edge_count", "select count(*) as cnt from named where label = 'USE_WIFI' and end_name in (select name from clash)")
def q_conflict_edge_count(spark, sf_dir):
    conf = conflicting_names(tagged_names(fx.staged_vertices(spark, sf_dir)))
    return count_edges_on(conf, fx.use_wifi(spark, sf_dir), "end_name")


@register("conflict_report", """
select name, labels as n_labels,
  (select string_agg(distinct lower(left(label, 1)), ',' order by lower(left(label, 1))) from vertex v where v.name = c.name) as labels,
  (select count(*) from named n where n.start_name = c.name) + (select count(*) from named n where n.end_name = c.name) as n_edge_ends
from clash c
""")
def q_conflict_report(spark, sf_dir):
    return conflict_report(fx.staged_vertices(spark, sf_dir), fx.staged_edges(spark, sf_dir))


@register("remove_conflicting", "select name, is_exception, is_white from vwide where label = 'WIFI'")
def q_remove_conflicting(spark, sf_dir):
    sv = fx.staged_vertices(spark, sf_dir)
    return remove_conflicting(sv[WIFI], conflicting_names(tagged_names(sv)))


@register("dense_ids", "select distinct id, name from vwide")
def q_dense_ids(spark, sf_dir):
    return graph(spark, sf_dir).ids


@register("number_rows_sample", """
select row_number() over (order by name) as rowid, name
from (select name from device order by name limit 100) t
""")
def q_number_rows_sample(spark, sf_dir):
    return number_rows(fx.device(spark, sf_dir), 100)


@register("attach_ids_mobile", f"select id, {MOBILE_COLS_SQL} from vwide where label = 'MOBILE'")
def q_attach_ids_mobile(spark, sf_dir):
    return graph(spark, sf_dir).vertices[MOBILE]


@register("attach_ids_device", "select id, name, is_exception, is_white from vwide where label = 'DEVICE'")
def q_attach_ids_device(spark, sf_dir):
    return graph(spark, sf_dir).vertices[DEVICE]


@register("attach_ids_wifi", "select id, name, is_exception, is_white from vwide where label = 'WIFI'")
def q_attach_ids_wifi(spark, sf_dir):
    return graph(spark, sf_dir).vertices[WIFI]


@register("resolve_call", "select start_id, end_id, mgm from edges where label = 'CALL'")
def q_resolve_call(spark, sf_dir):
    return graph(spark, sf_dir).resolved["CALL"]


@register("resolve_has", "select start_id, end_id from edges where label = 'HAS'")
def q_resolve_has(spark, sf_dir):
    return graph(spark, sf_dir).resolved["HAS"]


@register("resolve_use", "select start_id, end_id from edges where label = 'USE'")
def q_resolve_use(spark, sf_dir):
    return graph(spark, sf_dir).resolved["USE"]


@register("resolve_use_wifi", "select start_id, end_id from edges where label = 'USE_WIFI'")
def q_resolve_use_wifi(spark, sf_dir):
    return graph(spark, sf_dir).resolved["USE_WIFI"]


@register("unresolved_call", """
select start_name, end_name, case when start_name in (select name from mobile) then 'end' else 'start' end as missing
from call_e where start_name not in (select name from mobile) or end_name not in (select name from mobile)
""")
def q_unresolved_call(spark, sf_dir):
    g = graph(spark, sf_dir)
    return unresolved_edges(fx.call(spark, sf_dir), g.vertices[MOBILE], g.vertices[MOBILE])


@register("uniqueness_report", """
select coalesce(label, 'ALL') as label, count(*) as n_rows, count(distinct name) as n_distinct_names,
  (select count(*) from (select name from vertex v where t.label is null or v.label = t.label group by name
                         having count(*) > 1 and name is not null)) as n_repeated_names,
  count(*) - count(name) as n_null_names, 0::bigint as n_repeated_ids
from vertex t group by grouping sets ((label), ())
""")
def q_uniqueness_report(spark, sf_dir):
    return uniqueness_report(fx.staged_vertices(spark, sf_dir))


@register("distinct_simple_edges", "select label, start_id, end_id, count(*) as copies from edges "
                                   "group by label, start_id, end_id")
def q_distinct_simple_edges(spark, sf_dir):
    return distinct_simple_edges(graph(spark, sf_dir).edges)


# --------------------------------------------------------------------------- adjacency
def adjacency_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir)
    return encode_adjacency(build_adjacency(vertex_records(g.vertices), g.edges))


@register("adjacency_lines", "select id, label, line from adj_lines")
def q_adjacency_lines(spark, sf_dir):
    return adjacency_lines(spark, sf_dir)


@register("decode_vertices", f"select {WIDE_SQL} from vwide")
def q_decode_vertices(spark, sf_dir):
    return decode_vertices(adjacency_lines(spark, sf_dir).select(F.col("line").alias("value")))


@register("decode_edges", "select label, start_id, end_id, mgm from edges")
def q_decode_edges(spark, sf_dir):
    return decode_edges(adjacency_lines(spark, sf_dir).select(F.col("line").alias("value")))


# --------------------------------------------------------------------------- whole load from text
@register("stage_all_vertices", f"select {WIDE_SQL} from vwide")
def q_stage_all_vertices(spark, sf_dir):
    g = stage_all(vertex_lines(spark, sf_dir), edge_lines(spark, sf_dir))
    return wide_vertices(g.vertices)


@register("stage_all_edges", "select label, start_id, end_id, mgm from edges")
def q_stage_all_edges(spark, sf_dir):
    return stage_all(vertex_lines(spark, sf_dir), edge_lines(spark, sf_dir)).edges


# --------------------------------------------------------------------------- headers and export text
_MOBILE_TYPES = dict.fromkeys(MOBILE_INT_COLUMNS, "Int")


@register("bulk_header", "select " + ", ".join(
    f'{c} as "{c}:ID(MOBILE)"' if c == "name" else (f'{c} as "{c}:{_MOBILE_TYPES[c]}"' if c in _MOBILE_TYPES else c)
    for c in MOBILE_COLUMNS) + " from mobile")
def q_bulk_header(spark, sf_dir):
    return bulk_header(fx.mobile(spark, sf_dir), MOBILE, _MOBILE_TYPES)


def _json_sql(cols, ints=()) -> str:
    parts = []
    for c in cols:
        val = f"cast({c} as varchar)" if c in ints else f"to_json({c})"
        parts.append(f"""case when {c} is not null then '"{c}":' || {val} end""")
    return "'{' || concat_ws(',', " + ", ".join(parts) + ") || '}'"


@register("export_vertices", f"""
select 'mobile[11.' || cast(k as varchar) || ']' || {_json_sql(MOBILE_EXPORT_COLUMNS, ints=MOBILE_INT_COLUMNS)} as line from mobile
union all
select 'device[10.' || cast(k as varchar) || ']' || {_json_sql(['name', 'is_exception', 'is_white'])} from device
union all
select 'wifi[12.' || cast(k as varchar) || ']' || {_json_sql(['name', 'is_exception', 'is_white'])} from wifi_raw
""")
def q_export_vertices(spark, sf_dir):
    return vertex_lines(spark, sf_dir).withColumnRenamed("value", "line")


@register("export_edges", r"""
select '"' || start_name || '","CALL","' || end_name || '",' || coalesce(cast(mgm as varchar), '\N') as line
from call_e
union all select '"' || start_name || '","' || label || '","' || end_name || '"' from named where label <> 'CALL'
""")
def q_export_edges(spark, sf_dir):
    lines = edge_lines(spark, sf_dir)
    return reduce(DataFrame.union, [lines[label] for label in EDGE_LABELS]).withColumnRenamed("value", "line")
