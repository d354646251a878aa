"""Registered queries of the append / upsert path."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ids import assign_dense_ids, attach_ids, union_names
from ..operators.increment import increment_edges, increment_vertices, vertex_rejects
from ..operators.merge import (append_edges, append_vertices, dangling_edges, edge_between, merge_edges,
                               merge_vertex_attrs, merge_vertices, status_changes, vertex_exists)
from ..operators.quality import conflicts_by_name, duplicate_edges, duplicate_names, remove_conflicting
from ..operators.resolve import resolve_any_label
from ..operators.stage import union_staged
from ..operators.traverse import count_other_v
from ..schema import DEVICE_COLUMNS, MOBILE, MOBILE_COLUMNS, VERTEX_LABELS, WIFI
from ..session import freeze, fresh_folder
from ..sinks.tables import read_snapshot
from ..sinks.text import export_vertices
from ..sinks.versions import publish_snapshot
from ..sources.text import ingest_labelled_edges, ingest_vertices
from . import fixtures as fx
from .catalog import register
from .q_load import edge_lines, graph, vertex_lines
from .q_query import NEQ_NAME


def _unpivot_sql(table: str, label: str, props, derived=None) -> str:
    derived = derived or {}
    parts = []
    for p in props:
        expr = derived.get(p, p)
        parts.append(f"select '{label}' as label, name, '{p}' as key, cast({expr} as varchar) as value "
                     f"from {table} where {expr} is not null")
    return "\nunion all ".join(parts)


@register("append_vertices", "\nunion all ".join([
    _unpivot_sql("mobile", "MOBILE", MOBILE_COLUMNS, {"nm_pass": "name", "nm_sha1": "sha1(name)"}),
    _unpivot_sql("device", "DEVICE", DEVICE_COLUMNS),
    _unpivot_sql("wifi_raw", "WIFI", DEVICE_COLUMNS),
]))
def q_append_vertices(spark, sf_dir):
    v = ingest_vertices(vertex_lines(spark, sf_dir))
    state = v.where(F.col("label") != MOBILE).select("label", "attrs")
    delta = v.where(F.col("label") == MOBILE)
    out = append_vertices(state, delta)
    return out.select("label", F.col("attrs")["name"].alias("name"), F.explode("attrs").alias("key", "value"))


@register("append_edges", """
select * from edges where label = 'HAS'
union all
select n.label, a.id, b.id, n.mgm from named n join vwide a on a.name = start_name join vwide b on b.name = end_name
where n.label <> 'HAS'
""")
def q_append_edges(spark, sf_dir):
    g = graph(spark, sf_dir)
    state = g.edges.where(F.col("label") == "HAS")
    lines = edge_lines(spark, sf_dir)
    delta_lines = lines["CALL"].union(lines["USE"]).union(lines["USE_WIFI"])
    delta = resolve_any_label(ingest_labelled_edges(delta_lines), g.vertices)
    return append_edges(state, delta)


# Upsert fixtures (FIXTURES.md): every row of customer, part and supplier (of orders) is in the state, the
# delta or both; delta keys repeat, all three labels occur, and orders that end at an unknown name stay in.
_VERTEX_CTES = """
urow AS (
  select 'MOBILE' as label, name, k, merchant_name, status from mobile
  union all select 'DEVICE', name, k, coalesce(is_exception, 'plain'), (k % 4)::int from device
  union all select 'WIFI', name, k, is_exception, null from wifi_raw
),
ustate AS (select label, name, merchant_name, status from urow where k % 3 <> 0),
udelta AS (
  select label, name, if(k % 4 = 0, merchant_name || '2', null) as merchant_name, k % 7 - 1 as status, 2 * k as ord
  from urow where k % 3 = 0 or k % 2 = 0
  union all
  select label, name, if(k % 2 = 0, coalesce(merchant_name, 'x') || '3', null), k % 6 - 2, 2 * k + 1
  from urow where (k % 3 = 0 or k % 2 = 0) and k % 5 = 0
),
ulast AS (
  select label, name, arg_max(merchant_name, ord) filter (where merchant_name is not null) as merchant_name,
    (max(status) filter (where status > 0))::int as status
  from udelta group by label, name
),
merged AS (
  select label, name, coalesce(d.merchant_name, s.merchant_name) as merchant_name, greatest(s.status, d.status) as status
  from ustate s full join ulast d using (label, name)
)
"""


def _as_text(delta):
    """A delta (label, name, merchant_name, status, ord) as exported vertex text, ``ord`` in the gid."""
    return reduce(DataFrame.unionByName, [
        export_vertices(delta.where(F.col("label") == label), label, key_col="ord", cols=["name", "merchant_name", "status"])
        for label in VERTEX_LABELS]).withColumnRenamed("line", "value")


def _merge_inputs(spark, sf_dir):
    rows = fx.upsert_rows(spark, sf_dir)
    # the delta arrives as exported vertex text and goes through the reader
    v = ingest_vertices(_as_text(fx.upsert_delta(rows)))
    delta = v.select("label", F.col("attrs")["name"].alias("name"), F.col("attrs")["merchant_name"].alias("merchant_name"),
                     F.col("attrs")["status"].cast("int").alias("status"),
                     F.substring_index("gid", ".", -1).cast("bigint").alias("ord"))
    return fx.upsert_state(rows), delta


@register("merge_vertices", "select * from merged", extra_ctes=_VERTEX_CTES)
def q_merge_vertices(spark, sf_dir):
    state, delta = _merge_inputs(spark, sf_dir)
    return merge_vertices(state, delta)


@register("merge_vertex_attrs", """
select label, name, unnest([{'key': 'name', 'value': name}, {'key': 'merchant_name', 'value': merchant_name},
  {'key': 'status', 'value': status::varchar}], recursive := true) from merged
union all
select label, name, unnest([{'key': 'nm_pass', 'value': name}, {'key': 'nm_sha1', 'value': sha1(name)}], recursive := true)
from merged where label = 'MOBILE'
""", extra_ctes=_VERTEX_CTES)
def q_merge_vertex_attrs(spark, sf_dir):
    state, delta = _merge_inputs(spark, sf_dir)
    attrs = F.create_map(F.lit("name"), F.col("name"), F.lit("merchant_name"), F.col("merchant_name"),
                         F.lit("status"), F.col("status").cast("string"))
    attrs = F.map_filter(attrs, lambda k, v: v.isNotNull()).alias("attrs")
    out = merge_vertex_attrs(state.select("label", "name", attrs), delta.select("label", "name", attrs, "ord"))
    # absent properties as nulls, as the oracle has them
    keys = F.array(*[F.lit(k) for k in ("name", "merchant_name", "status")])
    digest = F.when(F.col("label") == MOBILE, F.array(F.lit("nm_pass"), F.lit("nm_sha1"))).otherwise(F.array())
    return out.select("label", "name", "attrs", F.explode(F.concat(keys, digest)).alias("key")).select(
        "label", "name", "key", F.col("attrs")[F.col("key")].alias("value"))


@register("merge_status", """
select label, name, s.status as old_status, d.status as delta_status, d.status as status
from ulast d left join ustate s using (label, name) where d.status > coalesce(s.status, 0)
""", extra_ctes=_VERTEX_CTES)
def q_merge_status(spark, sf_dir):
    state, delta = _merge_inputs(spark, sf_dir)
    return status_changes(state, delta)


_EDGE_CTES = """
ckey AS (
  select c_name as start_name, 'CALL' as label, if(o_orderkey % 97 = 0, 'missing', concat('Customer#', lpad(
      ((o_custkey * 31 + o_orderkey % 3) % (select count(*) from customer) + 1)::varchar, 9, '0'))) as end_name,
    case o_orderstatus when 'F' then 1 when 'P' then 0 end as mgm, o_orderkey as ord
  from orders join customer on c_custkey = o_custkey
),
cknown AS (select * from ckey where end_name in (select c_name from customer)),
efold AS (
  select start_name, label, end_name,
    arg_max(mgm, ord) filter (where mgm is not null and ord % 3 <> 0) as stored,
    arg_max(mgm, ord) filter (where mgm is not null and (ord % 3 = 0 or ord % 4 = 0)) as came,
    bool_or(ord % 3 <> 0) as in_state, bool_or(ord % 3 = 0 or ord % 4 = 0) as in_delta
  from cknown group by all
)
"""


def _edge_merge_inputs(spark, sf_dir):
    """(state, delta, vertices): the stored edges are those whose ends exist, as an earlier import left them."""
    k, vertices = fx.call_keyed(spark, sf_dir), fx.mobile(spark, sf_dir).select("name")
    state = vertex_exists(k.where(F.col("ord") % 3 != 0), vertices, "end_name")
    return state, k.where((F.col("ord") % 3 == 0) | (F.col("ord") % 4 == 0)), vertices


@register("merge_edges", "select start_name, label, end_name, coalesce(came, stored) as mgm from efold", extra_ctes=_EDGE_CTES)
def q_merge_edges(spark, sf_dir):
    state, delta, vertices = _edge_merge_inputs(spark, sf_dir)
    return merge_edges(state, delta, vertices)


@register("merge_edges_dangling", "select start_name, label, end_name, 'end' as missing from ckey "
                                  "where end_name not in (select c_name from customer)", extra_ctes=_EDGE_CTES)
def q_merge_edges_dangling(spark, sf_dir):
    return dangling_edges(fx.call_keyed(spark, sf_dir), fx.mobile(spark, sf_dir).select("name"))


@register("edge_between", "select start_name, label, end_name from efold where in_state and in_delta", extra_ctes=_EDGE_CTES)
def q_edge_between(spark, sf_dir):
    state, delta, _ = _edge_merge_inputs(spark, sf_dir)
    return edge_between(delta.select("start_name", "label", "end_name").distinct(), state)


# --------------------------------------------------------------------------- increments of a loaded graph
_INCREMENT_CTES = _VERTEX_CTES + ",\n" + _EDGE_CTES.strip() + """,
iold AS (
  select dense_rank() over (order by name) as id, label, name, merchant_name, status from ustate
  where label <> 'WIFI' or name not in (select name from ustate group by name having count(distinct label) > 1)
),
ibad AS (
  select label, name, case when exists (select 1 from iold o where o.name = k.name and o.label <> k.label)
    then 'name of another label' else 'several labels' end as error
  from (select distinct label, name from udelta) k
  where exists (select 1 from iold o where o.name = k.name and o.label <> k.label)
     or (name not in (select name from iold) and name in (select name from udelta group by name having count(distinct label) > 1))
),
igood AS (select * from ulast where (label, name) not in (select (label, name) from ibad)),
inew AS (
  select (select max(id) from iold) + row_number() over (order by name) as id, name
  from (select distinct name from igood where name not in (select name from iold))
),
inext AS (
  select coalesce(o.id, n.id) as id, label, name, coalesce(d.merchant_name, o.merchant_name) as merchant_name,
    greatest(o.status, d.status) as status
  from iold o full join igood d using (label, name) left join inew n using (name)
),
iold_edge AS (
  select e.label, a.id as start_id, b.id as end_id, max(mgm) as mgm
  from (select start_name, label, end_name, mgm from ckey where ord % 3 <> 0) e
  join iold a on a.name = start_name join iold b on b.name = end_name group by all
),
inew_edge AS (
  select e.label, a.id as start_id, b.id as end_id, arg_max(mgm, ord) filter (where mgm is not null) as mgm
  from ckey e join inext a on a.name = start_name join inext b on b.name = end_name
  where ord % 3 = 0 or ord % 4 = 0 group by all
),
inext_edge AS (
  select label, start_id, end_id, coalesce(d.mgm, s.mgm) as mgm
  from iold_edge s full join inew_edge d using (label, start_id, end_id)
)
"""


def _loaded(spark, sf_dir):
    """A loaded graph of the stored rows: vertices (id, label, name, merchant_name, status) and CALL edges."""
    rows = fx.upsert_state(fx.upsert_rows(spark, sf_dir))
    by_label = {label: rows.where(F.col("label") == label).drop("label") for label in VERTEX_LABELS}
    by_label[WIFI] = remove_conflicting(by_label[WIFI], conflicts_by_name(by_label))
    clean = union_staged(by_label)
    vertices = freeze(attach_ids(clean, assign_dense_ids(union_names(clean))), "stored-vertices")
    calls = fx.call_keyed(spark, sf_dir).where(F.col("ord") % 3 != 0)
    edges = resolve_any_label(calls, {"any": vertices})
    return vertices, edges


def _increment(spark, sf_dir):
    vertices, edges = _loaded(spark, sf_dir)
    delta = freeze(_merge_inputs(spark, sf_dir)[1], "vertex-delta")  # parsed once
    new = freeze(increment_vertices(vertices, delta), "next-vertices")
    calls = fx.call_keyed(spark, sf_dir).where((F.col("ord") % 3 == 0) | (F.col("ord") % 4 == 0))
    return vertices, delta, new, calls, increment_edges(edges, new, calls)


@register("increment_vertices", "select id, label, name, merchant_name, status from inext", extra_ctes=_INCREMENT_CTES)
def q_increment_vertices(spark, sf_dir):
    return _increment(spark, sf_dir)[2]


@register("increment_edges", "select * from inext_edge", extra_ctes=_INCREMENT_CTES)
def q_increment_edges(spark, sf_dir):
    return _increment(spark, sf_dir)[4]


@register("increment_dropped", """
select label, name as start_name, null::varchar as end_name, error from ibad
union all
select label, start_name, end_name, concat('missing: ', case when start_name in (select name from inext) then 'end'
  when end_name in (select name from inext) then 'start' else 'both' end)
from ckey where (ord % 3 = 0 or ord % 4 = 0)
  and (start_name not in (select name from inext) or end_name not in (select name from inext))
""", extra_ctes=_INCREMENT_CTES)
def q_increment_dropped(spark, sf_dir):
    vertices, delta, new, calls, _ = _increment(spark, sf_dir)
    bad = vertex_rejects(vertices, delta).select("label", F.col("name").alias("start_name"),
                                                 F.lit(None).cast("string").alias("end_name"), "error")
    lost = dangling_edges(calls, new).select("label", "start_name", "end_name", F.concat(F.lit("missing: "), "missing").alias("error"))
    return bad.unionByName(lost)


@register("increment_count_other_v", f"""
select start_id, count(*) as cnt from inext_edge join inext on id = end_id and name <> '{NEQ_NAME}' group by start_id
""", extra_ctes=_INCREMENT_CTES)
def q_increment_count_other_v(spark, sf_dir):
    """N2 over a snapshot that was published after the increment."""
    _, _, new, _, edges = _increment(spark, sf_dir)
    path = publish_snapshot(spark, fresh_folder(spark, "graph"), new, edges)
    v, e = read_snapshot(spark, path)
    return count_other_v(v, e, v.select("id"), "CALL", NEQ_NAME, per_start=True)


@register("append_duplicate_names", """
select label, name, count(*) as copies from (select label, name from ustate union all select label, name from udelta)
group by all having count(*) > 1
""", extra_ctes=_VERTEX_CTES)
def q_append_duplicate_names(spark, sf_dir):
    rows = fx.upsert_rows(spark, sf_dir)
    attrs = F.create_map(F.lit("name"), F.col("name")).alias("attrs")
    delta = ingest_vertices(_as_text(fx.upsert_delta(rows)))
    return duplicate_names(append_vertices(fx.upsert_state(rows).select("label", attrs), delta))


@register("append_duplicate_edges", """
select label, start_id, end_id, count(*) as copies from (
  select c.label, a.id as start_id, b.id as end_id from ckey c
  join vwide a on a.name = start_name join vwide b on b.name = end_name, range(if(ord % 3 <> 0 and ord % 4 = 0, 2, 1)))
group by all having count(*) > 1
""", extra_ctes=_EDGE_CTES)
def q_append_duplicate_edges(spark, sf_dir):
    g = graph(spark, sf_dir)
    calls = fx.call_keyed(spark, sf_dir)
    state = resolve_any_label(calls.where(F.col("ord") % 3 != 0), g.vertices)
    delta = resolve_any_label(calls.where((F.col("ord") % 3 == 0) | (F.col("ord") % 4 == 0)), g.vertices)
    return duplicate_edges(append_edges(state, delta))


@register("vertex_exists", "select distinct end_name as name from call_e where end_name in (select name from vwide)")
def q_vertex_exists(spark, sf_dir):
    g = graph(spark, sf_dir)
    names = fx.call(spark, sf_dir).select(F.col("end_name").alias("name")).distinct()
    return vertex_exists(names, g.wide_vertices())
