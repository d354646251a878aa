"""Registered queries of the traversal and report path."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.predicates import has_eq, has_label, has_neq, has_within, or_
from ..functions.projections import list_map_text, map_text, select_as, value_map, value_map_unfolded
from ..operators.quality import degree_report
from ..operators.traverse import (both, both_from, count_other_v, hub, match_pattern, neighbours_filtered, other_v, out_e,
                                  pairs_report, start_by_names)
from ..schema import MOBILE
from ..sources.tables import base_table
from .catalog import register
from .q_load import graph

NEQ_NAME = "Customer#000000001"


def _snapshot(spark, sf_dir):
    g = graph(spark, sf_dir)
    return g.wide_vertices(), g.edges


def _service_names(v):
    """Start set for the P.within queries: names of service mobiles."""
    return v.where((F.col("label") == MOBILE) & has_eq("is_service", "true")).select("name")


def _risky(v):
    return v.where((F.col("label") == MOBILE) & has_eq("is_risk", "true")).select("id")


# --------------------------------------------------------------------------- property filters
@register("has_eq", "select id, name from vwide where is_service = 'true'")
def q_has_eq(spark, sf_dir):
    v, _ = _snapshot(spark, sf_dir)
    return v.where(has_eq("is_service", "true")).select("id", "name")


@register("has_within", "select id, name, merchant_name from vwide where merchant_name in ('AUTOMOBILE', 'BUILDING')")
def q_has_within(spark, sf_dir):
    v, _ = _snapshot(spark, sf_dir)
    return v.where(has_within("merchant_name", ["AUTOMOBILE", "BUILDING"])).select("id", "name", "merchant_name")


@register("has_neq", "select id, name, status from vwide where status <> 1")
def q_has_neq(spark, sf_dir):
    v, _ = _snapshot(spark, sf_dir)
    return v.where(has_neq("status", 1)).select("id", "name", "status")


@register("or_filter", "select id, name, is_register, is_risk from vwide where is_register = 'true' or is_risk = 'true'")
def q_or_filter(spark, sf_dir):
    v, _ = _snapshot(spark, sf_dir)
    return v.where(or_(has_eq("is_register", "true"), has_eq("is_risk", "true"))).select(
        "id", "name", "is_register", "is_risk")


@register("has_label", "select id, name from vwide where label = 'WIFI'")
def q_has_label(spark, sf_dir):
    v, _ = _snapshot(spark, sf_dir)
    return v.where(has_label("WIFI")).select("id", "name")


# --------------------------------------------------------------------------- expansion
_BOTH_CALL = """
both_call AS (select start_id, end_id as nbr_id from edges where label = 'CALL'
              union all select end_id, start_id from edges where label = 'CALL'),
risky AS (select id from vwide where label = 'MOBILE' and is_risk = 'true'),
service AS (select id, name from vwide where label = 'MOBILE' and is_service = 'true')
"""


@register("both_neighbours", "select start_id, nbr_id from both_call where start_id in (select id from risky)",
          extra_ctes=_BOTH_CALL)
def q_both_neighbours(spark, sf_dir):
    v, e = _snapshot(spark, sf_dir)
    return both(e, _risky(v), "CALL")


@register("out_edges_other_v", """
select e.start_id, e.end_id, v.name as other_name from edges e join vwide v on v.id = e.end_id
where e.label = 'USE' and e.start_id in (select id from risky)
""", extra_ctes=_BOTH_CALL)
def q_out_edges_other_v(spark, sf_dir):
    v, e = _snapshot(spark, sf_dir)
    return other_v(out_e(e, _risky(v), "USE"), v).select("start_id", "end_id", "other_name")


@register("match_call", """
select a.name as a_name, b.name as b_name, e.mgm from edges e
join vwide a on a.id = e.start_id and a.label = 'MOBILE' join vwide b on b.id = e.end_id and b.label = 'MOBILE'
where e.label = 'CALL'
""")
def q_match_call(spark, sf_dir):
    v, e = _snapshot(spark, sf_dir)
    return match_pattern(v, e, MOBILE, "CALL", MOBILE).select("a_name", "b_name", "mgm")


@register("neighbours_filtered", """
select b.start_id, b.nbr_id, v.name as nbr_name from both_call b join vwide v on v.id = b.nbr_id
where b.start_id in (select id from service) and (v.is_register = 'true' or v.is_risk = 'true')
""", extra_ctes=_BOTH_CALL)
def q_neighbours_filtered(spark, sf_dir):
    v, e = _snapshot(spark, sf_dir)
    pred = or_(has_eq("is_register", "true"), has_eq("is_risk", "true"))
    return neighbours_filtered(v, e, _service_names(v), "CALL", pred, start_label=MOBILE)


@register("count_other_v", f"""
select count(*) as cnt from edges e
join (select start_id as id, count(*) as degree from edges where label = 'CALL'
      group by start_id order by degree desc, id limit 1) h on e.start_id = h.id
join vwide v on v.id = e.end_id
where e.label = 'CALL' and v.name <> '{NEQ_NAME}'
""")
def q_count_other_v(spark, sf_dir):
    v, e = _snapshot(spark, sf_dir)
    return count_other_v(v, e, hub(e, "CALL").select("id"), "CALL", NEQ_NAME)


@register("count_other_v_all", f"""
select e.start_id, count(*) as cnt from edges e join vwide v on v.id = e.end_id
where e.label = 'CALL' and v.name <> '{NEQ_NAME}' group by e.start_id
""")
def q_count_other_v_all(spark, sf_dir):
    v, e = _snapshot(spark, sf_dir)
    start = v.where(F.col("label") == MOBILE).select("id")
    return count_other_v(v, e, start, "CALL", NEQ_NAME, per_start=True)


def region_orders(spark, sf_dir):
    """Hubs the size of the reference profile: a region and its orders, through nation and customer.

    Vertices (id, label, name): orders and regions (ids below 0); edges (PLACED) from region to order.
    """
    o, c = base_table(spark, sf_dir, "orders"), base_table(spark, sf_dir, "customer")
    n, r = base_table(spark, sf_dir, "nation"), base_table(spark, sf_dir, "region")
    region = (-1 - F.col("r_regionkey")).cast("bigint")
    vertices = o.select(F.col("o_orderkey").alias("id"), F.lit("ORDER").alias("label"), F.col("o_orderpriority").alias("name"))
    vertices = vertices.unionByName(r.select(region.alias("id"), F.lit("REGION").alias("label"), F.col("r_name").alias("name")))
    edges = (o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
             .select(F.lit("PLACED").alias("label"), (-1 - F.col("n_regionkey")).cast("bigint").alias("start_id"),
                     F.col("o_orderkey").alias("end_id"), F.lit(None).cast("int").alias("mgm")))
    return vertices, edges


@register("count_other_v_region", """
select -1 - n_regionkey::bigint as start_id, count(*) as cnt
from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey
where o_orderpriority <> '1-URGENT' group by n_regionkey
""")
def q_count_other_v_region(spark, sf_dir):
    v, e = region_orders(spark, sf_dir)
    start = v.where(F.col("label") == "REGION").select("id")
    return count_other_v(v, e, start, "PLACED", "1-URGENT", per_start=True)


@register("pairs_report", """
select coalesce(m1.name, 'null') as c_name, coalesce(m2.name, 'null') as mobile,
  coalesce(m2.is_risk, 'null') as is_risk, coalesce(m2.is_service, 'null') as is_service
from both_call b join vwide m1 on m1.id = b.start_id join vwide m2 on m2.id = b.nbr_id
where b.start_id in (select id from service)
""", extra_ctes=_BOTH_CALL)
def q_pairs_report(spark, sf_dir):
    v, e = _snapshot(spark, sf_dir)
    cols = {"c_name": "m1.name", "mobile": "m2.name", "is_risk": "m2.is_risk", "is_service": "m2.is_service"}
    return pairs_report(v, e, _service_names(v), "CALL", cols, start_label=MOBILE)


def _m2_sql(fmt):
    keys = ["is_risk", "is_service", "name", "overdue_status", "status"]
    parts = [f"case when m2.{k} is not null then '{k}=' || {fmt.format(f'cast(m2.{k} as varchar)')} end" for k in keys]
    return "concat_ws(',', " + ", ".join(parts) + ")"


def _pairs(v, e):
    start = start_by_names(v, _service_names(v), MOBILE).select(F.col("id").alias("start_id"), F.col("name").alias("m1_name"))
    m2 = v.select(F.col("id").alias("nbr_id"), *[F.col(c) for c in ("name", "is_risk", "status", "is_service",
                                                                      "overdue_status")])
    return both_from(e, start, "CALL").join(m2, "nbr_id")


@register("value_map", f"""
select 'name=[' || m1.name || ']' as m1, {_m2_sql("'[' || {} || ']'")} as m2
from both_call b join vwide m1 on m1.id = b.start_id join vwide m2 on m2.id = b.nbr_id
where b.start_id in (select id from service)
""", extra_ctes=_BOTH_CALL)
def q_value_map(spark, sf_dir):
    v, e = _snapshot(spark, sf_dir)
    j = _pairs(v, e)
    m1 = F.map_filter(F.create_map(F.lit("name"), F.when(F.col("m1_name").isNotNull(), F.array("m1_name"))),
                      lambda k, x: x.isNotNull())
    m2 = value_map(["name", "is_risk", "status", "is_service", "overdue_status"])
    return j.select(list_map_text(m1).alias("m1"), list_map_text(m2).alias("m2"))


@register("value_map_unfolded", f"""
select 'name=' || m1.name as m1, {_m2_sql("{}")} as m2
from both_call b join vwide m1 on m1.id = b.start_id join vwide m2 on m2.id = b.nbr_id
where b.start_id in (select id from service)
""", extra_ctes=_BOTH_CALL)
def q_value_map_unfolded(spark, sf_dir):
    v, e = _snapshot(spark, sf_dir)
    j = _pairs(v, e).withColumnRenamed("m1_name", "m1name")
    m1 = F.map_filter(F.create_map(F.lit("name"), F.col("m1name")), lambda k, x: x.isNotNull())
    m2 = value_map_unfolded(["name", "is_risk", "status", "is_service", "overdue_status"])
    return j.select(map_text(m1).alias("m1"), map_text(m2).alias("m2"))


@register("select_as", """
select m1.name as m1_name, m2.name as m2_name, m2.status as m2_status
from both_call b join vwide m1 on m1.id = b.start_id join vwide m2 on m2.id = b.nbr_id
where b.start_id in (select id from service)
""", extra_ctes=_BOTH_CALL)
def q_select_as(spark, sf_dir):
    v, e = _snapshot(spark, sf_dir)
    j = _pairs(v, e)
    steps = j.select(*select_as(m1=["m1_name"], m2=["name", "status"]))
    return steps.select(F.col("m1.m1_name").alias("m1_name"), F.col("m2.name").alias("m2_name"),
                        F.col("m2.status").alias("m2_status"))


@register("count_all", "select count(*) as n from edges")
def q_count_all(spark, sf_dir):
    _, e = _snapshot(spark, sf_dir)
    return e.agg(F.count(F.lit(1)).alias("n"))


@register("degree_report", """
select id, dir, label, count(*) as degree from (
  select start_id as id, 'out' as dir, label from edges union all select end_id, 'in', label from edges) h
group by id, dir, label having count(*) >= 50
""")
def q_degree_report(spark, sf_dir):
    _, e = _snapshot(spark, sf_dir)
    return degree_report(e, 50)
