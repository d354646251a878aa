"""Neighbourhood queries on the golden graph."""


from edgeloom.functions.predicates import has_eq, has_neq, or_
from edgeloom.functions.projections import list_map_text, map_text, value_map, value_map_unfolded
from edgeloom.operators.traverse import (both, count_other_v, hub, match_pattern, neighbours_filtered, other_v,
                                         out_e, pairs_report, start_by_names)
from edgeloom.plans.graph import wide_vertices

from test_golden import golden_graph


def _g(spark):
    vertices, edges = golden_graph(spark)
    return wide_vertices(vertices), edges


def test_both_bag_semantics(spark):
    v, e = _g(spark)
    got = sorted(tuple(r) for r in both(e, [1, 2], "CALL").collect())
    assert got == [(1, 2), (1, 2), (2, 1), (2, 1)]
    loop = e.union(spark.createDataFrame([("CALL", 3, 3, None)], e.schema))
    assert sorted(tuple(r) for r in both(loop, [3], "CALL").collect()) == [(3, 3), (3, 3)]


def test_out_e_other_v_and_match(spark):
    v, e = _g(spark)
    got = sorted((r.end_id, r.other_name) for r in other_v(out_e(e, [40], "HAS"), v).collect())
    assert got == [(1, "anna"), (2, "bert"), (3, "cleo")]
    m = {(r.a_name, r.b_name, r.mgm) for r in match_pattern(v, e, "MOBILE", "CALL", "MOBILE").collect()}
    assert m == {("anna", "bert", 6), ("bert", "anna", None)}


def test_count_other_v_and_hub(spark):
    v, e = _g(spark)
    assert count_other_v(v, e, [40], "HAS", "bert").collect()[0].cnt == 2
    per = {r.start_id: r.cnt for r in count_other_v(v, e, v.select("id"), "USE_WIFI", "x", per_start=True).collect()}
    assert per == {1: 1, 2: 1, 3: 1}
    h = hub(e, "HAS").collect()[0]
    assert (h.id, h.degree) == (40, 3)


def test_neighbours_filtered_and_pairs(spark):
    v, e = _g(spark)
    names = ["anna"]
    pred = or_(has_eq("status", 2), has_eq("is_risk", "true"))
    got = sorted((r.start_id, r.nbr_id) for r in neighbours_filtered(v, e, names, "CALL", pred, "MOBILE").collect())
    assert got == [(1, 2), (1, 2)]
    cols = {"c_name": "m1.name", "mobile": "m2.name", "is_risk": "m2.is_risk", "status": "m2.status"}
    rows = {tuple(r) for r in pairs_report(v, e, names, "CALL", cols, "MOBILE").collect()}
    assert rows == {("anna", "bert", "null", "2")}
    cols = {"service": "m2.is_service"}
    assert {tuple(r) for r in pairs_report(v, e, names, "CALL", cols, "MOBILE").collect()} == {("",)}  # empty is not "null"


def test_value_maps(spark):
    v, _ = _g(spark)
    one = v.where("id = 2")
    vm = one.select(list_map_text(value_map(["name", "status", "suspect_risk", "overdue_status"])).alias("t")).first().t
    assert vm == "name=[bert],overdue_status=[0],status=[2]"
    vu = one.select(map_text(value_map_unfolded(["name", "suspect_risk", "status"])).alias("t")).first().t
    assert vu == "name=bert,status=2"


def test_has_neq_drops_missing(spark):
    v, _ = _g(spark)
    got = sorted(r.id for r in v.where(has_neq("overdue_status", 1)).collect())
    assert got == [2]
    assert start_by_names(v, ["cafe"], "WIFI").count() == 1
