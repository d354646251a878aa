"""Quality reports and strict decoding."""

import pytest

from edgeloom.functions.predicates import within_frame
from edgeloom.operators.adjacency import decode_vertices
from edgeloom.operators.quality import (conflict_report, conflicting_names, conflicts_by_name, count_edges_on,
                                        degree_report, duplicate_edges, duplicate_names, remove_conflicting, tagged_names,
                                        uniqueness_report)


def _vertices(spark):
    return {
        "DEVICE": spark.createDataFrame([("x",), ("d1",), ("d1",)], "name string"),
        "WIFI": spark.createDataFrame([("x",), ("w1",)], "name string"),
        "MOBILE": spark.createDataFrame([("m1",), (None,)], "name string"),
    }


def test_conflicts_and_reports(spark):
    v = _vertices(spark)
    tagged = tagged_names(v)
    assert sorted(map(tuple, conflicting_names(tagged).collect())) == [("x", 2)]
    assert sorted(map(tuple, conflicts_by_name(v).collect())) == [("x", 2)]
    assert [r.name for r in remove_conflicting(v["WIFI"], conflicts_by_name(v)).collect()] == ["w1"]
    edges = {"USE_WIFI": spark.createDataFrame([("m1", "x"), ("m1", "x"), ("m1", "w1")], "start_name string, end_name string")}
    assert count_edges_on(conflicts_by_name(v), edges["USE_WIFI"]).collect()[0].cnt == 2
    rep = [tuple(r) for r in conflict_report(v, edges).collect()]
    assert rep == [("x", 2, "d,w", 2)]
    u = {r.label: tuple(r)[1:] for r in uniqueness_report(v).collect()}
    assert u["DEVICE"] == (3, 2, 1, 0, 0)
    assert u["MOBILE"] == (2, 1, 0, 1, 0)
    assert u["ALL"] == (7, 4, 2, 1, 0)


def test_degree_report(spark):
    e = spark.createDataFrame([("CALL", 1, 2, None), ("CALL", 1, 3, None), ("CALL", 4, 3, None)],
                              "label string, start_id bigint, end_id bigint, mgm int")
    got = sorted(map(tuple, degree_report(e, 2).collect()))
    assert got == [(1, "out", "CALL", 2), (3, "in", "CALL", 2)]


def test_within_frame(spark):
    v = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id bigint, name string")
    names = spark.createDataFrame([("a",), ("c",), ("c",)], "n string")
    assert sorted(r.id for r in within_frame(v, "name", names).collect()) == [1, 3]


def test_decode_unknown_label(spark):
    lines = spark.createDataFrame([("1,MOBILE,a,,,,,,,,,,\t\t",), ("2,ROUTER,b\t\t",)], "value string")
    with pytest.raises(Exception, match="Unexpected vertex label"):
        decode_vertices(lines).collect()
    assert [r.id for r in decode_vertices(lines, strict=False).collect()] == [1]


def test_repeated_ids_and_append_duplicates(spark):
    v = {"DEVICE": spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id bigint, name string"),
         "WIFI": spark.createDataFrame([(2, "d")], "id bigint, name string")}
    got = {r.label: r.n_repeated_ids for r in uniqueness_report(v).collect()}
    assert got == {"DEVICE": 1, "WIFI": 0, "ALL": 2}
    open_v = spark.createDataFrame([("WIFI", {"name": "a"}), ("WIFI", {"name": "a"}), ("DEVICE", {"name": "a"}), ("WIFI", {})],
                                   "label string, attrs map<string,string>")
    assert [tuple(r) for r in duplicate_names(open_v).collect()] == [("WIFI", "a", 2)]
    e = spark.createDataFrame([("CALL", 1, 2), ("CALL", 1, 2), ("HAS", 1, 2)], "label string, start_id bigint, end_id bigint")
    assert [tuple(r) for r in duplicate_edges(e).collect()] == [("CALL", 1, 2, 2)]


def test_unresolved_edges(spark):
    from edgeloom.operators.resolve import resolve_edges, unresolved_edges
    v = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "id bigint, name string")
    e = spark.createDataFrame([("a", "b"), ("a", "zz"), ("yy", "b"), ("yy", "zz")], "start_name string, end_name string")
    got = sorted(map(tuple, unresolved_edges(e, v, v).collect()))
    assert got == [("a", "zz", "end"), ("yy", "b", "start"), ("yy", "zz", "start")]
    assert resolve_edges(e, v.dropDuplicates(), v.dropDuplicates()).count() == 1
