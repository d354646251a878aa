"""A small graph with its lines written out by hand.

It covers: a vertex with edges on one side only, on both, on neither; several labels on one side; an empty
mgm; empty strings and nulls among the properties; a pipe inside a property.
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeloom.operators.adjacency import (build_adjacency, decode_edges, decode_vertices, encode_adjacency,
                                          encode_rejects, vertex_records)
from edgeloom.operators.resolve import graph_edges
from edgeloom.schema import DEVICE, DEVICE_SCHEMA, MOBILE, MOBILE_SCHEMA, WIFI
from edgeloom.sources.tables import rows_to_df


def _with_id(schema):
    return T.StructType([T.StructField("id", T.LongType(), False)] + schema.fields)


def golden_graph(spark):
    mobiles = rows_to_df(spark, [
        (1, "anna", "x|y", "aa11", "true", "", "", "", "", 1, None, None),
        (2, "bert", "x|y", "bb22", "true", None, "", "", "Shop", 2, None, 0),
        (3, "cleo", "", "cc33", "", "true", "", "", "", None, 4, 1),
    ], _with_id(MOBILE_SCHEMA))
    devices = rows_to_df(spark, [(40, "tablet", None, "false"), (50, "watch", "true", None), (60, "spare", "true", "false")],
                         _with_id(DEVICE_SCHEMA))
    wifis = rows_to_df(spark, [(700, "cafe", None, "false"), (800, "station", "true", None)], _with_id(DEVICE_SCHEMA))
    e2 = T.StructType([T.StructField("start_id", T.LongType(), False), T.StructField("end_id", T.LongType(), True)])
    e3 = T.StructType(e2.fields + [T.StructField("mgm", T.IntegerType(), True)])
    resolved = {
        "CALL": rows_to_df(spark, [(1, 2, 6), (2, 1, None)], e3),
        "HAS": rows_to_df(spark, [(40, 1), (40, 2), (40, 3), (50, 1)], e2),
        "USE": rows_to_df(spark, [(1, 50)], e2),
        "USE_WIFI": rows_to_df(spark, [(1, 700), (2, 700), (3, 800)], e2),
    }
    return {MOBILE: mobiles, DEVICE: devices, WIFI: wifis}, graph_edges(resolved)


EXPECTED = [
    "1,MOBILE,anna,x|y,aa11,true,,,,,1,,\tCALL,2,|HAS,40|HAS,50\tCALL,2,6|USE,50|USE_WIFI,700",
    "2,MOBILE,bert,x|y,bb22,true,,,,Shop,2,,0\tCALL,1,6|HAS,40\tCALL,1,|USE_WIFI,700",
    "3,MOBILE,cleo,,cc33,,true,,,,,4,1\tHAS,40\tUSE_WIFI,800",
    "40,DEVICE,tablet,,false\t\tHAS,1|HAS,2|HAS,3",
    "50,DEVICE,watch,true,\tUSE,1\tHAS,1",
    "60,DEVICE,spare,true,false\t\t",
    "700,WIFI,cafe,,false\tUSE_WIFI,1|USE_WIFI,2\t",
    "800,WIFI,station,true,\tUSE_WIFI,3\t",
]


def test_golden_lines(spark):
    vertices, edges = golden_graph(spark)
    lines = encode_adjacency(build_adjacency(vertex_records(vertices), edges))
    got = sorted(r.line for r in lines.collect())
    assert got == sorted(EXPECTED)


def test_golden_lines_with_every_vertex_a_hub(spark):
    vertices, edges = golden_graph(spark)
    lines = encode_adjacency(build_adjacency(vertex_records(vertices), edges, hub_degree=0))
    assert sorted(r.line for r in lines.collect()) == sorted(EXPECTED)


def test_decode_round_trip(spark):
    vertices, edges = golden_graph(spark)
    lines = encode_adjacency(build_adjacency(vertex_records(vertices), edges)).select(F.col("line").alias("value"))
    back = decode_edges(lines)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, edges.collect()), key=repr)
    dv = {r.id: r for r in decode_vertices(lines).collect()}
    assert dv[1].name == "anna" and dv[1].status == 1 and dv[1].overdue_status is None
    assert dv[1].is_risk is None and dv[1].nm_sha1 == "aa11" and dv[1].nm_pass == "x|y"
    assert dv[2].overdue_status == 0 and dv[2].merchant_name == "Shop"
    assert dv[50].is_exception == "true" and dv[50].is_white is None and dv[50].label == "DEVICE"
    assert dv[700].label == "WIFI" and dv[700].is_white == "false"


def test_repeated_edges_are_kept(spark):
    vertices, edges = golden_graph(spark)
    doubled = edges.union(edges.where("label = 'HAS' and start_id = 40 and end_id = 3"))
    for degree in (0, 100):
        adj = build_adjacency(vertex_records(vertices), doubled, hub_degree=degree)
        lines = {r.id: r.line for r in encode_adjacency(adj).collect()}
        assert lines[40].endswith("\tHAS,1|HAS,2|HAS,3|HAS,3")
        assert lines[3].endswith("\tHAS,40|HAS,40\tUSE_WIFI,800")


def test_no_line_reads_back_as_other_values(spark):
    schema = "id bigint, name string, is_exception string, is_white string"
    d = spark.createDataFrame([(1, "ok", "a|b", None), (2, "a,b", None, None), (3, "c", "x\ty", None), (4, "d", None, "u\nv"),
                               (5, "e", "  ", None), (6, None, None, None), (7, "f", "", "r\rs"), (8, "g", "", "true")], schema)
    adj = build_adjacency(vertex_records({DEVICE: d}), golden_graph(spark)[1])
    good = decode_vertices(encode_adjacency(adj).select(F.col("line").alias("value")))
    assert sorted((r.id, r.name, r.is_exception, r.is_white) for r in good.collect()) == [
        (1, "ok", "a|b", None), (8, "g", None, "true")]
    assert {r.id: r.error for r in encode_rejects(adj).collect()} == {
        2: "separator in a value", 3: "separator in a value", 4: "separator in a value", 5: "blank value", 6: "no name",
        7: "separator in a value"}
