"""Readers on hand-written lines, including the malformed cases."""

from edgeloom.operators.stage import stage_device, stage_mobile
from edgeloom.sources.text import (edge_line_errors, parse_edge_lines, ingest_call_edges, ingest_edges, ingest_labelled_edges,
                                   ingest_vertices, only_label, parse_vertex_lines, vertex_line_errors)


def _lines(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_vertex_lines(spark):
    lines = _lines(spark, [
        'mobile[11.5]{"name": "anna", "is_risk": "false", "overdue_status": 0, "status": 3}',
        'mobile[11.6]{"name": "bert", "status": 1, "merchant_name": "Shop"}',
        'device[10.2]{"name": "tablet"}',
        'Wifi[12.1]{"name": "bssid1", "is_white": null}',
        'no bracket {"name": "x"}',
        'mobile[1.1] no brace',
        'mobile[1.2]{"name": broken',
        '[1.3]{"name": "blank label"}',
    ])
    v = {r.gid: r for r in ingest_vertices(lines).collect()}
    assert set(v) == {"11.5", "11.6", "10.2", "12.1"}
    assert v["11.5"].label == "MOBILE" and v["11.5"].attrs["overdue_status"] == "0"
    assert v["12.1"].label == "WIFI" and "is_white" not in v["12.1"].attrs  # JSON null = absent
    errs = {r.line: r.error for r in vertex_line_errors(lines).collect()}
    assert errs == {'no bracket {"name": "x"}': "no label bracket", "mobile[1.1] no brace": "no attributes",
                    'mobile[1.2]{"name": broken': "bad json"}
    # blank label is skipped by ingest, but parsed
    parsed = {r.gid: r.label for r in parse_vertex_lines(lines).collect()}
    assert parsed["1.3"] == ""


def test_stage_mobile_types(spark):
    lines = _lines(spark, [
        'mobile[11.1]{"name": "187", "status": "2", "suspect_risk": 1.5, "overdue_status": "x", "is_risk": true}',
        'mobile[11.2]{"name": "188", "status": 3, "merchant_name": 12}',
    ])
    rows = {r.name: r for r in stage_mobile(ingest_vertices(lines)).collect()}
    assert rows["187"].status == 2 and rows["187"].suspect_risk is None and rows["187"].overdue_status is None
    assert rows["187"].is_risk == "true"
    assert rows["187"].nm_pass == "187"
    assert rows["187"].nm_sha1 == "f67462663a512121ffada791890b558ee8b38773"
    assert rows["188"].merchant_name == "12" and rows["188"].status == 3


def test_stage_device_and_wifi(spark):
    lines = _lines(spark, ['device[10.2]{"name": "FP1", "is_white": "false"}',
                           'wifi[12.1]{"name": "bssid1", "is_exception": "true"}'])
    v = ingest_vertices(lines)
    d = stage_device(v, "DEVICE").collect()
    w = stage_device(v, "WIFI").collect()
    assert [tuple(r) for r in d] == [("FP1", None, "false")]
    assert [tuple(r) for r in w] == [("bssid1", "true", None)]


def test_edge_lines(spark):
    lines = _lines(spark, [
        '"a","CALL","b",1',
        '"a","CALL","c",\\N',
        '"a","CALL","d"',
        '"a","CALL","e",',
        '"a","CALL","f",x',
        '"a","CALL","g",2,9',
        '"dev","has","m"',
        'short,line',
        '"a,b","CALL","q",1',
    ])
    call = {r.end_name: r.mgm for r in ingest_call_edges(lines).collect()}
    assert call == {"b": 1, "c": None, "d": None, "e": None, "g": 2, "m": None}
    errs = {r.line: r.error for r in edge_line_errors(lines).collect()}
    assert errs == {'"a","CALL","f",x': "bad mgm", "short,line": "too few fields",
                    '"a,b","CALL","q",1': "comma inside quotes"}
    lab = {r.end_name: (r.label, r.mgm) for r in ingest_labelled_edges(lines).collect()}
    # mgm only with exactly four fields, CALL and not \N
    assert lab["b"] == ("CALL", 1) and lab["c"] == ("CALL", None) and lab["e"] == ("CALL", None)
    assert lab["g"] == ("CALL", None) and lab["m"] == ("HAS", None)
    plain = {r.end_name: (r.start_name, r.label) for r in ingest_edges(lines).collect()}
    assert plain["m"] == ("dev", "HAS")
    assert "q" not in plain and "CALL" not in plain and "q" not in lab
    assert [r.value for r in only_label(lines, "HAS").collect()] == ['"dev","has","m"']


def test_each_reader_agrees_with_its_rejects(spark):
    lines = _lines(spark, ['"d","HAS","m",x', '"a","CALL","b",x', '"a","CALL","b",x,9', '"a","CALL"', '"a","CALL","c",1'])
    n = lines.count()
    for reader, read in (("plain", ingest_edges), ("call", ingest_call_edges), ("labelled", ingest_labelled_edges)):
        assert read(lines).count() + edge_line_errors(lines, reader).count() == n
    assert {r.line for r in edge_line_errors(lines, "labelled").collect()} == {'"a","CALL","b",x', '"a","CALL"'}
    assert {r.line for r in edge_line_errors(lines, "plain").collect()} == {'"a","CALL"'}


def test_load_keeps_what_it_refuses(spark):
    from edgeloom.plans.pipeline import stage_all
    v = _lines(spark, ['mobile[11.1]{"name": "a"}', 'mobile[11.2]{"name": "b"}', '[1.3]{"name": "x"}', 'cat[1.4]{"name": "y"}',
                       'mobile[11.5]{"status": 1}', "junk"])
    e = _lines(spark, ['"a","CALL","b",1', '"a","CALL"', '"a","LIKES","b"', '"a","CALL","b",z'])
    g = stage_all(v, e)
    assert sorted(map(tuple, g.rejects.select("source", "error").collect())) == [
        ("edges", "bad mgm"), ("edges", "too few fields"), ("edges", "unknown label"), ("vertices", "blank label"),
        ("vertices", "no label bracket"), ("vertices", "no name"), ("vertices", "unknown label")]
    assert [tuple(r) for r in g.edges.collect()] == [("CALL", 1, 2, 1)]
    by_file = stage_all(v, {"CALL": e})
    assert by_file.rejects.where("source = 'edges'").count() == 2 and by_file.remaining.count() == 0


def test_plain_lines_need_no_search_for_quoted_commas(spark):
    lines = ['"a","CALL","b",1', '"a","CALL","b"', '"a, b","CALL","c"', '"a","CALL","b,c",1', 'a,CALL,b', '"a","CALL","b",1,2', '"a"x,"b,c"',
             '"a","b', '"a","b","c","d,e"', '', None]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    parsed = parse_edge_lines(df)
    want = [False, False, True, True, False, False, True, False, True, False, None]
    got = {r.line: r.quoted_comma for r in parsed.collect()}
    assert [got[x] for x in lines] == want
    assert "RLIKE" in parsed._jdf.queryExecution().optimizedPlan().toString()
