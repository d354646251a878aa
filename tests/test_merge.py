"""Upsert semantics: overwrite when given, status only rises, idempotence, edge get-or-create."""


from edgeloom.operators.merge import (append_edges, append_vertices, dangling_edges, edge_between, merge_edges,
                                      merge_vertices, nameless, status_changes, vertex_exists)

STATE = "label string, name string, merchant_name string, status int"
DELTA = "label string, name string, merchant_name string, status int, ord bigint"


def _state(spark):
    return spark.createDataFrame([("MOBILE", "a", "shop", 2), ("MOBILE", "b", None, None), ("MOBILE", "c", "x", 5)], STATE)


def _delta(spark):
    return spark.createDataFrame([
        ("MOBILE", "a", "shop2", 1, 1),     # lower status: kept at 2; name overwritten
        ("MOBILE", "b", None, 0, 2),        # zero status: ignored
        ("MOBILE", "b", "late", 3, 3),      # raises from missing
        ("MOBILE", "b", None, 2, 4),        # later but lower: the largest positive stays
        ("MOBILE", "c", None, -1, 5),       # negative: ignored, merchant kept
        ("MOBILE", "d", "new", None, 6),    # new vertex without status
    ], DELTA)


def test_merge_vertices(spark):
    got = {r.name: (r.merchant_name, r.status) for r in merge_vertices(_state(spark), _delta(spark)).collect()}
    assert got == {"a": ("shop2", 2), "b": ("late", 3), "c": ("x", 5), "d": ("new", None)}


def test_merge_last_value_by_ord(spark):
    d = spark.createDataFrame([("MOBILE", "a", "first", None, 10), ("MOBILE", "a", "second", None, 20),
                               ("MOBILE", "a", None, None, 30)], DELTA)
    got = merge_vertices(_state(spark), d).where("name = 'a'").collect()[0]
    assert got.merchant_name == "second" and got.status == 2


def test_merge_is_idempotent(spark):
    once = merge_vertices(_state(spark), _delta(spark))
    twice = merge_vertices(once, _delta(spark))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_status_changes(spark):
    got = {r.name: (r.old_status, r.delta_status) for r in status_changes(_state(spark), _delta(spark)).collect()}
    assert got == {"b": (None, 3)}


def test_append_vertices_adds_digest(spark):
    state = spark.createDataFrame([("DEVICE", {"name": "FP1"})], "label string, attrs map<string,string>")
    delta = spark.createDataFrame([("MOBILE", "11.1", {"name": "187", "status": "-1"}),
                                   ("MOBILE", "11.2", {"name": "187"})], "label string, gid string, attrs map<string,string>")
    rows = append_vertices(state, delta).collect()
    assert len(rows) == 3  # no existence test
    m = [r.attrs for r in rows if r.label == "MOBILE"]
    assert all(a["nm_sha1"] == "f67462663a512121ffada791890b558ee8b38773" and a["nm_pass"] == "187" for a in m)
    assert {a.get("status") for a in m} == {"-1", None}  # append writes any status


def test_merge_edges_and_between(spark):
    schema = "start_name string, label string, end_name string, mgm int, ord bigint"
    state = spark.createDataFrame([("a", "CALL", "b", 1, 1), ("a", "CALL", "b", None, 2), ("a", "HAS", "c", None, 3)],
                                  schema)
    delta = spark.createDataFrame([("a", "CALL", "b", 0, 10), ("a", "CALL", "b", None, 11), ("x", "CALL", "y", None, 12),
                                   ("a", "HAS", "c", 7, 13)], schema)
    got = {(r.start_name, r.label, r.end_name): r.mgm for r in merge_edges(state, delta).collect()}
    assert got == {("a", "CALL", "b"): 0, ("a", "HAS", "c"): None, ("x", "CALL", "y"): None}
    between = {tuple(r) for r in edge_between(delta, state).collect()}
    assert between == {("a", "CALL", "b"), ("a", "HAS", "c")}


def test_append_edges_and_exists(spark):
    state = spark.createDataFrame([("HAS", 1, 2, None)], "label string, start_id bigint, end_id bigint, mgm int")
    delta = spark.createDataFrame([("CALL", 1, 1, 5), ("USE", 1, 3, 9)], "label string, start_id bigint, end_id bigint, mgm int")
    rows = sorted(map(tuple, append_edges(state, delta).collect()))
    assert rows == [("CALL", 1, 1, 5), ("HAS", 1, 2, None), ("USE", 1, 3, None)]
    names = spark.createDataFrame([("a",), ("zz",)], "name string")
    v = spark.createDataFrame([(1, "a")], "id bigint, name string")
    assert [r.name for r in vertex_exists(names, v).collect()] == ["a"]


def test_folded_and_plain_edge_states_agree(spark):
    schema = "start_name string, label string, end_name string, mgm int, ord bigint"
    state = spark.createDataFrame([("a", "CALL", "b", 1, 1), ("a", "HAS", "c", None, 3)], schema)
    delta = spark.createDataFrame([("a", "CALL", "b", 0, 10), ("x", "CALL", "y", None, 12)], schema)
    outs = [sorted(map(tuple, merge_edges(state, delta, state_folded=f).collect()), key=repr) for f in (False, True)]
    assert outs[0] == outs[1] == sorted([("a", "CALL", "b", 0), ("a", "HAS", "c", None), ("x", "CALL", "y", None)], key=repr)


def test_edges_without_their_ends_are_refused(spark):
    schema = "start_name string, label string, end_name string, mgm int, ord bigint"
    delta = spark.createDataFrame([("a", "CALL", "b", 1, 1), ("a", "CALL", "no", 1, 2), ("no", "HAS", "b", 1, 3),
                                   ("no", "USE", "nor", 1, 4), (None, "USE", "b", 1, 5)], schema)
    names = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "name string")
    got = merge_edges(spark.createDataFrame([], schema), delta, names)
    assert [tuple(r) for r in got.collect()] == [("a", "CALL", "b", 1)]
    lost = {(r.start_name, r.label, r.end_name): r.missing for r in dangling_edges(delta, names).collect()}
    assert lost == {("a", "CALL", "no"): "end", ("no", "HAS", "b"): "start", ("no", "USE", "nor"): "both",
                    (None, "USE", "b"): "start"}


def test_nameless_rows_change_nothing(spark):
    delta = spark.createDataFrame([("MOBILE", None, "x", 1, 1), (None, "b", "x", 1, 2), ("MOBILE", "z", None, None, 3)], DELTA)
    once = merge_vertices(_state(spark), delta)
    twice = merge_vertices(once, delta)
    assert sorted(r.name for r in twice.collect()) == ["a", "b", "c", "z"]
    assert nameless(delta).count() == 2


def test_merge_vertex_attrs(spark):
    from edgeloom.operators.merge import merge_vertex_attrs
    state = spark.createDataFrame([("MOBILE", "a", {"name": "a", "status": "2", "shop": "s1", "x": "1"}),
                                   ("DEVICE", "d", {"name": "d", "is_white": "false"})],
                                  "label string, name string, attrs map<string,string>")
    delta = spark.createDataFrame([
        ("MOBILE", "a", {"name": "a", "status": "1", "shop": "s2"}, 1),
        ("MOBILE", "a", {"name": "a", "shop": "s3", "status": "x"}, 2),
        ("MOBILE", "n", {"name": "n", "status": "0"}, 3),
        ("DEVICE", "d", {"name": "d", "status": "5", "is_white": "true"}, 4),
    ], "label string, name string, attrs map<string,string>, ord bigint")
    got = {r.name: dict(r.attrs) for r in merge_vertex_attrs(state, delta).collect()}
    sha_a = "86f7e437faa5a7fce15d1ddcb9eaeaea377667b8"
    assert got["a"] == {"name": "a", "nm_pass": "a", "nm_sha1": sha_a, "status": "2", "shop": "s3", "x": "1"}
    assert got["n"]["name"] == "n" and "status" not in got["n"] and got["n"]["nm_pass"] == "n"
    assert got["d"] == {"name": "d", "status": "5", "is_white": "true"}


def test_open_vertices_refuse_nameless_lines(spark):
    from edgeloom.operators.merge import merge_vertex_attrs
    empty = spark.createDataFrame([], "label string, name string, attrs map<string,string>")
    delta = spark.createDataFrame([("DEVICE", None, {"x": "1"}, 1), ("DEVICE", "d", {}, 2)],
                                  "label string, name string, attrs map<string,string>, ord bigint")
    once = merge_vertex_attrs(empty, delta)
    twice = merge_vertex_attrs(once, delta)
    assert [(r.name, dict(r.attrs)) for r in twice.collect()] == [("d", {"name": "d"})]


def test_increment_gives_ids_to_new_names_only(spark):
    from edgeloom.operators.increment import extend_ids, increment_edges, increment_vertices, vertex_rejects
    v = spark.createDataFrame([(1, "MOBILE", "b", None, 1), (7, "DEVICE", "d", "m", None)],
                              "id bigint, label string, name string, merchant_name string, status int")
    delta = spark.createDataFrame([("MOBILE", "b", "shop", 4, 1), ("MOBILE", "a", None, None, 2), ("WIFI", "d", "x", 1, 3),
                                   ("WIFI", "two", None, 1, 4), ("MOBILE", "two", None, 1, 5), ("MOBILE", None, "y", 1, 6)], DELTA)
    new = increment_vertices(v, delta)
    assert sorted((r.id, r.label, r.name, r.merchant_name, r.status) for r in new.collect()) == [
        (1, "MOBILE", "b", "shop", 4), (7, "DEVICE", "d", "m", None), (8, "MOBILE", "a", None, None)]
    assert {(r.label, r.name): r.error for r in vertex_rejects(v, delta).collect()} == {
        ("WIFI", "d"): "name of another label", ("WIFI", "two"): "several labels", ("MOBILE", "two"): "several labels",
        ("MOBILE", None): "no name"}
    assert [tuple(r) for r in extend_ids(v, spark.createDataFrame([("d",), (None,)], "name string")).collect()] == []
    edges = spark.createDataFrame([("CALL", 1, 7, 2), ("CALL", 1, 7, None)], "label string, start_id bigint, end_id bigint, mgm int")
    calls = spark.createDataFrame([("a", "CALL", "b", 5, 1), ("b", "CALL", "d", None, 2), ("a", "CALL", "gone", 1, 3)],
                                  "start_name string, label string, end_name string, mgm int, ord bigint")
    assert sorted(map(tuple, increment_edges(edges, new, calls).collect())) == [("CALL", 1, 7, 2), ("CALL", 8, 1, 5)]
