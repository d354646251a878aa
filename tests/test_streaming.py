"""The incremental import as a catch-up stream over new text files, and what a crash leaves behind."""

import os

import pytest

from edgeloom.operators.traverse import count_other_v
from edgeloom.sinks import versions
from edgeloom.sinks.layers import layers_of, read_graph, write_graph
from edgeloom.sinks.versions import current_commit, current_version
from edgeloom.streaming import upsert
from edgeloom.streaming.upsert import (increment_graph_batch, read_state, start_upsert_stream, upsert_edges_batch,
                                       upsert_open_vertices_batch, upsert_vertices_batch)


def _write(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def _paths(scratch_dir):
    return (os.path.join(scratch_dir, x) for x in ("in", "state", "ck"))


def _rejects(spark, base):
    return {r.line: r.error for r in spark.read.parquet(f"{current_version(spark, base)}/rejects").collect()}


def test_vertex_upsert_stream(spark, scratch_dir):
    src, base, ck = _paths(scratch_dir)
    apply = upsert_vertices_batch(spark, base, ["merchant_name", "status"], casts={"status": "int"})
    _write(src, "a.txt", ['mobile[11.1]{"name": "a", "status": 2, "merchant_name": "m"}',
                          'mobile[11.2]{"name": "b", "status": 0}', 'mobile[11.9]{"status": 1}', "junk"])
    start_upsert_stream(spark, src, ck, apply).awaitTermination(120)
    assert _rejects(spark, base) == {'mobile[11.9]{"status": 1}': "no name", "junk": "no label bracket"}
    _write(src, "b.txt", ['mobile[11.3]{"name": "a", "status": 1, "merchant_name": "m2"}',
                          'mobile[11.3]{"name": "a", "merchant_name": "m3"}', 'mobile[11.4]{"name": "b", "status": 4}'])
    start_upsert_stream(spark, src, ck, apply).awaitTermination(120)
    got = {r.name: (r.merchant_name, r.status) for r in read_state(spark, base).collect()}
    assert got == {"a": ("m3", 2), "b": (None, 4)}  # the last line of a file wins


def test_a_batch_writes_only_the_parts_it_touches(spark, scratch_dir):
    src, base, ck = _paths(scratch_dir)
    apply = upsert_vertices_batch(spark, base, ["status"], casts={"status": "int"}, part_rows=4)
    _write(src, "a.txt", [f'mobile[11.{i}]{{"name": "n{i}", "status": 1}}' for i in range(40)])
    start_upsert_stream(spark, src, ck, apply).awaitTermination(120)
    first = current_commit(spark, base).parts
    assert len(first) >= 10
    _write(src, "b.txt", ['mobile[11.1]{"name": "n1", "status": 5}', 'mobile[11.1]{"name": "new", "status": 2}'])
    start_upsert_stream(spark, src, ck, apply).awaitTermination(120)
    second = current_commit(spark, base).parts
    changed = {p for p in second if second[p] != first.get(p)}
    gone = set(first) - set(second)  # parts that split
    assert 1 <= len(changed) and {c for c in changed if c not in first} == {c for c in second if any(c.startswith(g) for g in gone)}
    assert len(gone | (changed & set(first))) <= 2  # at most the parts of the two keys
    assert _state_of(spark, base) == sorted([(f"n{i}", 5 if i == 1 else 1) for i in range(40)] + [("new", 2)])


def test_edge_upsert_stream(spark, scratch_dir):
    src, base, ck = _paths(scratch_dir)
    names = spark.createDataFrame([(n,) for n in "abcxy"], "name string")
    apply = upsert_edges_batch(spark, base, lambda: names)
    _write(src, "a.txt", ['"a","CALL","b",1', '"a","HAS","c"', '"a","HAS","nobody"'])
    start_upsert_stream(spark, src, ck, apply).awaitTermination(120)
    assert _rejects(spark, base) == {'{"start_name":"a","label":"HAS","end_name":"nobody"}': "missing: end"}
    _write(src, "b.txt", ['"a","CALL","b",\\N', '"x","CALL","y",3'])
    start_upsert_stream(spark, src, ck, apply).awaitTermination(120)
    got = {(r.start_name, r.label, r.end_name): r.mgm for r in read_state(spark, base).collect()}
    assert got == {("a", "CALL", "b"): 1, ("a", "HAS", "c"): None, ("x", "CALL", "y"): 3}


def test_open_vertex_upsert_stream(spark, scratch_dir):
    src, base, ck = _paths(scratch_dir)
    apply = upsert_open_vertices_batch(spark, base)
    _write(src, "a.txt", ['mobile[11.1]{"name": "a", "status": 2, "shop": "s1"}', 'device[10.1]{"name": "d"}'])
    start_upsert_stream(spark, src, ck, apply).awaitTermination(120)
    _write(src, "b.txt", ['mobile[11.2]{"name": "a", "status": 1, "shop": "s2", "x": true}'])
    start_upsert_stream(spark, src, ck, apply).awaitTermination(120)
    got = {r.name: dict(r.attrs) for r in read_state(spark, base).collect()}
    assert got["a"]["status"] == "2" and got["a"]["shop"] == "s2" and got["a"]["x"] == "true"
    assert got["a"]["nm_pass"] == "a" and got["d"] == {"name": "d"}


def test_graph_increment_reaches_the_traversals(spark, scratch_dir):
    src, base, ck = _paths(scratch_dir)
    v = spark.createDataFrame([(1, "MOBILE", "a", None), (2, "MOBILE", "b", 3)], "id bigint, label string, name string, status int")
    e = spark.createDataFrame([("CALL", 1, 2, None)], "label string, start_id bigint, end_id bigint, mgm int")
    write_graph(spark, base, v, e)
    _write(src, "a.txt", ['mobile[11.3]{"name": "c", "status": 1}', '"a","CALL","c",4', '"a","CALL","zz",4', '"a","CALL"'])
    start_upsert_stream(spark, src, ck, increment_graph_batch(spark, base, ["status"], {"status": "int"})).awaitTermination(120)
    g = read_graph(spark, base)
    nv, ne = g.vertices, g.edges
    assert len(layers_of(g.commit)) == 1
    assert sorted((r.id, r.name) for r in nv.collect()) == [(1, "a"), (2, "b"), (3, "c")]
    assert count_other_v(nv, ne, [1], "CALL", "nobody").first().cnt == 2
    assert _rejects(spark, base) == {'"a","CALL"': "too few fields",
                                     '{"start_name":"a","label":"CALL","end_name":"zz"}': "missing: end"}


def _state_of(spark, base):
    return sorted((r.name, r.status) for r in read_state(spark, base).collect())


@pytest.mark.parametrize("where", ["state", "publish"])
def test_a_crash_leaves_the_old_state(spark, scratch_dir, monkeypatch, where):
    src, base, ck = _paths(scratch_dir)
    apply = upsert_vertices_batch(spark, base, ["status"], casts={"status": "int"})
    _write(src, "a.txt", ['mobile[11.1]{"name": "a", "status": 2}'])
    start_upsert_stream(spark, src, ck, apply).awaitTermination(120)
    before = current_version(spark, base)

    def crash(*_):
        raise RuntimeError("crash")

    with monkeypatch.context() as m:
        m.setattr(*((versions, "publish") if where == "publish" else (upsert, "next_version")), crash)
        _write(src, "b.txt", ['mobile[11.2]{"name": "b", "status": 1}'])
        with pytest.raises(Exception, match="crash"):
            start_upsert_stream(spark, src, ck, apply).awaitTermination(120)
    assert current_version(spark, base) == before and _state_of(spark, base) == [("a", 2)]
    start_upsert_stream(spark, src, ck, apply).awaitTermination(120)  # the batch runs again
    assert _state_of(spark, base) == [("a", 2), ("b", 1)]
