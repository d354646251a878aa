"""Refolded lines on plans that large graphs get: what is stored and shuffled, and the same rows."""

import os
import random

import pytest
from pyspark.sql import functions as F

from edgeloom.operators import adjacency, idset
from edgeloom.operators.adjacency import build_adjacency, encode_checked, vertex_records
from edgeloom.operators.idset import pack_ids
from edgeloom.operators.refold import refold, touched_ids
from edgeloom.plans import q_records
from edgeloom.plans.graph import by_label, wide_vertices
from edgeloom.session import freeze
from edgeloom.sinks import layers
from edgeloom.sinks.layers import increment, read_graph, write_graph

from test_growth import no_broadcast, own  # noqa: F401
from test_layers import ED, VD, random_delta, rows
from test_plans import plan


def _graph(spark, seed=3):
    r = random.Random(seed)
    v = spark.createDataFrame([(k + 1, "MOBILE" if k % 5 else "DEVICE", f"n{k}", r.choice([None, 1, 2])) for k in range(50)],
                              "id bigint, label string, name string, status int")
    e = spark.createDataFrame([(r.choice(["CALL", "USE", "other"]), r.randrange(1, 51), r.randrange(1, 51), r.choice([None, 1, 12]))
                               for _ in range(150)], "label string, start_id bigint, end_id bigint, mgm int")
    return wide_vertices({x: v.where(F.col("label") == x) for x in ("MOBILE", "DEVICE")}), e.unionByName(e.limit(20))


def _above(text, scan):
    """The operators over the first scan whose line holds ``scan``, up to the union that takes it."""
    lines = [x for x in text.split("\n") if x.strip(" :+-")]
    depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    at = next(k for k, x in enumerate(lines) if "FileScan" in x and scan in x)
    out, low = [], depth[at]
    for k in range(at, -1, -1):
        if depth[k] < low:
            low = depth[k]
            if "Union" in lines[k]:
                break
            out.append(lines[k])
    return out


def test_a_refold_shuffles_neither_lines_nor_edges_that_stand(spark, scratch_dir, no_broadcast):  # noqa: F811
    base = os.path.join(scratch_dir, "g")
    write_graph(spark, base, *_graph(spark), part_ids=9)
    before = read_graph(spark, base)
    lines = freeze(encode_checked(build_adjacency(vertex_records(by_label(before.vertices)), before.edges)), "lines")
    increment(spark, base, spark.createDataFrame([("MOBILE", "n7", 3, 1)], VD), spark.createDataFrame([("n1", "CALL", "n2", 5, 1)], ED))
    now = read_graph(spark, base)
    refolded = refold(lines, now, freeze(touched_ids(now, before), "touched"), encode_checked)
    assert rows(refolded) == rows(encode_checked(build_adjacency(vertex_records(by_label(now.vertices)), now.edges)))
    over = _above(plan(refolded, "simple"), "line#")
    assert over and not any("Exchange" in x or "SortMergeJoin" in x for x in over), over
    stand = _above(plan(now.edges, "simple"), "start_id#")
    assert any("LeftAnti" in x for x in stand) and not any("Exchange" in x for x in stand), stand


def test_refolded_lines_store_nothing_twice(spark, own, monkeypatch):  # noqa: F811
    stored = []
    for module in (q_records, layers, adjacency):
        monkeypatch.setattr(module, "freeze", lambda df, name="frozen", **kw: stored.append(name) or freeze(df, name, **kw))
    lines = q_records.q_refolded_lines(spark, own[0])
    assert {"vertices", "edges", "lines"} <= set(stored) and not {"graph-vertices", "graph-edges", "fold-edges"} & set(stored), stored
    assert lines.count() > 40


@pytest.mark.parametrize("hub_degree", [0, 5, 10 ** 6])
def test_a_fold_of_both_layouts_equals_a_fold(spark, hub_degree, monkeypatch):
    wide, edges = _graph(spark)
    v, e = vertex_records(by_label(wide)), freeze(edges, "e")
    want = rows(build_adjacency(v, e, hub_degree))
    assert rows(build_adjacency(v, e, hub_degree, edges_stored=True, in_edges=e.orderBy("end_id"), n_edges=170)) == want
    monkeypatch.setattr(adjacency, "HALVES_OF_A_TASK", 20)
    cut = build_adjacency(v, e, hub_degree, edges_stored=True, in_edges=e, n_edges=170)
    assert rows(cut) == want and "REPARTITION_BY_NUM" in plan(cut, "simple")


def test_stored_edges_are_folded_in_their_layout(spark, scratch_dir):
    wide, edges = _graph(spark)
    tables = [freeze(wide, "v"), freeze(edges, "e")]
    for name, stored in (("a", False), ("b", True)):
        write_graph(spark, os.path.join(scratch_dir, name), *tables, part_ids=9, stored=stored)
    a, b = (read_graph(spark, os.path.join(scratch_dir, x)) for x in "ab")
    want = rows(edges.groupBy("label", "start_id", "end_id").agg(F.max("mgm").alias("mgm")))
    assert rows(a.edges) == rows(b.edges) == rows(a.edges_in) == rows(b.edges_in) == want and rows(a.vertices) == rows(b.vertices)
    assert a.commit.parts.keys() == b.commit.parts.keys()


@pytest.mark.parametrize("small", [1_000_000, 0])
def test_layers_replace_edges_of_their_starts_only(spark, scratch_dir, small, monkeypatch):
    monkeypatch.setattr(idset, "SMALL_WORDS", small)
    r, base = random.Random(9), os.path.join(scratch_dir, "g")
    wide, edges = _graph(spark)
    write_graph(spark, base, wide, edges, part_ids=9)
    state = {(e.label, e.start_id, e.end_id): e.mgm for e in read_graph(spark, base).edges.collect()}
    for _ in range(2):
        v_delta, e_delta = random_delta(spark, r, 12)
        increment(spark, base, v_delta, e_delta)
        g = read_graph(spark, base)
        got = [tuple(e) for e in g.edges.collect()]
        assert len({e[:3] for e in got}) == len(got) and sorted(map(repr, got)) == sorted(repr(tuple(e)) for e in g.edges_in.collect())
        assert {e[:3] for e in got} >= set(state)
        state = {e[:3]: e[3] for e in got}


@pytest.mark.parametrize("small", [1_000_000, 0])
def test_id_sets(spark, small, monkeypatch):
    monkeypatch.setattr(idset, "SMALL_WORDS", small)
    held = [0, 1, 63, 64, 65, -1, -64, -65, 10 ** 15, 2 ** 63 - 1, -2 ** 63, None, 64]
    asked = sorted({*range(-70, 70), 10 ** 15, 10 ** 15 + 1, 2 ** 63 - 1, 2 ** 63 - 2, -2 ** 63, -2 ** 63 + 1})
    ids = pack_ids(spark.createDataFrame([(k,) for k in held], "id bigint"), "id")
    df = spark.createDataFrame([(k, "x") for k in [*asked, None, 1]], "k bigint, c string")
    inside = [k for k in [*asked, 1] if k in held]
    assert sorted(r.k for r in ids.of(df, "k").collect()) == sorted(inside)
    assert sorted(map(repr, (r.k for r in ids.of(df, "k", "left_anti").collect()))) == sorted(map(repr, [k for k in asked if k not in held] + [None]))
    assert ids.words == ids.rows.count() == 7
