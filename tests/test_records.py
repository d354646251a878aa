"""Typed records, refolded lines, maintained counts, split joins, swapped tables."""

import os
import random
import threading

import pytest
from pyspark.sql import functions as F

from edgeloom.functions.predicates import has_eq
from edgeloom.operators.adjacency import build_adjacency, encode_adjacency, encode_checked, vertex_records
from edgeloom.operators.counts import (EDGE_COUNTS, EDGE_KEYS, NAME_COUNTS, NAME_KEYS, add_counts, counted_conflicts, counted_duplicates,
                                       counted_uniqueness, edge_counts, name_counts)
from edgeloom.operators.quality import conflicting_names, duplicate_edges, tagged_names, uniqueness_report
from edgeloom.operators.records import (both_of, build_records, edges_of, out_of, read_records, record_count_other_v, record_neighbours,
                                        vertices_of, write_records)
from edgeloom.operators.refold import refold, touched_ids
from edgeloom.operators.resolve import frequent_names, resolve_edges, resolve_edges_split
from edgeloom.operators.traverse import both, count_other_v, neighbours_filtered, out_e
from edgeloom.plans.graph import by_label, wide_vertices
from edgeloom.session import freeze
from edgeloom.sinks import tables
from edgeloom.sinks.layers import fold_layers, increment, read_graph, write_graph
from edgeloom.sinks.parts import merge_into_parts, read_parts
from edgeloom.sinks.tables import create_swapped, drop_old_stages, insert_overwrite

from test_golden import golden_graph
from test_layers import ED, VD, random_delta, rows
from test_plans import plan


@pytest.mark.parametrize("hub_degree", [0, 3, 10 ** 6])
def test_records_hold_the_edges_of_both_sides(spark, scratch_dir, hub_degree):
    by, edges = golden_graph(spark)
    wide = wide_vertices(by)
    path = os.path.join(scratch_dir, "r")
    write_records(build_records(wide, edges, hub_degree), path)
    r = read_records(spark, path)
    assert rows(vertices_of(r)) == rows(wide)
    ends = {"CALL": ("MOBILE", "MOBILE"), "USE": ("MOBILE", "DEVICE"), "HAS": ("DEVICE", "MOBILE"), "USE_WIFI": ("MOBILE", "WIFI")}
    label = {v.id: v.label for v in wide.select("id", "label").collect()}
    want = [e for e in edges.select("label", "start_id", "end_id", "mgm").collect()]
    for side, at, k in (("out_edges", 1, 0), ("in_edges", 2, 1)):
        mine = sorted(map(repr, (e for e in want if label.get(e[at]) == ends[e.label][k])))
        assert sorted(map(repr, edges_of(r, side).collect())) == mine
    for v in r.where("slice = 0").collect():
        if hub_degree == 0:
            assert not v.in_edges and not v.out_edges
        assert [tuple(e) for e in v.in_edges] == sorted((tuple(e) for e in v.in_edges), key=lambda e: (e[0], e[1], e[2] is not None, e[2]))


def test_hubs_are_cut_into_slices(spark):
    v = spark.range(1, 20_002).select("id", F.lit("MOBILE").alias("label"), F.concat(F.lit("n"), "id").alias("name"))
    e = spark.range(2, 20_002).select(F.lit("CALL").alias("label"), F.lit(1).cast("bigint").alias("start_id"), F.col("id").alias("end_id"),
                                      F.lit(None).cast("int").alias("mgm"))
    r = freeze(build_records(v, e, hub_degree=1000), "records")
    hub = r.where("id = 1")
    sizes = [x[0] for x in hub.select(F.size("out_edges")).collect()]
    assert sum(sizes) == 20_000 and max(sizes) <= 4096 and hub.where("slice = 0 and size(out_edges) = 0").count() == 1
    assert edges_of(r, "in_edges").count() == 20_000 and vertices_of(r).count() == 20_001
    assert record_count_other_v(r, [1], "CALL", "n5").first().cnt == 19_999


def test_traversals_of_records_need_no_edges(spark, scratch_dir):
    by, edges = golden_graph(spark)
    wide = wide_vertices(by)
    path = os.path.join(scratch_dir, "r")
    write_records(build_records(wide, edges), path)
    r = read_records(spark, path)
    assert rows(both_of(r, [1, 2], "CALL")) == rows(both(edges, [1, 2], "CALL"))
    assert rows(out_of(r, wide.where("id < 3"), None)) == rows(out_e(edges, wide.where("id < 3")))
    n1 = record_neighbours(r, ["anna", "bert"], "CALL", has_eq("label", "MOBILE"))
    assert rows(n1) == rows(neighbours_filtered(wide, edges, ["anna", "bert"], "CALL", has_eq("label", "MOBILE")))
    assert rows(record_count_other_v(r, [1], "CALL", "anna")) == rows(count_other_v(wide, edges, [1], "CALL", "anna"))
    p = plan(record_count_other_v(r, [1], "CALL", "anna"))
    assert "EqualTo(id,1)" in p and "in_edges" not in p.split("ReadSchema")[1].split("\n")[0], p  # only the out side is read


def test_refolded_lines_equal_a_full_fold(spark, scratch_dir):
    r, base = random.Random(5), os.path.join(scratch_dir, "g")
    vertices = spark.createDataFrame([(k + 1, "MOBILE" if k % 5 else "DEVICE", f"n{k}", r.choice([None, 1, 2])) for k in range(50)],
                                     "id bigint, label string, name string, status int")
    wide = wide_vertices({x: vertices.where(F.col("label") == x) for x in ("MOBILE", "DEVICE")})
    edges = spark.createDataFrame([("CALL", r.randrange(1, 51), r.randrange(1, 51), r.choice([None, 1])) for _ in range(90)],
                                  "label string, start_id bigint, end_id bigint, mgm int")
    write_graph(spark, base, wide, edges, part_ids=9)

    def fold(of):
        return encode_checked(build_adjacency(vertex_records(by_label(of.vertices)), of.edges))

    seen = read_graph(spark, base)
    lines = freeze(fold(seen), "lines")
    for k in range(4):
        increment(spark, base, *random_delta(spark, r, 6))
        now = read_graph(spark, base)
        touched = freeze(touched_ids(now, seen), "touched")
        assert 0 < touched.count() < 45
        lines = freeze(refold(lines, now, touched, encode_checked), "lines")
        assert rows(lines) == rows(fold(now))
        if k == 1:
            fold_layers(spark, base)
            now = read_graph(spark, base)
        seen = now
    assert encode_adjacency(build_adjacency(vertex_records(by_label(now.vertices)), now.edges)).count() <= lines.count()


def test_counts_follow_random_appends(spark, scratch_dir):
    r = random.Random(3)
    state = {"v": {}, "e": {}}
    all_v, all_e = [], []
    for k in range(6):
        v = [(r.choice(["MOBILE", "DEVICE"]), r.choice([None, *[f"n{i}" for i in range(30)]])) for _ in range(12)]
        e = [(r.choice(["CALL", "HAS"]), r.randrange(9), r.randrange(9)) for _ in range(12)]
        gone = [all_e.pop(r.randrange(len(all_e))) for _ in range(3)] if all_e else []
        all_v, all_e = all_v + v, all_e + e
        frames = {"v": name_counts(spark.createDataFrame(v, "label string, name string")),
                  "e": edge_counts(spark.createDataFrame(e, "label string, start_id bigint, end_id bigint"))}
        if gone:
            frames["e"] = add_counts(frames["e"], edge_counts(spark.createDataFrame(gone, "label string, start_id bigint, end_id bigint"), -1))
        for c, keys, empty in (("v", NAME_KEYS, NAME_COUNTS), ("e", EDGE_KEYS, EDGE_COUNTS)):
            change = merge_into_parts(spark, state[c], keys, freeze(frames[c], "d"), empty, add_counts, f"{scratch_dir}/{c}{k}", part_rows=10)
            state[c] = {p: f for p, f in state[c].items() if p not in change["drop"]} | change["parts"]
        names, pairs = read_parts(spark, state["v"]), read_parts(spark, state["e"])
        by = {x: spark.createDataFrame([(n,) for lab, n in all_v if lab == x], "name string") for x in ("MOBILE", "DEVICE")}
        want = uniqueness_report(by).drop("n_repeated_ids")
        assert rows(counted_uniqueness(names)) == rows(want)
        tagged = tagged_names({x: f.where("name is not null") for x, f in by.items()})
        assert rows(counted_conflicts(names)) == rows(conflicting_names(tagged).withColumnRenamed("count", "n_labels"))
        edges = spark.createDataFrame(all_e, "label string, start_id bigint, end_id bigint")
        assert rows(counted_duplicates(pairs)) == rows(duplicate_edges(edges))


def test_heavy_names_are_dealt_out(spark):
    # a third of the edges on one name, which 40 vertices hold (an append keeps bags)
    ids = spark.range(400).select(F.col("id"), F.when(F.col("id") < 40, "hot").otherwise(F.concat(F.lit("n"), "id")).alias("name"))
    edges = spark.range(6000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("n"), F.col("id") % 500)).alias("start_name"),
                                     F.concat(F.lit("n"), F.col("id") % 450).alias("end_name"), F.lit(None).cast("int").alias("mgm"))
    assert "hot" in frequent_names(edges, "start_name") and len(frequent_names(edges, "start_name")) <= 100
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        split = resolve_edges_split(edges, ids, ids, salts=16)
        assert rows(split) == rows(resolve_edges(edges, ids, ids))
        p = plan(split, "simple")
        assert p.count("_salt") and p.count("SortMergeJoin") >= 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert resolve_edges_split(edges.limit(0), ids, ids).count() == 0


def test_a_swapped_table_is_whole_at_any_time(spark, monkeypatch):
    create_swapped(spark.range(5).selectExpr("id as a", "1 as b"), "el_swapped")
    insert_overwrite(spark.table("el_swapped").where("a > 1"), "el_swapped")
    assert [r.a for r in spark.table("el_swapped").orderBy("a").collect()] == [2, 3, 4]

    def crash(*_):
        raise RuntimeError("crash")

    with monkeypatch.context() as m:
        m.setattr(tables, "_point", crash)
        with pytest.raises(RuntimeError):
            insert_overwrite(spark.range(1).selectExpr("id as x", "2 as y"), "el_swapped")
    assert spark.table("el_swapped").count() == 3  # the old rows
    seen, stop = set(), threading.Event()

    def reader():
        while not stop.is_set():
            seen.add(spark.table("el_swapped").count())

    t = threading.Thread(target=reader)
    t.start()
    insert_overwrite(spark.range(10).selectExpr("id as x", "2 as y"), "el_swapped")
    stop.set()
    t.join()
    assert seen <= {3, 10} and spark.table("el_swapped").columns == ["a", "b"] and spark.table("el_swapped").count() == 10
    assert len(drop_old_stages(spark, "el_swapped")) == 3 and spark.table("el_swapped").count() == 10


def test_a_fold_makes_its_edges_once(spark):
    v = spark.createDataFrame([(k, "MOBILE", "p") for k in range(1, 31)], "id bigint, label string, props string")
    e = spark.range(90).select(F.lit("CALL").alias("label"), (F.col("id") % 30 + 1).alias("start_id"),
                               (F.col("id") * 7 % 30 + 1).alias("end_id"), F.lit(None).cast("int").alias("mgm"))
    for fold in (build_adjacency, build_records):
        p = plan(fold(v, e, hub_degree=5), "simple")
        assert "Range (" not in p and "FileScan parquet" in p, p
        stored = freeze(e, "e")
        assert "fold-edges" not in plan(fold(v, stored, hub_degree=5, edges_stored=True)) and "fold-edges" in plan(fold(v, stored, hub_degree=5))


def test_a_traversal_of_records_moves_only_its_label(spark):
    by, edges = golden_graph(spark)
    wide = wide_vertices(by)
    r = freeze(build_records(wide, edges, 10 ** 6), "records")
    start = vertices_of(r)
    assert "filter(out_edges" in plan(out_of(r, start, "CALL")) and "filter(concat(out_edges" in plan(both_of(r, start, "CALL"))
    assert rows(out_of(r, start, "CALL")) == rows(out_of(r, start).where("label = 'CALL'"))
    assert rows(record_count_other_v(r, start, "CALL", "x", per_start=True)) == rows(count_other_v(wide, edges, wide.select("id"), "CALL", "x", per_start=True))


def test_exported_edges_are_made_once(spark, monkeypatch):
    from edgeloom.plans import q_round_trip
    made = []
    monkeypatch.setattr(q_round_trip, "freeze", lambda df, name: made.append(name) or freeze(df, name))
    n = q_round_trip.q_round_trip_edge_text(spark, "/root/testdata/sf0.001").first()[0]
    assert made == ["staged-edges"] * 4 and n == sum(e.count() for e in q_round_trip.fx.staged_edges(spark, "/root/testdata/sf0.001").values())
