"""Physical plan shapes the design relies on."""

import io
import os
import re
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from edgeloom.operators.adjacency import build_adjacency, hub_ids
from edgeloom.operators.merge import merge_vertices
from edgeloom.operators.traverse import both, count_other_v, pairs_report
from edgeloom.plans import fixtures as fx
from edgeloom.plans import q_round_trip
from edgeloom.plans.graph import wide_vertices
from edgeloom.plans.pipeline import load_graph
from edgeloom.sinks.tables import read_in_edges, read_snapshot, write_snapshot

from test_golden import golden_graph

SF = "/root/testdata/sf0.001"


def plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_hub_lookup_pushes_start_id_into_the_scan(spark, scratch_dir):
    vertices, edges = golden_graph(spark)
    write_snapshot(wide_vertices(vertices), edges, os.path.join(scratch_dir, "snap"))
    v, e = read_snapshot(spark, os.path.join(scratch_dir, "snap"))
    p = plan(count_other_v(v, e, [11], "HAS", "x"))
    assert re.search(r"PushedFilters: \[.*EqualTo\(start_id,11\)", p), p
    assert re.search(r"PartitionFilters: \[.*label.* = HAS", p), p


def test_ordinary_half_edges_are_shuffled_once(spark):
    # ids spread over 10**8: nearness of ids must not matter
    v = spark.range(2000).select((F.col("id") * 49_999 + 1).alias("id"), F.lit("MOBILE").alias("label"), F.lit("p").alias("props"))
    e = spark.range(20_000).select(F.lit("CALL").alias("label"), (F.col("id") % 2000 * 49_999 + 1).alias("start_id"),
                                   (F.col("id") * 7919 % 2000 * 49_999 + 1).alias("end_id"), F.lit(None).cast("int").alias("mgm"))
    assert hub_ids(e).count() == 0
    df = build_adjacency(v, e)
    p = plan(df, "simple")
    # half-edges meet their vertex by (id, vlabel); the other exchanges carry counts of degrees, and hub rows only
    assert len(re.findall(r"Exchange hashpartitioning\(id#\d+L?, vlabel", p)) == 1, p
    assert "SortMergeJoin" not in p and "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p
    text = {n: sorted(map(tuple, build_adjacency(v, e, hub_degree=n).collect())) for n in (0, 5, 19, 10 ** 6)}
    assert len({str(x) for x in text.values()}) == 1


def test_merge_is_one_full_outer_join(spark):
    state = spark.range(0, 1000).select(F.lit("MOBILE").alias("label"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"),
                                        F.lit("m").alias("merchant_name"), F.lit(1).alias("status"))
    delta = spark.createDataFrame([("MOBILE", "n1", "z", 3, 1), ("MOBILE", "new", None, 2, 2)],
                                  "label string, name string, merchant_name string, status int, ord bigint")
    p = plan(merge_vertices(state, delta), "simple")
    assert p.count("FullOuter") == 1 and "Broadcast" not in p, p


def test_bucketed_state_is_not_shuffled_by_a_merge(spark):
    from edgeloom.sinks.tables import replace_table
    state = spark.createDataFrame([("MOBILE", "a", "m", 1)], "label string, name string, merchant_name string, status int")
    replace_table(state, "el_bucketed_state", bucket_by=("label", "name"), buckets=8)
    delta = spark.createDataFrame([("MOBILE", "n", "z", 3, 1)], "label string, name string, merchant_name string, status int, ord bigint")
    df = merge_vertices(spark.table("el_bucketed_state"), delta)
    p = plan(df, "simple")
    assert p.count("Exchange hashpartitioning(label") == 1, p  # the collapse of the delta
    assert df.count() == 2


def test_pairs_report_reads_the_vertices_twice(spark, scratch_dir):
    vertices, edges = golden_graph(spark)
    path = os.path.join(scratch_dir, "snap3")
    write_snapshot(wide_vertices(vertices), edges, path)
    v, e = read_snapshot(spark, path)
    df = pairs_report(v, e, ["anna", "bert"], "CALL", {"a": "m1.name", "b": "m2.status"})
    assert df.count() == 4
    df.collect()
    final = plan(df, "simple").split("+- == Initial Plan ==")[0]
    assert final.count("snap3/vertices") == 2 and "ReusedExchange" in final, final  # the start set, and m2


def test_label_partitions_and_both_ends_are_pruned(spark, scratch_dir):
    edges = spark.range(100_000).select(F.lit("CALL").alias("label"), F.col("id").alias("start_id"),
                                        (F.col("id") * 7919 % 100_000).alias("end_id"), F.lit(None).cast("int").alias("mgm"))
    edges = edges.unionByName(edges.withColumn("label", F.lit("HAS")))
    path = os.path.join(scratch_dir, "snap4")
    write_snapshot(spark.range(3).select("id", F.lit("MOBILE").alias("label")), edges, path)
    _, out = read_snapshot(spark, path)
    for frame, key in ((out, "start_id"), (read_in_edges(spark, path), "end_id")):
        q = frame.where((F.col("label") == "CALL") & F.col(key).isin(5))
        p = plan(q)
        assert re.search(r"PartitionFilters: \[.*label.* = CALL", p) and re.search(rf"PushedFilters: \[.*EqualTo\({key},5\)", p), p
        # global order: the ranges of the files of a label do not overlap
        spans = (frame.where("label = 'CALL'").groupBy(F.input_file_name()).agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
                 .orderBy("lo").collect())
        assert all(a.hi < b.lo for a, b in zip(spans, spans[1:]))
        assert q.count() == 1


def test_resolution_broadcasts_small_id_tables(spark):
    g = load_graph(fx.staged_vertices(spark, SF), fx.staged_edges(spark, SF), materialize=True)
    p = plan(g.resolved["USE"], "simple")
    # the two resolution joins (and the small fixture joins below them) are all broadcast
    assert p.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in p, p


def test_both_restricts_each_side_before_the_union(spark, scratch_dir):
    vertices, edges = golden_graph(spark)
    path = os.path.join(scratch_dir, "snap2")
    write_snapshot(wide_vertices(vertices), edges, path)
    _, e = read_snapshot(spark, path)
    q = both(e, [1], "CALL", read_in_edges(spark, path))
    p = plan(q)
    assert re.search(r"PushedFilters: \[.*EqualTo\(start_id,1\)", p) and re.search(r"PushedFilters: \[.*EqualTo\(end_id,1\)", p), p
    assert "Generate" not in p
    assert sorted(map(tuple, q.collect())) == sorted(map(tuple, both(edges, [1], "CALL").collect())) == [(1, 2), (1, 2)]


def test_edge_text_round_trip_sees_changed_lines(spark, monkeypatch):
    write, true = q_round_trip.write_lines, q_round_trip.q_round_trip_edge_text(spark, SF).first().n
    assert true == sum(e.count() for e in fx.staged_edges(spark, SF).values())
    for change in (F.concat("line", F.lit("x")), F.expr("substring(line, 1, 12)"), F.lit("")):  # as many lines as before
        monkeypatch.setattr(q_round_trip, "write_lines", lambda lines, path, c=change: write(lines.withColumn("line", c), path))
        assert q_round_trip.q_round_trip_edge_text(spark, SF).first().n != true
