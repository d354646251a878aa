"""Layered graphs: equal to whole-table increments, and as cheap as what they change."""

import os
import random
import threading

import pytest
from pyspark.sql import functions as F

from edgeloom.functions.predicates import has_eq
from edgeloom.operators.increment import increment_edges, increment_vertices
from edgeloom.operators.traverse import neighbours_filtered, pairs_report
from edgeloom.session import freeze
from edgeloom.sinks import layers
from edgeloom.sinks.layers import fold_layers, increment, layers_of, read_graph, write_graph
from edgeloom.sinks.names import buckets_for
from edgeloom.sinks.parts import children, merge_into_parts, read_parts
from edgeloom.sinks.versions import current_commit

from test_plans import plan

V = "id bigint, label string, name string, status int"
E = "label string, start_id bigint, end_id bigint, mgm int"
VD = "label string, name string, status int, ord bigint"
ED = "start_name string, label string, end_name string, mgm int, ord bigint"


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def size_of(folder, tables):
    return sum(os.path.getsize(os.path.join(d, f)) for t in tables for d, _, names in os.walk(os.path.join(folder, t)) for f in names
               if f.endswith(".parquet"))


def random_delta(spark, r, n):
    v = [(r.choice(["MOBILE", "DEVICE", None]) if r.random() < 0.3 else "MOBILE", r.choice([f"n{r.randrange(60)}", f"new{r.randrange(20)}", None]),
          r.choice([None, 0, 1, 2, 3]), k) for k in range(n)]
    e = [(f"n{r.randrange(60)}" if r.random() < 0.8 else f"new{r.randrange(20)}", r.choice(["CALL", "HAS"]),
          f"n{r.randrange(60)}" if r.random() < 0.8 else f"new{r.randrange(20)}", r.choice([None, 1, 2]), k) for k in range(n)]
    return spark.createDataFrame(v, VD), spark.createDataFrame(e, ED)


@pytest.mark.parametrize("seed", [1, 2])
def test_layers_equal_whole_increments(spark, scratch_dir, seed):
    r, base = random.Random(seed), os.path.join(scratch_dir, "g")
    vertices = spark.createDataFrame([(k + 1, "MOBILE" if k % 5 else "DEVICE", f"n{k}", r.choice([None, 1, 2])) for k in range(50)], V)
    edges = spark.createDataFrame([("CALL", r.randrange(1, 51), r.randrange(1, 51), r.choice([None, 1])) for _ in range(120)], E)
    write_graph(spark, base, vertices, edges, part_ids=7, bucket_names=10)
    edges = edges.groupBy("label", "start_id", "end_id").agg(F.max("mgm").alias("mgm"))
    for k in range(3):
        v_delta, e_delta = random_delta(spark, r, 12)
        increment(spark, base, v_delta, e_delta)
        vertices = freeze(increment_vertices(vertices, v_delta), "v")
        edges = freeze(increment_edges(edges, vertices, e_delta), "e")
        if k == 1:
            before = read_graph(spark, base)
            assert len(layers_of(before.commit)) == 2
            fold_layers(spark, base)
        g = read_graph(spark, base)
        assert rows(g.vertices) == rows(vertices) and rows(g.edges) == rows(edges) == rows(g.edges_in)
        assert rows(g.names.all_rows().drop("bucket")) == rows(vertices.select("name", "id", "label"))
    assert len(layers_of(g.commit)) == 1
    assert rows(before.vertices) != rows(g.vertices)  # a version that was read stays what it was


def big_graph(spark, n=60_000):
    v = spark.range(1, n + 1).select("id", F.lit("MOBILE").alias("label"), F.concat(F.lit("n"), "id").alias("name"), F.lit(1).alias("status"))
    e = spark.range(4 * n).select(F.lit("CALL").alias("label"), (F.col("id") * 7919 % n + 1).alias("start_id"),
                                  (F.col("id") * 104_729 % n + 1).alias("end_id"), F.lit(1).alias("mgm"))
    return v, e


def test_an_increment_writes_what_it_changes(spark, scratch_dir):
    base = os.path.join(scratch_dir, "g")
    first = write_graph(spark, base, *big_graph(spark), part_ids=2000)
    tables = ["vertices", "edges", "edges_in", "names"]
    whole = size_of(first.path, tables)
    # 1 % of the vertices and of the edges, near each other, as a day's records of a few cells are
    v_delta = spark.range(1, 601).select(F.lit("MOBILE").alias("label"), F.concat(F.lit("n"), "id").alias("name"), F.lit(3).alias("status"), F.col("id").alias("ord"))
    e_delta = spark.range(1, 2401).select(F.concat(F.lit("n"), F.col("id") % 600 + 1).alias("start_name"), F.lit("CALL").alias("label"),
                                          F.concat(F.lit("n"), F.col("id") * 13 % 600 + 1).alias("end_name"), F.lit(2).alias("mgm"), F.col("id").alias("ord"))
    layer = increment(spark, base, v_delta, e_delta)
    assert size_of(layer.path, tables) < 0.05 * whole
    folded = fold_layers(spark, base)
    assert not layers_of(folded) and size_of(folded.path, tables) < 0.15 * whole
    moved = {k for k in first.parts if k.split("/")[0] in ("vertices", "edges", "edges_in") and folded.parts[k] != first.parts[k]}
    assert moved == {"vertices/0", "edges/0", "edges_in/0"}
    g = read_graph(spark, base)
    assert g.vertices.where("status = 3").count() == 600 and g.vertices.count() == 60_000
    assert g.edges.count() == g.edges_in.count() == g.edges.distinct().count()


def test_filters_reach_the_base_below_the_layers(spark, scratch_dir):
    base = os.path.join(scratch_dir, "g")
    write_graph(spark, base, *big_graph(spark, 2000), part_ids=500)
    increment(spark, base, spark.createDataFrame([("MOBILE", "n7", 9, 1), ("MOBILE", "x", 1, 2)], VD),
              spark.createDataFrame([("n7", "CALL", "x", 5, 1)], ED))
    g = read_graph(spark, base)
    p = plan(g.edges.where("label = 'CALL' and start_id = 7"))
    assert p.count("EqualTo(start_id,7)") >= 2 and "PartitionFilters: [isnotnull(label" in p, p
    assert g.edges.where("label = 'CALL' and start_id = 7 and mgm = 5").count() == 1
    assert plan(g.vertices.where("id = 7")).count("EqualTo(id,7)") >= 2


def test_a_lookup_opens_the_buckets_of_its_names(spark, scratch_dir):
    base = os.path.join(scratch_dir, "g")
    write_graph(spark, base, *big_graph(spark), bucket_names=500)
    index = read_graph(spark, base).names
    assert index.buckets == 128
    names = [f"n{k}" for k in (3, 500, 77, 1234, 59_999, 8, 9, 10, 11, 12)]
    found = index.find(names)
    assert sorted(r.id for r in found.collect()) == sorted(int(n[1:]) for n in names)
    buckets = {r.bucket for r in index.all_rows().where(F.col("name").isin(names)).select("bucket").collect()}
    p = plan(found)
    filters = p.split("PartitionFilters: [")[1].split("]")[0]
    assert "bucket" in filters and "In(name" in p
    opened = [f for f in os.listdir(os.path.join(current_commit(spark, base).path, "names")) if f.startswith("bucket=")]
    assert len(opened) == 128 and 1 <= len(buckets) <= 10
    assert all(str(b) in filters for b in buckets) and filters.count(",") <= 12, filters
    frame = spark.createDataFrame([(n,) for n in names], "name string")
    assert rows(index.find(frame)) == rows(found)
    assert all(str(b) in plan(index.find(frame)).split("PartitionFilters: [")[1].split("]")[0] for b in buckets)
    assert index.ids(["n3", "nobody"]) == [3] and index.ids(["n3"], label="WIFI") == []


def test_traversals_from_the_index(spark, scratch_dir):
    base = os.path.join(scratch_dir, "g")
    vertices, edges = big_graph(spark, 3000)
    edges = edges.distinct()
    write_graph(spark, base, vertices, edges, part_ids=400, bucket_names=100)
    g, names, cols = read_graph(spark, base), ["n5", "n2500", "nobody"], {"a": "m1.name", "b": "m2.name"}
    for given in (names, spark.createDataFrame([(n,) for n in names], "name string")):
        q = neighbours_filtered(g.vertices, g.edges, given, "CALL", has_eq("label", "MOBILE"), "MOBILE", edges_in=g.edges_in, index=g.names)
        assert rows(q) == rows(neighbours_filtered(vertices, edges, given, "CALL", has_eq("label", "MOBILE"), "MOBILE"))
        n3 = pairs_report(g.vertices, g.edges, given, "CALL", cols, edges_in=g.edges_in, index=g.names)
        assert rows(n3) == rows(pairs_report(vertices, edges, given, "CALL", cols))
    q = neighbours_filtered(g.vertices, g.edges, names, "CALL", has_eq("label", "MOBILE"), edges_in=g.edges_in, index=g.names)
    for p in (plan(q), plan(pairs_report(g.vertices, g.edges, names, "CALL", cols, edges_in=g.edges_in, index=g.names))):
        assert "In(start_id, [" in p and "In(end_id, [" in p and "/edges_in" in p, p


def test_two_increments_at_once_both_get_in(spark, scratch_dir, monkeypatch):
    base = os.path.join(scratch_dir, "g")
    write_graph(spark, base, *big_graph(spark, 100), part_ids=10)
    gate, made = threading.Barrier(2), layers.publish_retrying

    def together(spark, base, make, **kw):
        def first(last):
            out = make(last)
            if last.number == 1:
                gate.wait(60)  # both are made from the same version
            return out
        return made(spark, base, first, **kw)

    monkeypatch.setattr(layers, "publish_retrying", together)
    none_v, none_e, failed = spark.createDataFrame([], VD), spark.createDataFrame([], ED), []

    def run(k):
        try:
            increment(spark, base, spark.createDataFrame([("MOBILE", f"w{k}", k, 1)], VD) if k else none_v,
                      spark.createDataFrame([("n1", "CALL", f"w{k}" if k else "n2", 7, 1)], ED) if k else none_e)
        except Exception as e:  # noqa: BLE001 - shown by the assertion
            failed.append(e)

    threads = [threading.Thread(target=run, args=(k,)) for k in (1, 2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    g = read_graph(spark, base)
    assert not failed and g.commit.number == 3 and len(layers_of(g.commit)) == 2
    assert sorted(r.id for r in g.vertices.where("id > 100").collect()) == [101, 102]  # no id was given twice
    assert g.edges.where("mgm = 7").count() == 2


def test_a_fold_and_an_increment_at_once(spark, scratch_dir, monkeypatch):
    base = os.path.join(scratch_dir, "g")
    write_graph(spark, base, *big_graph(spark, 100), part_ids=10)
    none = spark.createDataFrame([], ED)
    increment(spark, base, spark.createDataFrame([("MOBILE", "n3", 5, 1)], VD), none)
    made, done = layers.publish_retrying, []

    def late(spark, base, make, **kw):
        def slow(last):
            out = make(last)
            if not done:
                done.append(1)
                increment(spark, base, spark.createDataFrame([("MOBILE", "n3", 6, 1), ("MOBILE", "z", 1, 2)], VD), none)
            return out
        return made(spark, base, slow, **kw)

    monkeypatch.setattr(layers, "publish_retrying", late)
    fold_layers(spark, base)
    g = read_graph(spark, base)
    assert len(layers_of(g.commit)) == 1  # the one that came meanwhile
    assert g.vertices.where("name = 'n3'").first().status == 6 and g.names.ids(["z"]) == [101]


def test_the_index_doubles_its_buckets(spark, scratch_dir):
    base = os.path.join(scratch_dir, "g")
    first = write_graph(spark, base, *big_graph(spark, 40), bucket_names=20)
    assert first.parts["buckets"] == "2" and [buckets_for(n, 20) for n in (0, 20, 21, 81)] == [1, 1, 2, 8]
    delta = spark.range(100).select(F.lit("MOBILE").alias("label"), F.concat(F.lit("x"), "id").alias("name"), F.lit(1).alias("status"), F.col("id").alias("ord"))
    increment(spark, base, delta, spark.createDataFrame([], ED))
    assert fold_layers(spark, base).parts["buckets"] == "8"
    index = read_graph(spark, base).names
    assert len(index.folders) == 1 and index.all_rows().count() == 140 and len(index.ids(["x5", "n40"])) == 2


# --------------------------------------------------------------------------- states in parts
def _grow(spark, folder, parts, ids, part_rows):
    delta = ids.select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("value"))
    change = merge_into_parts(spark, parts, ["key"], delta, delta.schema, lambda s, d: s.join(d.select("key"), "key", "left_anti").unionByName(d),
                              folder, part_rows)
    return {p: f for p, f in parts.items() if p not in change["drop"]} | change["parts"], change


def test_parts_grow_with_the_state(spark, scratch_dir):
    parts, _ = _grow(spark, f"{scratch_dir}/0", {}, spark.range(100), 100)
    assert set(parts) == {"p"}
    parts, _ = _grow(spark, f"{scratch_dir}/1", parts, spark.range(5000), 100)
    assert 50 <= len(parts) <= 128  # 50 times the rows, some 50 times the parts
    held = [int(f.rsplit("|", 1)[1]) for f in parts.values()]
    assert sum(held) == 5000 and max(held) <= 200
    prefixes = sorted(p[1:] for p in parts)
    assert sum(2.0 ** -len(p) for p in prefixes) == 1.0  # they cover every hash, once
    more, change = _grow(spark, f"{scratch_dir}/2", parts, spark.range(5000, 5002), 100)
    assert 1 <= len(change["reads"]) <= 2 and {p for p in parts if more.get(p) != parts[p]} == set(change["reads"])
    got = read_parts(spark, more)
    assert got.count() == got.select("key").distinct().count() == 5002


def test_children():
    assert children("p", 100, 100) == ["p"] and children("p01", 101, 100) == ["p010", "p011"]
    assert len(children("p", 10 ** 6, 1000)) == 1024


def test_a_part_is_written_by_several_tasks(spark, scratch_dir):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be one task's
    try:
        parts, _ = _grow(spark, f"{scratch_dir}/0", {}, spark.range(2000), 5000)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = [f for f in os.listdir(parts["p"].rsplit("|", 1)[0]) if f.endswith(".parquet")]
    assert len(files) > 1


def test_small_bounds_do_not_multiply_folders(spark, scratch_dir, monkeypatch):
    assert buckets_for(2_000_000, 200) == 256 and buckets_for(2_000_000, 10) == 256 and buckets_for(10 ** 9) == 2048
    monkeypatch.setattr("edgeloom.sinks.parts.FEW_PARTS", 8)
    base = os.path.join(scratch_dir, "g")
    g = write_graph(spark, base, *big_graph(spark, 4000), part_ids=5, bucket_names=5)
    assert sum(k.startswith("vertices/") for k in g.parts) <= 9 and int(g.parts["buckets"]) <= 8
    v, e = big_graph(spark, 4000)
    read = read_graph(spark, base)
    assert rows(read.vertices) == rows(v) and rows(read.edges) == rows(e.distinct()) and len(read.names.ids(["n7", "n4000"])) == 2
    parts, _ = _grow(spark, f"{scratch_dir}/0", {}, spark.range(2000), 10)
    assert len(parts) <= 16
    parts, _ = _grow(spark, f"{scratch_dir}/1", parts, spark.range(1000, 3000), 10)
    assert len(parts) <= 32 and read_parts(spark, parts).count() == 3000


def test_a_file_of_the_index_has_a_filter_of_its_size(spark, scratch_dir):
    base = os.path.join(scratch_dir, "g")
    first = write_graph(spark, base, *big_graph(spark, 2000), bucket_names=100)
    layer = increment(spark, base, spark.createDataFrame([("MOBILE", "new", 1, 1)], VD), spark.createDataFrame([], ED))
    for path in (first.path, layer.path):  # unsized, every filter has 1 MB
        sizes = [os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(f"{path}/names") for f in fs if f.endswith(".parquet")]
        assert sizes and max(sizes) < 10_000
