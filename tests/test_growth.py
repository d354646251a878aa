"""The load's joins, folds and snapshots on plans that large tables get: what is shuffled, sorted and stored, and the same rows."""

import os
import random

import pytest
from pyspark.sql import functions as F

from edgeloom.operators import adjacency, resolve
from edgeloom.plans import fixtures as fx
from edgeloom.plans import q_round_trip
from edgeloom.plans.pipeline import load_graph
from edgeloom.sinks import tables

from test_plans import plan

_TABLES = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_size int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_returnflag string",
}


def _rows():
    rnd = random.Random(7)
    name = "Customer#{:09d}".format
    customers = [(k, name(k), k % 25, float(k - 5), "M") for k in range(20)]
    customers += [(3, name(3), 3, -1.0, "again"), (20, None, 1, 1.0, "M"), (None, name(21), 1, 1.0, "M")]
    orders = [(k, rnd.randrange(22), rnd.choice("FPO")) for k in range(120)] + [(5, 6, "F"), (None, 1, "P"), (121, None, "O")]
    lines = [(rnd.randrange(125), rnd.randrange(32), rnd.randrange(6), rnd.choice(["R", "A", None])) for _ in range(400)]
    lines += [lines[0], (None, 1, 1, "R"), (2, None, None, "R"), (2, 50, 1, "R"), (2, 50, 1, "R")]
    return {"customer": customers, "supplier": [(k, f"Supplier#{k:09d}", k, float(k - 2)) for k in range(5)] + [(2, None, 1, 1.0)],
            "part": [(k, k % 50) for k in range(30)] + [(4, 1), (50, 50)], "orders": orders, "lineitem": lines}


@pytest.fixture()
def own(spark, scratch_dir):
    rows = _rows()
    for name, schema in _TABLES.items():
        spark.createDataFrame(rows[name], schema).write.parquet(os.path.join(scratch_dir, f"{name}.parquet"))
    return scratch_dir, rows


@pytest.fixture()
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def _expected(rows):
    """USE, USE_WIFI and HAS as sets, by loops over the rows."""
    device = [(k, f"Supplier#{k // 50:09d}" if k % 50 == 0 else f"FP{k}") for k, _ in rows["part"]]
    use, wifi, has = set(), set(), set()
    for lo, lp, ls, flag in rows["lineitem"]:
        who = [c[1] for o in rows["orders"] if o[0] == lo and lo is not None for c in rows["customer"] if c[0] == o[1] and c[0] is not None]
        for w in who:
            named = {d for k, d in device if k == lp}
            use |= {(w, d) for d in named}
            has |= {(d, w) for d in named if flag == "R"}
            wifi |= {(w, s[1]) for s in rows["supplier"] if s[0] == ls}
    return {"USE": use, "USE_WIFI": wifi, "HAS": has}


def test_order_lines_are_joined_once_and_stored_for_three_labels(spark, own, monkeypatch):
    sf, rows = own
    made, freeze = [], fx.freeze
    monkeypatch.setattr(fx, "freeze", lambda df, name: (made.append(name), freeze(df, name))[1])
    staged = fx.staged_edges(spark, sf)
    alone = {"USE": fx.use(spark, sf), "USE_WIFI": fx.use_wifi(spark, sf), "HAS": fx.has(spark, sf)}
    assert made == ["order-lines"]
    for label, want in _expected(rows).items():
        for e in (staged[label], alone[label]):
            got = [tuple(r) for r in e.select("start_name", "end_name").collect()]
            assert len(got) == len(set(got)) and set(got) == want, label
    assert all(want for want in _expected(rows).values())
    assert "lineitem" not in "".join(plan(staged[label]) for label in alone)


def test_lines_are_shuffled_by_their_order_only(spark, own, no_broadcast):
    p = plan(fx._order_lines(spark, own[0]), "simple")
    assert p.count("Exchange hashpartitioning(l_orderkey") == 1, p
    # the customers meet the orders: below that join there are no lines
    below = p[p.index("hashpartitioning(o_custkey"):]
    assert "l_orderkey" not in below.split("hashpartitioning(c_custkey")[0], p


def test_distinct_edges_meet_their_start_without_another_shuffle(spark, own, no_broadcast):
    ids = spark.createDataFrame([(k + 1, f"Customer#{k:09d}") for k in range(22)] + [(100 + k, f"FP{k}") for k in range(30)], "id bigint, name string")
    p = plan(resolve.resolve_edges(fx.use(spark, own[0]), ids, ids), "simple")
    assert "hashpartitioning(start_name" in p and ", end_name" not in "".join(
        line for line in p.splitlines() if "Exchange hashpartitioning(start_name" in line), p
    # the edges by start, the ids of that side
    assert p.count("Exchange hashpartitioning(start_name") == 2, p


def test_many_ids_are_hashed_and_edges_not_sorted_by_name(spark, own, no_broadcast, monkeypatch):
    sf, _ = own
    got = {}
    for n in (10 ** 9, 1):
        monkeypatch.setattr(resolve, "HASHED_FROM", n)
        e = load_graph(fx.staged_vertices(spark, sf), fx.staged_edges(spark, sf), materialize=True).resolved["USE"]
        got[n] = (plan(e, "simple"), sorted(map(tuple, e.collect())))
    assert got[1][1] == got[10 ** 9][1] != []
    assert got[1][0].count("ShuffledHashJoin") == 2 and "ShuffledHashJoin" not in got[10 ** 9][0]


def _mixed(spark):
    rnd = random.Random(3)
    rows = [("CALL", rnd.randrange(50), rnd.randrange(50), None) for _ in range(300)]
    return spark.createDataFrame(rows, "label string, start_id bigint, end_id bigint, mgm int").coalesce(1), rows


def test_a_fold_stores_its_edges_in_runs_of_their_ends(spark):
    edges, rows = _mixed(spark)
    got = [tuple(r) for r in adjacency.stored_edges(edges, False).collect()]
    assert [r[2] for r in got] == sorted(r[2] for r in rows) and sorted(got, key=str) == sorted(rows, key=str)


def test_a_snapshot_stores_its_edges_in_runs_of_their_ends(spark, scratch_dir, monkeypatch):
    kept, freeze = {}, tables.freeze
    monkeypatch.setattr(tables, "freeze", lambda df, name: kept.setdefault(name, freeze(df, name)))
    edges, rows = _mixed(spark)
    tables.write_snapshot(spark.range(50).select("id", F.lit("MOBILE").alias("label")), edges, f"{scratch_dir}/snap", vertices_stored=True)
    assert list(kept) == ["snapshot-edges"]
    assert [r.end_id for r in kept["snapshot-edges"].collect()] == sorted(r[2] for r in rows)


def test_round_trip_snapshot_does_not_store_stored_vertices_again(spark, own, monkeypatch):
    kept, freeze = [], tables.freeze
    monkeypatch.setattr(tables, "freeze", lambda df, name: (kept.append(name), freeze(df, name))[1])
    sf, _ = own
    got = q_round_trip.q_round_trip_snapshot(spark, sf).collect()
    assert kept == ["snapshot-edges"]
    sides = {s: sorted([tuple(r)[1:] for r in got if r.side == s], key=str) for s in ("in", "out")}
    assert sides["in"] == sides["out"] != []
