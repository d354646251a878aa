"""Table and text sinks written to a scratch folder and read back."""

import os

import pytest
from pyspark.sql import functions as F

from edgeloom.sinks.tables import (create_table_as, insert_overwrite, read_in_edges, read_snapshot, replace_table,
                                   write_snapshot)
from edgeloom.sinks.text import (export_edges, export_edges_csv, export_vertices, write_adjacency_text,
                                 write_csv, write_lines)
from edgeloom.sources.tables import read_table, rows_to_df
from edgeloom.sources.text import ingest_call_edges, ingest_vertices, read_lines
from edgeloom.operators.stage import stage_device
from edgeloom.schema import DEVICE_SCHEMA


def test_tables_ctas_replace_overwrite(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, name string")
    spark.sql("drop table if exists el_t1")
    create_table_as(df, "el_t1")
    with pytest.raises(Exception):
        create_table_as(df, "el_t1")
    replace_table(df.where("id = 1"), "el_t1")
    assert read_table(spark, "el_t1").count() == 1
    # overwrite a table with a query that reads it
    t = spark.table("el_t1")
    insert_overwrite(t.select((F.col("id") + 10).alias("id"), "name"), "el_t1")
    assert [r.id for r in spark.table("el_t1").collect()] == [11]
    spark.sql("drop table if exists el_t2")
    replace_table(df, "el_t2", bucket_by=("id",), buckets=4)
    assert spark.table("el_t2").count() == 2


def test_text_round_trips(spark, scratch_dir):
    dev = rows_to_df(spark, [("FP1", None, "false"), ("FP2", "true", None)], DEVICE_SCHEMA).withColumn("k", F.lit(7))
    lines = export_vertices(dev, "DEVICE")
    assert sorted(r.line for r in lines.collect()) == ['device[10.7]{"name":"FP1","is_white":"false"}',
                                                       'device[10.7]{"name":"FP2","is_exception":"true"}']
    path = os.path.join(scratch_dir, "dev")
    write_lines(lines, path)
    back = stage_device(ingest_vertices(read_lines(spark, path)), "DEVICE")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, dev.drop("k").collect()))

    calls = spark.createDataFrame([("a", "b", 1), ("a", "c", None)], "start_name string, end_name string, mgm int")
    el = export_edges(calls, "CALL")
    assert sorted(r.line for r in el.collect()) == ['"a","CALL","b",1', '"a","CALL","c",\\N']
    p2 = os.path.join(scratch_dir, "call")
    write_lines(el, p2)
    assert sorted(map(tuple, ingest_call_edges(read_lines(spark, p2)).collect())) == sorted(map(tuple, calls.collect()))
    p3 = os.path.join(scratch_dir, "call_csv")
    export_edges_csv(calls, "CALL", p3)
    assert sorted(map(tuple, ingest_call_edges(read_lines(spark, p3)).collect())) == sorted(map(tuple, calls.collect()))


def test_csv_and_adjacency_text(spark, scratch_dir):
    df = spark.createDataFrame([("a", ""), ("b", None)], "k string, v string").repartition(2)
    p = os.path.join(scratch_dir, "csv")
    write_csv(df, p)
    parts = [open(os.path.join(p, f)).read().splitlines() for f in os.listdir(p) if f.endswith(".csv")]
    assert all(part[0] == "k,v" for part in parts)
    assert sorted(line for part in parts for line in part[1:]) == ['a,""', "b,"]
    adj = spark.createDataFrame([(1, "MOBILE", "1,MOBILE,x\t\t")], "id bigint, label string, line string")
    pa = os.path.join(scratch_dir, "adj")
    write_adjacency_text(adj, pa)
    assert [r.value for r in spark.read.text(pa).collect()] == ["1,MOBILE,x\t\t"]


def test_snapshot(spark, scratch_dir):
    v = spark.createDataFrame([(2, "MOBILE", "b"), (1, "MOBILE", "a")], "id bigint, label string, name string")
    e = spark.createDataFrame([("CALL", 2, 1, None)], "label string, start_id bigint, end_id bigint, mgm int")
    write_snapshot(v, e, os.path.join(scratch_dir, "snap"))
    v2, e2 = read_snapshot(spark, os.path.join(scratch_dir, "snap"))
    assert v2.count() == 2 and e2.collect()[0].start_id == 2
    assert read_in_edges(spark, os.path.join(scratch_dir, "snap")).collect() == e.collect()
