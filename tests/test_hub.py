"""A hub holding over a third of all edges: its record is built from many parts and is exact."""

from pyspark.sql import functions as F

from edgeloom.operators.adjacency import build_adjacency, encode_adjacency, hub_ids


def test_hub_line_is_exact(spark):
    n = 30000
    v = spark.range(1, n + 1).select(F.col("id"), F.lit("MOBILE").alias("label"), F.concat(F.lit("m"), F.col("id").cast("string")).alias("props"))
    hub = spark.range(2, n + 1).select(F.lit("CALL").alias("label"), F.lit(1).cast("bigint").alias("start_id"),
                                       F.col("id").alias("end_id"), (F.col("id") % 3).cast("int").alias("mgm"))
    ring = spark.range(2, n + 1).select(F.lit("CALL").alias("label"), F.col("id").alias("start_id"),
                                        (F.col("id") % (n - 1) + 2).alias("end_id"), F.lit(None).cast("int").alias("mgm"))
    copies = spark.range(0, 5).select(F.lit("CALL").alias("label"), F.lit(1).cast("bigint").alias("start_id"),
                                      F.lit(7).cast("bigint").alias("end_id"), F.lit(1).cast("int").alias("mgm"))
    edges = hub.unionByName(ring).unionByName(copies)
    lines = encode_adjacency(build_adjacency(v, edges, hub_degree=1024))
    got = lines.where("id = 1").first().line
    out_entries = []
    for other in range(2, n + 1):
        out_entries.append(f"CALL,{other},{other % 3}")
        if other == 7:
            out_entries += ["CALL,7,1"] * 5  # the five copies sort right after CALL,7,1
    assert got == "1,MOBILE,m1\t\t" + "|".join(sorted(out_entries, key=lambda s: (int(s.split(",")[1]), s)))
    assert lines.count() == n
    assert [r.id for r in hub_ids(edges, 1024).collect()] == [1]
    whole = encode_adjacency(build_adjacency(v, edges))  # the hub is an ordinary vertex at the default degree
    assert sorted(r.line for r in lines.collect()) == sorted(r.line for r in whole.collect())
