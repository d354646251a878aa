"""Dense ids equal a global row_number over names, for any partition count."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from edgeloom.operators.ids import assign_dense_ids, attach_ids, number_rows, union_names


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_dense_ids_match_row_number(spark, parts):
    names = spark.range(0, 2000).select(F.concat(F.lit("n"), (F.col("id") * 7919 % 2003).cast("string")).alias("name"))
    names = names.union(names.limit(50)).union(spark.createDataFrame([(None,)], "name string"))
    got = sorted(tuple(r) for r in assign_dense_ids(names, num_partitions=parts).collect())
    want = names.where("name is not null").distinct().select(
        F.row_number().over(Window.orderBy("name")).cast("bigint").alias("id"), "name")
    assert got == sorted(tuple(r) for r in want.collect())
    assert [r[0] for r in got] == list(range(1, len(got) + 1))


def test_union_attach_and_sample(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "name string, v int")
    b = spark.createDataFrame([("y",), ("z",), (None,)], "name string")
    names = union_names(a, b)
    assert sorted(r.name for r in names.collect()) == ["x", "y", "z"]
    ids = assign_dense_ids(names)
    assert sorted(tuple(r) for r in attach_ids(a, ids).collect()) == [(1, "x", 1), (2, "y", 2)]
    s = number_rows(names, 2)
    assert [tuple(r) for r in s.orderBy("rowid").collect()] == [(1, "x"), (2, "y")]
