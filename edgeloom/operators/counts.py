"""Maintained counts for the quality reports.

How often each (label, name) and each (label, start_id, end_id) occurs is kept
as a state in parts (``sinks.parts``). An append adds its own counts to the
parts it touches, and the reports read the counts instead of the vertices
and edges. Removed rows are added as negative counts; what reaches 0 goes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NAME_KEYS, EDGE_KEYS = ["name"], ["label", "start_id", "end_id"]
NAME_COUNTS = "label string, name string, n bigint"
EDGE_COUNTS = "label string, start_id bigint, end_id bigint, n bigint"


def name_counts(vertices: DataFrame, sign: int = 1) -> DataFrame:
    """(label, name, n) of vertex rows; null names count under the empty string, as no vertex is named so."""
    name = F.when(F.col("name").isNull(), "").otherwise(F.col("name"))
    return vertices.select("label", name.alias("name")).groupBy("label", "name").agg((F.count(F.lit(1)) * sign).alias("n"))


def edge_counts(edges: DataFrame, sign: int = 1) -> DataFrame:
    """(label, start_id, end_id, n) of edge rows."""
    return edges.groupBy(*EDGE_KEYS).agg((F.count(F.lit(1)) * sign).alias("n"))


def add_counts(state: DataFrame, delta: DataFrame) -> DataFrame:
    """Both counts added up: the ``merge`` of ``sinks.parts.merge_into_parts``."""
    keys = [c for c in state.columns if c != "n"]
    return state.unionByName(delta).groupBy(*keys).agg(F.sum("n").alias("n")).where("n <> 0")


def counted_conflicts(names: DataFrame) -> DataFrame:
    """A2: (name, n_labels) of the names that several labels hold."""
    return (names.where("name <> ''").groupBy("name").agg(F.count(F.lit(1)).alias("n_labels")).where("n_labels > 1"))


def counted_uniqueness(names: DataFrame) -> DataFrame:
    """Q2 by label and over all (label ALL): rows, distinct names, repeated names, rows without a name."""
    total = names.groupBy("name").agg(F.sum("n").alias("n")).select(F.lit("ALL").alias("label"), "name", "n")
    named = F.col("name") != ""
    return names.unionByName(total).groupBy("label").agg(
        F.sum("n").alias("n_rows"), F.count(F.when(named, 1)).alias("n_distinct_names"),
        F.count(F.when(named & (F.col("n") > 1), 1)).alias("n_repeated_names"),
        F.coalesce(F.sum(F.when(~named, F.col("n"))), F.lit(0)).alias("n_null_names"))


def counted_duplicates(edges: DataFrame) -> DataFrame:
    """(label, start_id, end_id, copies) of the edges that occur more than once."""
    return edges.where("n > 1").withColumnRenamed("n", "copies")
