"""Connected components as a DataFrame loop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import written


def components(edges: DataFrame, files: int | None = None) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the smallest node it can reach.

    Each round takes the smallest label among a node and its neighbours, then the label of that label
    (pointer jumping), so long chains shrink by halves. Rounds are stored tables; a node with very many
    neighbours only ever contributes to minima, which are combined before the shuffle. ``files``: of each table, at most.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges", files=files)
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("component")),
                     "labels", files=files)
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("near"))
        step = (labels.join(near, labels["node"] == near["a"])
                .select("node", F.least("component", "near").alias("component"), F.col("component").alias("was")))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("jump"))
        new = written(step.join(jump, "component", "left").select(
            "node", F.least("component", F.coalesce("jump", "component")).alias("component"), "was"), "labels", files=files)
        if new.where("component <> was").isEmpty():
            return new.select("node", "component")
        labels = new.select("node", "component")
