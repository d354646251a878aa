"""Data-quality operators (U2, A2, J3, J4, Q1, Q2, A6) and a hub report.

Names must be unique across labels before ids are assigned (one id per
name). These operators find the conflicts, count the edges they touch and
remove them from the label chosen to give way.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import LABEL_TAGS


def tagged_names(vertices_by_label: dict[str, DataFrame], tags: dict[str, str] | None = None) -> DataFrame:
    """Distinct (name, type) over the labels, type a short tag ('d', 'w', 'm')."""
    tags = tags or LABEL_TAGS
    parts = [v.select("name", F.lit(tags[label]).alias("type")) for label, v in vertices_by_label.items()]
    return reduce(DataFrame.union, parts).distinct()


def conflicting_names(tagged: DataFrame) -> DataFrame:
    """A2: names tagged with more than one type, with the count (group by having count > 1)."""
    return (tagged.groupBy("name").agg(F.count(F.lit(1)).alias("count"))
            .where(F.col("count") > 1))


def conflicts_by_name(vertices_by_label: dict[str, DataFrame], tags: dict[str, str] | None = None) -> DataFrame:
    """U2 + A2 in one aggregation: (name, count) for names under more than one label.

    ``count`` is the number of distinct labels, as over the de-duplicated
    tagged table; the set of tags per name is combined map-side, so a
    name repeated many times inside one label costs one entry per task.
    """
    tags = tags or LABEL_TAGS
    parts = [v.select("name", F.lit(tags[label]).alias("type")) for label, v in vertices_by_label.items()]
    return (reduce(DataFrame.union, parts).groupBy("name")
            .agg(F.size(F.collect_set("type")).cast("bigint").alias("count"))
            .where(F.col("count") > 1))


def remove_conflicting(vertices: DataFrame, conflicts: DataFrame, name_col: str = "name") -> DataFrame:
    """Vertices whose name is not a conflicting name (anti-join)."""
    return vertices.join(conflicts.select(F.col("name").alias(name_col)), name_col, "left_anti")


def count_edges_on(names: DataFrame, edges: DataFrame, edge_col: str = "end_name") -> DataFrame:
    """Number of edges whose ``edge_col`` is one of ``names`` (one row, ``cnt``).

    ``names`` is unique per name (it comes from a group by), so the join
    cannot multiply rows; a semi-join keeps it so even when it is not.
    """
    hit = edges.join(names.select(F.col("name").alias(edge_col)), edge_col, "left_semi")
    return hit.agg(F.count(F.lit(1)).alias("cnt"))


def conflict_report(vertices_by_label: dict[str, DataFrame], edges_by_label: dict[str, DataFrame],
                    tags: dict[str, str] | None = None) -> DataFrame:
    """Q1: each name found under more than one label, with the labels and edge ends touching it.

    Output: name, n_labels, labels (sorted tags joined by ','), n_edge_ends
    (how many edge endpoints, over all edge tables, carry the name).
    """
    tags = tags or LABEL_TAGS
    names = reduce(DataFrame.union, [v.select("name", F.lit(tags[label]).alias("type"), F.lit(0).alias("ends"))
                                     for label, v in vertices_by_label.items()])
    ends = reduce(DataFrame.union, [
        e.select(F.inline(F.array(F.struct(F.col("start_name").alias("name")), F.struct(F.col("end_name").alias("name")))))
        for e in edges_by_label.values()]).select("name", F.lit(None).cast("string").alias("type"), F.lit(1).alias("ends"))
    # names and edge ends meet in one aggregation; each task sends a name once, with its tags and its count
    both = names.union(ends).where(F.col("name").isNotNull()).groupBy("name").agg(
        F.array_sort(F.collect_set("type")).alias("_types"), F.sum("ends").alias("n_edge_ends"))
    return (both.where(F.size("_types") > 1)
            .select("name", F.size("_types").cast("bigint").alias("n_labels"),
                    F.array_join("_types", ",").alias("labels"), "n_edge_ends"))


def uniqueness_report(vertices_by_label: dict[str, DataFrame]) -> DataFrame:
    """Q2: per label and over all labels: rows, distinct names, repeated names, null names, and repeated ids.

    Names and ids must be unique before loading; a non-zero ``n_repeated_names``, ``n_null_names`` or
    ``n_repeated_ids`` blocks the load. ``n_repeated_ids`` counts ids on more than one row (0 for tables
    that have no id yet). Names are grouped once, with a count per label; so are ids.
    """
    labels = [*vertices_by_label, "ALL"]
    rows = reduce(DataFrame.union, [
        v.select(F.lit(label).alias("label"), "name", (F.col("id") if "id" in v.columns else F.lit(None)).cast("bigint").alias("id"))
        for label, v in vertices_by_label.items()])

    def counted(key: str) -> DataFrame:
        per = [F.count(F.lit(1) if label == "ALL" else F.when(F.col("label") == label, 1)).alias(label) for label in labels]
        c = rows.groupBy(key).agg(*per)
        return c.select(key, F.inline(F.array(*[F.struct(F.lit(x).alias("label"), F.col(x).alias("c")) for x in labels])))

    names = counted("name").groupBy("label").agg(
        F.sum("c").cast("bigint").alias("n_rows"),
        F.count(F.when(F.col("name").isNotNull() & (F.col("c") > 0), 1)).alias("n_distinct_names"),
        F.count(F.when(F.col("name").isNotNull() & (F.col("c") > 1), 1)).alias("n_repeated_names"),
        F.coalesce(F.sum(F.when(F.col("name").isNull(), F.col("c"))), F.lit(0)).cast("bigint").alias("n_null_names"))
    ids = counted("id").where(F.col("id").isNotNull()).groupBy("label").agg(
        F.count(F.when(F.col("c") > 1, 1)).alias("n_repeated_ids"))
    return names.join(ids, "label", "left").select(
        *names.columns, F.coalesce("n_repeated_ids", F.lit(0)).cast("bigint").alias("n_repeated_ids"))


def duplicate_names(vertices: DataFrame) -> DataFrame:
    """Q2 after an append: (label, name, copies) for vertices that a label holds more than once.

    ``vertices``: (label, name) or open vertices (label, attrs).
    """
    name = F.col("name") if "name" in vertices.columns else F.col("attrs").getItem("name")
    return (vertices.select("label", name.alias("name")).where(F.col("name").isNotNull())
            .groupBy("label", "name").agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1))


def duplicate_edges(edges: DataFrame, keys=("label", "start_id", "end_id")) -> DataFrame:
    """A6 after an append: the edges that break the one-edge-per-pair rule, with their copies."""
    return distinct_simple_edges(edges, keys).where(F.col("copies") > 1)


def distinct_simple_edges(edges: DataFrame, keys=("label", "start_id", "end_id")) -> DataFrame:
    """One row per (label, start, end) with the number of copies found.

    Edge labels are SIMPLE (at most one edge per pair and label); rows with
    ``copies > 1`` are the duplicates a plain append would create.
    """
    return edges.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))


def degree_report(edges: DataFrame, min_degree: int) -> DataFrame:
    """Vertices whose in- or out-degree (per edge label) reaches ``min_degree``.

    Hubs make the largest adjacency records; this is the check to run
    before a build. Counting is map-side combined, so a hub costs one row
    per task in the shuffle.
    """
    ends = edges.select(F.inline(F.array(
        F.struct(F.col("start_id").alias("id"), F.lit("out").alias("dir"), "label"),
        F.struct(F.col("end_id").alias("id"), F.lit("in").alias("dir"), "label"))))
    return (ends.groupBy("id", "dir", "label").agg(F.count(F.lit(1)).alias("degree"))
            .where(F.col("degree") >= min_degree))
