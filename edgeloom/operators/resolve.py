"""Edge resolution (J2): start/end names to ids.

Two inner equi-joins on name; edges with a missing endpoint drop out.
A hub name that carries a large share of edges is a skewed join key: the
id side is unique per name, so AQE's skew-join split (on by default in
``build_session``) divides the hub's edge partition and replicates the one
matching id row. When the id side is small, AQE turns the join into a
broadcast from its measured size. When it is too large for that
(``HASHED_FROM`` vertices), each task hashes its share of the ids, so the
edges are not sorted by names, which have long common beginnings.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import EDGE_ENDPOINTS


#: from so many vertices on a label's ids are too many for a broadcast: their share of the stored vertices, by which
#: the planner decides, is past its default threshold of 10 MB (measured: 4 to 5 bytes an id)
HASHED_FROM = 2_000_000


def _ids(vertices: DataFrame, prefix: str, hashed: bool = False) -> DataFrame:
    ids = vertices.select(F.col("name").alias(f"{prefix}_name"), F.col("id").alias(f"{prefix}_id"))
    return ids.hint("shuffle_hash") if hashed else ids


def resolve_edges(edges: DataFrame, start_vertices: DataFrame, end_vertices: DataFrame, hash_start: bool = False,
                  hash_end: bool = False) -> DataFrame:
    """J2 (strict labels): (start_id, end_id[, mgm]) for edges whose both ends exist.

    ``start_vertices``/``end_vertices`` are id-attached vertex tables of
    the edge label's endpoint labels; mgm is carried when present. ``hash_start``/``hash_end``: this side's ids
    are hashed within each task, for ids known to be too many for a broadcast.
    """
    extra = [c for c in edges.columns if c not in ("start_name", "end_name", "label")]
    j = (edges.join(_ids(start_vertices, "start", hash_start), "start_name")
         .join(_ids(end_vertices, "end", hash_end), "end_name"))
    return j.select("start_id", "end_id", *extra)


def frequent_names(edges: DataFrame, col: str, share: float = 0.01) -> list[str]:
    """Names that may be on more than ``share`` of the edges at one end: a sketch of at most 1 / share entries, one pass."""
    found = edges.where(F.col(col).isNotNull()).stat.freqItems([col], share).first()
    return sorted(found[0] or []) if found else []


def resolve_edges_split(edges: DataFrame, start_vertices: DataFrame, end_vertices: DataFrame, share: float = 0.01,
                        salts: int = 64) -> DataFrame:
    """J2 where names repeat on the id side too: the same rows as ``resolve_edges``.

    The edges of heavy names (``frequent_names``, a bounded list) are dealt out over ``salts`` keys, and the id
    rows of these names are there once for each, so neither many edges nor many vertices of one name meet in
    one task. All other names have one key.
    """
    extra = [c for c in edges.columns if c not in ("start_name", "end_name", "label")]
    out = edges.withColumn("_task", F.spark_partition_id())  # copies of an edge are dealt out by where they are read
    for end, vertices in (("start", start_vertices), ("end", end_vertices)):
        heavy = frequent_names(edges, f"{end}_name", share)
        is_heavy = F.col(f"{end}_name").isin(heavy)
        salt = F.pmod(F.xxhash64("start_name", "end_name", "_task"), F.lit(salts)).cast("int")
        ids = _ids(vertices, end).withColumn("_salt", F.explode(F.when(is_heavy, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
            F.array(F.lit(0)))))
        out = out.withColumn("_salt", F.when(is_heavy, salt).otherwise(F.lit(0))).join(ids, [f"{end}_name", "_salt"]).drop("_salt")
    return out.select("start_id", "end_id", *extra)


def unresolved_edges(edges: DataFrame, start_vertices: DataFrame, end_vertices: DataFrame) -> DataFrame:
    """The edges ``resolve_edges`` drops, each once: (start_name, end_name, missing).

    ``missing`` is 'start' when no start vertex has the name, else 'end'.
    Anti/semi joins only, so repeated vertex names cannot multiply rows.
    """
    s = start_vertices.select(F.col("name").alias("start_name"))
    e = end_vertices.select(F.col("name").alias("end_name"))
    no_start = edges.join(s, "start_name", "left_anti").select("start_name", "end_name", F.lit("start").alias("missing"))
    no_end = (edges.join(s, "start_name", "left_semi").join(e, "end_name", "left_anti")
              .select("start_name", "end_name", F.lit("end").alias("missing")))
    return no_start.unionByName(no_end)


def resolve_any_label(edges: DataFrame, vertices_by_label: dict[str, DataFrame]) -> DataFrame:
    """J2 (any label, G5): resolve both ends by name among vertices of every label.

    Keeps bag semantics: a name present under two labels matches twice.
    Output: (label, start_id, end_id, mgm).
    """
    all_ids = reduce(DataFrame.unionByName, [v.select("id", "name") for v in vertices_by_label.values()])
    mgm = F.col("mgm") if "mgm" in edges.columns else F.lit(None).cast("int")
    e = edges.select("start_name", "label", "end_name", mgm.alias("mgm"))
    j = e.join(_ids(all_ids, "start"), "start_name").join(_ids(all_ids, "end"), "end_name")
    return j.select("label", "start_id", "end_id", "mgm")


def resolve_all(edges_by_label: dict[str, DataFrame], vertices_by_label: dict[str, DataFrame],
                n_vertices: dict[str, int] | None = None) -> dict[str, DataFrame]:
    """Resolve each staged edge table against its label's endpoint tables.

    ``n_vertices``: rows of these tables, where known; it decides how ids are joined, not what is returned.
    """
    hashed = {label for label, n in (n_vertices or {}).items() if n >= HASHED_FROM}
    out = {}
    for label, e in edges_by_label.items():
        src, dst = EDGE_ENDPOINTS[label]
        out[label] = resolve_edges(e, vertices_by_label[src], vertices_by_label[dst], src in hashed, dst in hashed)
    return out


def graph_edges(resolved: dict[str, DataFrame]) -> DataFrame:
    """Union of resolved per-label tables as (label, start_id, end_id, mgm)."""
    parts = []
    for label, r in resolved.items():
        mgm = F.col("mgm") if "mgm" in r.columns else F.lit(None).cast("int")
        parts.append(r.select(F.lit(label).alias("label"), "start_id", "end_id", mgm.alias("mgm")))
    return reduce(DataFrame.unionByName, parts)
