"""Append and upsert (G4-G7, A5, J6, J9) against table snapshots.

There is no graph server: the state is a pair of snapshots (vertices,
edges) and a delta is folded in by a join, producing the next snapshot.

* append = union (no existence test), as the direct import does;
* upsert = collapse the delta per key (last value by an explicit ``ord``,
  so the result does not depend on partition order), then one full outer
  join with the state on the key. Keys are unique on both sides after the
  collapse, so the join cannot fan out; the collapse itself is a partial
  (map-side) aggregation, so a hot key costs one row per task.
* one full outer join is the plan at every size. The big side is not
  shuffled when the state is stored bucketed by the key
  (``sinks.tables.replace_table``, with as many buckets as the session has
  shuffle partitions or more): then only the collapsed delta moves.
* a key with a null part names no vertex or edge: such delta rows take no
  part in an upsert, and ``nameless`` returns them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import lt_or_missing
from ..functions.scalar import sha1_hex
from ..schema import CALL, MOBILE


# --------------------------------------------------------------------------- append
def with_mobile_digest(attrs: Column, label: Column) -> Column:
    """P3 on an open attribute map: MOBILE vertices get nm_pass and nm_sha1 from name."""
    name = attrs.getItem("name")
    extra = F.create_map(F.lit("nm_pass"), name, F.lit("nm_sha1"), sha1_hex(name))
    return F.when((label == MOBILE) & name.isNotNull(), F.map_concat(attrs, extra)).otherwise(attrs)


def append_vertices(state: DataFrame, delta: DataFrame) -> DataFrame:
    """Every delta record is added with all its properties (no existence test).

    Both sides are open vertices (label, attrs map); ``delta`` may be the
    raw output of ``ingest_vertices`` (blank labels already skipped).
    MOBILE records get the name digest. Status is written as given.
    """
    d = delta.select("label", with_mobile_digest(F.col("attrs"), F.col("label")).alias("attrs"))
    return state.select("label", "attrs").unionByName(d)


def append_edges(state: DataFrame, delta: DataFrame) -> DataFrame:
    """Resolved delta edges are added to the edge snapshot as they are (bag union).

    ``delta`` comes from ``resolve_any_label`` (both ends found by name in
    any label); mgm is kept for CALL edges only.
    """
    mgm = F.when(F.col("label") == CALL, F.col("mgm"))
    cols = ["label", "start_id", "end_id"]
    return state.select(*cols, "mgm").unionByName(delta.select(*cols, mgm.alias("mgm")))


# --------------------------------------------------------------------------- upsert
def _keyed(delta: DataFrame, keys: list[str]) -> DataFrame:
    return delta.dropna("any", subset=keys)


def nameless(delta: DataFrame, keys=("label", "name")) -> DataFrame:
    """The delta rows that an upsert refuses: some part of their key is null."""
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return delta.where(missing)


def collapse_by_key(delta: DataFrame, keys: list[str], ord_col: str = "ord",
                    status_col: str | None = "status") -> DataFrame:
    """Fold several delta rows of one key into one.

    Each property takes its last non-null value by ``ord``; the status
    takes the largest positive value (applying positive statuses one by one
    with "raise only" gives their maximum).
    """
    aggs = []
    for c in delta.columns:
        if c in keys or c == ord_col:
            continue
        if c == status_col:
            aggs.append(F.max(F.when(F.col(c) > 0, F.col(c))).alias(c))
        else:
            aggs.append(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(ord_col))).alias(c))
    return _keyed(delta, keys).groupBy(*keys).agg(*aggs)


def merge_vertices(state: DataFrame, delta: DataFrame, keys=("label", "name"), ord_col: str = "ord",
                   status_col: str = "status") -> DataFrame:
    """G6 (+A5): get-or-create by key; other properties overwritten when given.

    status only rises: merged = greatest(stored, delta when > 0). A delta
    status of 0, negative or absent leaves the stored one alone. MOBILE
    rows keep nm_pass/nm_sha1 derived from the name.
    """
    keys = list(keys)
    d = collapse_by_key(delta, keys, ord_col, status_col if status_col in delta.columns else None)
    s_cols = [c for c in state.columns if c not in keys]
    d_cols = [c for c in d.columns if c not in keys]
    s = state.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in s_cols])
    dd = d.select(*keys, *[F.col(c).alias(f"_d_{c}") for c in d_cols])

    out = [F.col(k) for k in keys]
    for c in s_cols + [c for c in d_cols if c not in s_cols]:
        sc = F.col(f"_s_{c}") if c in s_cols else F.lit(None)
        dc = F.col(f"_d_{c}") if c in d_cols else F.lit(None)
        if c == status_col:
            v = monotone_status(sc, dc)
        elif c == "nm_pass" and "label" in keys:
            v = F.when(F.col("label") == MOBILE, F.col("name")).otherwise(F.coalesce(dc, sc))
        elif c == "nm_sha1" and "label" in keys:
            v = F.when(F.col("label") == MOBILE, sha1_hex("name")).otherwise(F.coalesce(dc, sc))
        else:
            v = F.coalesce(dc, sc)
        out.append(v.alias(c))
    return s.join(dd, keys, "full_outer").select(*out)


def merge_vertex_attrs(state: DataFrame, delta: DataFrame, keys=("label", "name"), ord_col: str = "ord",
                       status_key: str = "status") -> DataFrame:
    """G6 on open vertices: (label, name, attrs map<string,string>) as read from JSON lines.

    Every delta property except name and status overwrites (last value by
    ``ord`` per property); status is applied only when positive and higher
    than the stored one; MOBILE vertices carry nm_pass/nm_sha1. Properties
    are folded per (vertex, property), so a vertex's group holds one row
    per property name, not per delta line.
    """
    keys = list(keys)
    # the delta is read once: every vertex has an entry for its name, which also creates it
    p = _keyed(delta, keys).select(*keys, ord_col, F.explode(F.map_concat(
        F.map_filter("attrs", lambda k, v: k != "name"), F.create_map(F.lit("name"), F.col("name")))).alias("prop", "value"))
    status = F.col("value").try_cast("int")
    last = p.groupBy(*keys, "prop").agg(
        F.max_by("value", F.col(ord_col)).alias("value"), F.max(F.when(status > 0, status)).cast("string").alias("raised"))
    value = F.when(F.col("prop") == status_key, F.col("raised")).otherwise(F.col("value"))
    created = last.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("prop", value.alias("value")))).alias("_d"))
    j = state.select(*keys, F.col("attrs").alias("_s")).join(created, keys, "full_outer")
    empty = F.create_map().cast("map<string,string>")

    def pick(k, old, new):
        raised = F.greatest(old.try_cast("int"), new.try_cast("int")).cast("string")
        return F.when(k == status_key, F.coalesce(raised, old)).otherwise(F.coalesce(new, old))

    merged = F.map_zip_with(F.coalesce("_s", empty), F.coalesce("_d", empty), pick)
    name = F.create_map(F.lit("name"), F.col("name"))
    digest = F.create_map(F.lit("nm_pass"), F.col("name"), F.lit("nm_sha1"), sha1_hex("name"))
    rest = F.map_filter(merged, lambda k, v: ~k.isin("name", "nm_pass", "nm_sha1") & v.isNotNull())
    kept = F.map_filter(merged, lambda k, v: k.isin("nm_pass", "nm_sha1") & v.isNotNull())
    extra = F.when(F.col("label") == MOBILE, digest).otherwise(kept) if "label" in keys else kept
    return j.select(*keys, F.map_concat(name, extra, rest).alias("attrs"))


def monotone_status(stored: Column, delta: Column) -> Column:
    """A5: a status never goes down; only a positive delta can raise it."""
    return F.greatest(stored, F.when(delta > 0, delta))


def status_changes(state: DataFrame, delta: DataFrame, keys=("label", "name"), ord_col: str = "ord",
                   status_col: str = "status") -> DataFrame:
    """F6 view of a merge: keys whose status the delta raises.

    A positive delta status applies when the stored one is lower or absent
    (``lt_or_missing``). Output: keys, old_status, delta_status, status.
    """
    keys = list(keys)
    d = collapse_by_key(delta.select(*keys, status_col, ord_col), keys, ord_col, status_col)
    d = d.where(F.col(status_col).isNotNull()).select(*keys, F.col(status_col).alias("delta_status"))
    s = state.select(*keys, F.col(status_col).alias("old_status"))
    j = d.join(s, keys, "left")
    return (j.where(lt_or_missing("old_status", F.col("delta_status")))
            .select(*keys, "old_status", "delta_status", F.col("delta_status").alias(status_col)))


def merge_edges(state: DataFrame, delta: DataFrame, vertices: DataFrame | None = None,
                keys=("start_name", "label", "end_name"), ord_col: str = "ord", state_folded: bool = False) -> DataFrame:
    """Insert an edge when no edge of that label joins start and end; then
    set mgm when the delta gives one (CALL only).

    ``vertices`` (name): a delta edge is only taken when both of its end
    names exist there (``dangling_edges`` returns the others); None when the
    caller has checked, as ``increment_edges`` does by resolving ids.

    The delta is collapsed to one row per key (last non-null mgm by
    ``ord``) so repeated copies cannot duplicate edges; so is the state,
    unless it is already one row per key (``state_folded``, e.g. the output
    of a previous merge).
    """
    keys = list(keys)

    def fold(df):
        return df.groupBy(*keys).agg(F.max_by("mgm", F.when(F.col("mgm").isNotNull(), F.col(ord_col))).alias("mgm"))

    s = (state.select(*keys, "mgm") if state_folded else fold(state)).withColumnRenamed("mgm", "_s_mgm")
    d = fold(_keyed(delta, keys)).withColumnRenamed("mgm", "_d_mgm")
    if vertices is not None:
        for end in (keys[0], keys[-1]):
            d = vertex_exists(d, vertices, end)
    mgm = F.when(F.col("label") == CALL, F.coalesce("_d_mgm", "_s_mgm"))
    return s.join(d, keys, "full_outer").select(*keys, mgm.alias("mgm"))


def dangling_edges(delta: DataFrame, vertices: DataFrame, keys=("start_name", "label", "end_name")) -> DataFrame:
    """The delta edges ``merge_edges`` refuses: keys and ``missing`` ('start', 'end' or 'both')."""
    start, *_, end = keys
    e = delta.select(*keys)
    for col in (start, end):
        known = vertices.select(F.col("name").alias(col)).where(F.col(col).isNotNull()).distinct()
        e = e.join(known.withColumn(f"_has_{col}", F.lit(True)), col, "left")
    no_start, no_end = F.col(f"_has_{start}").isNull(), F.col(f"_has_{end}").isNull()
    missing = F.when(no_start & no_end, "both").when(no_start, "start").when(no_end, "end")
    return e.select(*keys, missing.alias("missing")).where(F.col("missing").isNotNull())


def edge_between(pairs: DataFrame, edges: DataFrame, keys=("start_name", "label", "end_name")) -> DataFrame:
    """The pairs for which an edge of that label already joins start to end."""
    keys = list(keys)
    return pairs.select(*keys).join(edges.select(*keys), keys, "left_semi")


def vertex_exists(names: DataFrame, vertices: DataFrame, name_col: str = "name") -> DataFrame:
    """The names that exist as a vertex (any label); a semi-join, no row fan-out."""
    return names.join(vertices.select(F.col("name").alias(name_col)), name_col, "left_semi")
