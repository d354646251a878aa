"""Adjacency records.

One record per vertex: ``id,LABEL,props<TAB>in-edges<TAB>out-edges`` where
each edge prints as ``LABEL,otherId`` (CALL adds ``,mgm``, empty when
null) and edges of a direction are joined with ``|``, sorted by
(label, other id, text).

Instead of a chain of per-label cogroups, all edges are turned into
half-edges in one pass, as fixed-width rows, and meet their vertex in one
aggregation by id; text is printed after that shuffle. So the half-edges of
an ordinary vertex are shuffled once, however its neighbours' ids spread.

A hub (degree above ``hub_degree``, found by a map-side combined count) is
cut by its own neighbours instead: its half-edges are collapsed to one row
for each set of copies, range-partitioned by (id, label, neighbour), which
gives a hub as many partitions as its degree asks for, and printed there.
The edges are read for the degrees, for the ordinary vertices and for the hubs; so they are stored once, and
what they are made of runs once. Only the finished parts of a hub meet in its row. Where the cut lies does not
show in the lines. A single line, like any row or string, ends at 2 GB;
``hub_parts`` gives a hub's parts as rows for loaders that take more.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import blank_to_null, field, java_split, join_fields, null_to_empty, parse_int, parse_long
from ..schema import (CALL, DEVICE, DEVICE_COLUMNS, EDGE_ENDPOINTS, EDGE_SEP, FIELD_SEP, MOBILE,
                      MOBILE_COLUMNS, MOBILE_INT_COLUMNS, SECTION_SEP, WIDE_VERTEX_COLUMNS, WIFI)
from ..session import freeze

DEFAULT_HUB_DEGREE = 65536
#: hubs are broadcast, so the degree that makes a hub rises with the edges: there are never more than this
MAX_HUBS = 1_000_000
#: half-edges that a task of a fold sorts and prints, where the number of edges is known: some 250 MB in memory
HALVES_OF_A_TASK = 1_000_000

# Edge labels ranked alphabetically: sorting by rank sorts by label text.
_LABEL_RANK = {label: i for i, label in enumerate(sorted(EDGE_ENDPOINTS))}
_RANK_LABEL = {i: label for label, i in _LABEL_RANK.items()}


def _lit_map(d: dict) -> Column:
    pairs = []
    for k, v in d.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.create_map(*pairs)


def vertex_records(vertices_by_label: dict[str, DataFrame]) -> DataFrame:
    """U3 + G2 (vertex part): (id, label, props, error) with props printed per label.

    MOBILE prints its 11 staged columns, DEVICE and WIFI their 3; nulls
    print as ''. ``error`` says why a line of the vertex could not be read
    back as it was: no name, a separator or line break inside a value, or a
    value of blanks (which reads back as absent).
    """
    parts = []
    for label, v in vertices_by_label.items():
        cols = MOBILE_COLUMNS if label == MOBILE else DEVICE_COLUMNS
        value = [F.col(c).cast("string") for c in cols]
        broken = reduce(lambda a, b: a | b, [F.coalesce(c.rlike(f"[{FIELD_SEP}{SECTION_SEP}\n\r]"), F.lit(False)) for c in value])
        blank = reduce(lambda a, b: a | b, [
            F.coalesce((F.length(c) > 0) & (F.length(F.trim(c)) == 0), F.lit(False))
            for n, c in zip(cols, value, strict=True) if n not in ("name", "nm_pass", "nm_sha1")])
        error = (F.when(F.col("name").isNull(), F.lit("no name")).when(broken, F.lit("separator in a value"))
                 .when(blank, F.lit("blank value")))
        parts.append(v.select("id", F.lit(label).alias("label"), join_fields(*cols, sep=FIELD_SEP).alias("props"),
                              error.alias("error")))
    return reduce(DataFrame.unionByName, parts)


def half_edges(edges: DataFrame, in_edges: DataFrame | None = None) -> DataFrame:
    """Each edge once from each end, in one pass: (id, slot, other, mgm).

    ``slot`` = 2 * label rank + (1 for the out side): a small int, so the
    shuffle keys below are all fixed-width. Labels outside the schema have
    no endpoint label and are dropped. ``in_edges``: the in sides are made of these, and only the out sides of ``edges``.
    """
    if in_edges is not None:
        return _sides(edges, ("out",)).unionByName(_sides(in_edges, ("in",)))
    return _sides(edges, ("out", "in"))


def _sides(edges: DataFrame, which: tuple[str, ...]) -> DataFrame:
    mgm = F.col("mgm") if "mgm" in edges.columns else F.lit(None).cast("int")
    rank = F.element_at(_lit_map(_LABEL_RANK), F.col("label"))
    out = F.struct(F.col("start_id").alias("id"), (rank * 2 + 1).alias("slot"), F.col("end_id").alias("other"),
                   mgm.alias("mgm"))
    inn = F.struct(F.col("end_id").alias("id"), (rank * 2).alias("slot"), F.col("start_id").alias("other"),
                   mgm.alias("mgm"))
    return edges.where(rank.isNotNull()).select(F.inline(F.array(*({"out": out, "in": inn}[w] for w in which))))


def _side_label() -> Column:
    """Label of the vertex that a half-edge of ``slot`` lands on."""
    return F.element_at(_lit_map({r * 2 + out: EDGE_ENDPOINTS[lab][1 - out] for lab, r in _LABEL_RANK.items()
                                  for out in (0, 1)}), F.col("slot"))


def _entry(slot: Column, other: Column, mgm: Column) -> Column:
    label = F.element_at(_lit_map(_RANK_LABEL), F.shiftright(slot, 1))
    tail = F.when(label == CALL, F.concat(F.lit(FIELD_SEP), null_to_empty(mgm))).otherwise(F.lit(""))
    return F.concat(label, F.lit(FIELD_SEP), other.cast("string"), tail)


def stored_edges(edges: DataFrame, stored: bool) -> DataFrame:
    """The columns of ``edges`` that a fold reads, as a table (``stored``: they are one already).

    The table is sorted by end within its parts, so that its half-edges are shuffled with one id of two in runs,
    which compress well, whatever join the edges come from.
    """
    cols = edges.select("label", "start_id", "end_id", *(["mgm"] if "mgm" in edges.columns else []))
    return cols if stored else freeze(cols.sortWithinPartitions("end_id"), "fold-edges")


def hub_ids(edges: DataFrame, hub_degree: int = DEFAULT_HUB_DEGREE, in_edges: DataFrame | None = None,
            n_edges: int | None = None) -> DataFrame:
    """(id) of the vertices with more half-edges than ``hub_degree``, at most ``MAX_HUBS`` of them.

    With E edges there are 2E half-edges, and fewer than 2E / d vertices with more than d; so d is raised
    to 2E / MAX_HUBS where that is more. ``n_edges``: E or more, where it is known and need not be counted.
    """
    total = edges.select((F.count(F.lit(1)) * 2 / MAX_HUBS).alias("d")).scalar() if n_edges is None else F.lit(2 * n_edges / MAX_HUBS)
    return (half_edges(edges, in_edges).groupBy("id").agg(F.count(F.lit(1)).alias("degree"))
            .where(F.col("degree") > F.greatest(F.lit(float(hub_degree)), total)).select("id"))


def hub_parts(edges: DataFrame, hubs: DataFrame, in_edges: DataFrame | None = None) -> DataFrame:
    """(id, vlabel, slot, part, text): the entries of hub vertices in ordered parts.

    ``hubs`` is broadcast (bounded, see ``hub_ids``). Copies of an edge are one row until they are printed.
    """
    rows = half_edges(edges, in_edges).join(F.broadcast(hubs), "id", "left_semi")
    counted = rows.groupBy("id", "slot", "other", "mgm").agg(F.count(F.lit(1)).alias("n"))
    ranged = counted.repartitionByRange("id", "slot", "other").withColumn("part", F.spark_partition_id())
    entry = F.struct("other", _entry(F.col("slot"), F.col("other"), F.col("mgm")).alias("entry"), "n")
    texts = F.flatten(F.transform("items", lambda x: F.array_repeat(x["entry"], x["n"].cast("int"))))
    return (ranged.groupBy("id", "slot", "part").agg(F.sort_array(F.collect_list(entry)).alias("items"))
            .select("id", _side_label().alias("vlabel"), "slot", "part", F.array_join(texts, EDGE_SEP).alias("text")))


def build_adjacency(vertices: DataFrame, edges: DataFrame, hub_degree: int = DEFAULT_HUB_DEGREE,
                    edges_stored: bool = False, in_edges: DataFrame | None = None, n_edges: int | None = None,
                    share: float = 1.0) -> DataFrame:
    """(id, label, props, error, in_edges, out_edges) per vertex.

    ``vertices``: (id, label, props[, error]) as from ``vertex_records``;
    ``edges``: (label, start_id, end_id[, mgm]). An edge half lands on the
    vertex of its endpoint label (CALL: MOBILE both ends; USE: MOBILE ->
    DEVICE; HAS: DEVICE -> MOBILE; USE_WIFI: MOBILE -> WIFI). Halves whose
    vertex is missing are left out (``missing_halves`` counts them); of
    several vertex rows with one (id, label) the smallest props text is kept. ``edges_stored``: the edges are
    read from a table already and are not stored again.

    ``in_edges``: the edges as laid out by end_id, where both layouts are there. Then the out sides come from
    ``edges`` and the in sides from these, each in runs of their vertex, which makes their shuffle about half as large.
    ``n_edges``: how many edges there are at most, if known, of which about a ``share`` is folded. Half-edges in runs are so
    small when shuffled that tasks cut by bytes hold too many for their memory; so they are cut by number (``HALVES_OF_A_TASK``).
    """
    edges = stored_edges(edges, edges_stored)
    in_edges = None if in_edges is None else stored_edges(in_edges, edges_stored)
    hubs = hub_ids(edges, hub_degree, in_edges, n_edges)
    half = (half_edges(edges, in_edges).join(F.broadcast(hubs), "id", "left_anti")
            .select("id", _side_label().alias("vlabel"), "slot", "other", "mgm"))
    # a finished part of a hub takes the place of an entry; a vertex has entries or parts, never both
    parts = hub_parts(edges, hubs, in_edges).select("id", "vlabel", "slot", F.col("part").cast("bigint").alias("other"), "text")
    error = F.col("error") if "error" in vertices.columns else F.lit(None).cast("string")
    rows = vertices.select("id", F.col("label").alias("vlabel"), F.struct("props", error.alias("error")).alias("vertex"))
    rows = rows.unionByName(half, allowMissingColumns=True).unionByName(parts, allowMissingColumns=True)
    # shuffled as they are and printed as columns behind it: nothing is collected before, where few halves of a vertex meet
    tasks = int(2 * (n_edges or 0) * share) // HALVES_OF_A_TASK
    few = (max(tasks, rows.sparkSession.sparkContext.defaultParallelism),) if tasks > 1 else ()
    rows = rows.repartition(*few, "id", "vlabel").withColumn("text", F.coalesce("text", _entry(F.col("slot"), F.col("other"), F.col("mgm"))))
    entry = F.struct("slot", "other", "text")
    side = {name: F.sort_array(F.collect_list(F.when(F.col("slot") % 2 == out, entry))) for name, out in (("in", 0), ("out", 1))}
    adj = (rows.groupBy("id", "vlabel").agg(F.min("vertex").alias("vertex"), *(c.alias(name) for name, c in side.items()))
           .where(F.col("vertex").isNotNull()))
    return adj.select("id", F.col("vlabel").alias("label"), "vertex.props", "vertex.error",
                      *(F.array_join(F.col(f"{name}.text"), EDGE_SEP).alias(f"{name}_edges") for name in side))


def missing_halves(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(label, dir, n): half-edges whose vertex is not among ``vertices`` (id, label), which a fold leaves out."""
    half = half_edges(edges).select("id", _side_label().alias("vlabel"), "slot")
    lost = half.join(vertices.select("id", F.col("label").alias("vlabel")), ["id", "vlabel"], "left_anti")
    return lost.groupBy(F.element_at(_lit_map(_RANK_LABEL), F.shiftright("slot", 1)).alias("label"),
                        F.when(F.col("slot") % 2 == 1, "out").otherwise("in").alias("dir")
                        ).agg(F.count(F.lit(1)).alias("n"))


def encode_checked(adj: DataFrame) -> DataFrame:
    """(id, label, line, error): a line ``id,LABEL,props<TAB>in<TAB>out``, or the reason why there is none."""
    line = F.concat(F.col("id").cast("string"), F.lit(FIELD_SEP), F.col("label"), F.lit(FIELD_SEP), F.col("props"),
                    F.lit(SECTION_SEP), F.col("in_edges"), F.lit(SECTION_SEP), F.col("out_edges"))
    return adj.select("id", "label", F.when(F.col("error").isNull(), line).alias("line"), "error")


def encode_adjacency(adj: DataFrame) -> DataFrame:
    """(id, label, line) of every vertex whose line reads back as the same values."""
    return encode_checked(adj).where(F.col("error").isNull()).select("id", "label", "line")


def encode_rejects(adj: DataFrame) -> DataFrame:
    """(id, label, error) of the vertices that ``encode_adjacency`` leaves out."""
    return encode_checked(adj).where(F.col("error").isNotNull()).select("id", "label", "error")


# --------------------------------------------------------------------------- decode
def _sections(lines: DataFrame) -> DataFrame:
    line = F.col("value") if "value" in lines.columns else F.col(lines.columns[0])
    s = F.split(line, SECTION_SEP, 3)
    head = F.split(field(s, 0), FIELD_SEP, 3)
    return lines.select(
        parse_long(field(head, 0)).alias("id"),
        field(head, 1).alias("label"),
        field(head, 2).alias("props"),
        field(s, 1).alias("in_text"),
        field(s, 2).alias("out_text"),
    )


def decode_vertices(lines: DataFrame, strict: bool = True) -> DataFrame:
    """G3 (vertices): wide vertex rows (id, label, all properties) from adjacency lines.

    name, nm_pass and nm_sha1 are kept as printed; every other property is
    set only when non-blank (integers parsed). An unknown label fails the
    job when ``strict``; otherwise the line is skipped.
    """
    s = _sections(lines)
    label = F.col("label")
    if strict:
        known = label.isin(MOBILE, DEVICE, WIFI)
        s = s.withColumn("label", F.when(known, label).otherwise(
            F.raise_error(F.concat(F.lit("Unexpected vertex label: "), F.coalesce(label, F.lit("null"))))))
    else:
        s = s.where(label.isin(MOBILE, DEVICE, WIFI))
    mp = F.split("props", FIELD_SEP, len(MOBILE_COLUMNS))
    dp = F.split("props", FIELD_SEP, len(DEVICE_COLUMNS))
    is_m = F.col("label") == MOBILE
    cols = []
    for c in WIDE_VERTEX_COLUMNS:
        m_val = field(mp, MOBILE_COLUMNS.index(c)) if c in MOBILE_COLUMNS else None
        d_val = field(dp, DEVICE_COLUMNS.index(c)) if c in DEVICE_COLUMNS else None
        if c not in ("name", "nm_pass", "nm_sha1"):
            m_val = None if m_val is None else blank_to_null(m_val)
            d_val = None if d_val is None else blank_to_null(d_val)
        if c in MOBILE_INT_COLUMNS:
            m_val = parse_int(m_val)
        if m_val is not None and d_val is not None:
            v = F.when(is_m, m_val).otherwise(d_val)
        elif m_val is not None:
            v = F.when(is_m, m_val)
        else:
            v = F.when(~is_m, d_val)
        cols.append(v.alias(c))
    return s.select("id", "label", *cols)


def decode_edges(lines: DataFrame, side: str = "out") -> DataFrame:
    """G3 (edges): (label, start_id, end_id, mgm) from the out-edges of each line.

    Every edge appears once as an out-edge of its start vertex, so the
    out side alone rebuilds the edge set. Empty entries are skipped; an
    entry of two parts has no mgm, a blank mgm is dropped.
    """
    s = _sections(lines)
    text = "out_text" if side == "out" else "in_text"
    e = s.select("id", F.explode(F.split(F.col(text), r"\|")).alias("entry")).where(F.length("entry") > 0)
    parts = java_split("entry", FIELD_SEP)
    e = e.select("id", parts.alias("p"))
    other = parse_long(field("p", 1))
    mgm = parse_int(blank_to_null(F.when(F.size("p") > 2, field("p", 2))))
    lbl = field("p", 0)
    if side == "out":
        return e.select(lbl.alias("label"), F.col("id").alias("start_id"), other.alias("end_id"), mgm.alias("mgm"))
    return e.select(lbl.alias("label"), other.alias("start_id"), F.col("id").alias("end_id"), mgm.alias("mgm"))
