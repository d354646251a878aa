"""Graphs kept in layers (merge-on-read), so an increment costs what it changes.

The base of a layered graph are three tables cut into parts by id range:
``vertices`` by id, ``edges`` by start_id, ``edges_in`` (the same edges) by
end_id, each in global key order, one row per key; and the name index
(``sinks.names``). An increment adds a *layer*: the upserted rows of the
vertices and edges it touches, whole (edges in one layout), and the index entries of its new names.
Readers lay the layers over the base: of a key the row of the last layer
stands. ``fold_layers`` rewrites the parts that layers touch and drops those
layers; other parts stay in the folders they are in.

What belongs to a version is in its commit (``sinks.versions``): the folder of
each part, the layers, the index folders, the largest id. Increments build on each
other (the loser of a race is made again on the winner's state); a fold changes no
row, so increments published meanwhile stay on top of it.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.idset import IdSet, pack_ids
from ..operators.increment import increment_vertices, resolve_delta, upsert_resolved, vertex_rejects
from ..operators.merge import dangling_edges
from ..session import PACKED, freeze
from .names import BUCKET_NAMES, NameIndex, buckets_for, write_names
from .parts import part_size
from .tables import next_version
from .versions import Commit, current_commit, publish, publish_retrying

#: ids of a part; fewer only up to ``parts.FEW_PARTS`` parts
PART_IDS = 1_000_000
#: table -> (id that places a row, key)
TABLES = {"vertices": ("id", ("id",)), "edges": ("start_id", ("label", "start_id", "end_id")),
          "edges_in": ("end_id", ("label", "start_id", "end_id"))}
_EDGE = ["label", "start_id", "end_id", "mgm"]


def _write_table(df: DataFrame, table: str, folder: str, width: int, ranged: bool = False) -> dict[str, str]:
    """Write rows of a table into parts below ``folder``; the commit's entries for the parts written.

    ``ranged``: the rows are in ranges of the table's order already.
    """
    place, key = TABLES[table]
    label = [] if table == "vertices" else ["label"]
    rest = [place, *(k for k in key if k not in (*label, place))]  # a hub's edges are cut by their other end
    rows = (df if ranged else df.repartitionByRange(*label, *rest)).withColumn("part", F.floor(F.col(place) / width))
    (rows.sortWithinPartitions(*label, "part", *rest).write.option("compression", PACKED)  # the order that the writer asks for, too
     .partitionBy(*label, "part").parquet(f"{folder}/{table}"))
    written = df.sparkSession.read.schema(f"{place} bigint, {'label string, ' if label else ''}part bigint").parquet(f"{folder}/{table}")
    return {f"{table}/{r[0]}": folder for r in written.select("part").distinct().collect()}  # a row a part


def write_graph(spark: SparkSession, base: str, vertices: DataFrame, edges: DataFrame, part_ids: int = PART_IDS,
                bucket_names: int = BUCKET_NAMES, stored: bool = False) -> Commit:
    """Publish a loaded graph as the base of layers. Copies of an edge are folded (largest mgm), once and for all.

    The layout by end is made of the layout by start. ``stored``: vertices and edges are read from tables already. Then
    vertices are not stored again, and copies of an edge meet in the range of the layout that they are written to; else edges are
    folded first, as ranges read their input twice.

    ``part_ids`` and ``bucket_names`` below the standard ones are raised where they make more than ``parts.FEW_PARTS``
    parts or buckets: every one of them is a folder with files in each table.
    """
    path = next_version(base)
    vertices = vertices if stored else freeze(vertices, "graph-vertices")
    edges = (edges.repartitionByRange(*_EDGE[:3]) if stored else edges).groupBy(*_EDGE[:3]).agg(F.max("mgm").alias("mgm"))
    names, top = vertices.agg(F.count("name"), F.coalesce(F.max("id"), F.lit(0))).first()
    buckets = buckets_for(names, bucket_names)
    write_names(vertices, f"{path}/names", buckets, names)
    width = part_size(top, part_ids, PART_IDS)
    parts = {"width": str(width), "top": str(top), "buckets": str(buckets), "bucket_names": str(bucket_names),
             "increments": "0", "names/0": f"{path}/names", "columns": vertices.schema.json()}
    parts |= _write_table(vertices, "vertices", path, width)
    parts |= _write_table(edges, "edges", path, width, ranged=stored)
    parts |= _write_table(_read_edges(spark, f"{path}/edges").select(*_EDGE), "edges_in", path, width)
    last = current_commit(spark, base)
    return publish(spark, base, path, parts, drop=[k for k in (last.parts if last else {}) if k not in parts])


def _read_edges(spark: SparkSession, folder: str, partitioned: bool = True) -> DataFrame:
    return spark.read.schema(f"start_id bigint, end_id bigint, mgm int, label string{', part bigint' if partitioned else ''}").parquet(folder)


def layers_of(commit: Commit) -> list[str]:
    """The commit's layer entries, oldest first."""
    return sorted(k for k in commit.parts if k.startswith("layer/"))


@dataclass(frozen=True)
class Graph:
    """The tables of one version of a layered graph."""

    spark: SparkSession
    commit: Commit

    @property
    def width(self) -> int:
        return int(self.commit.parts["width"])

    @property
    def names(self) -> NameIndex:
        folders = [self.commit.parts[k] for k in sorted(self.commit.parts) if k.startswith("names/")]
        return NameIndex(self.spark, tuple(folders), int(self.commit.parts["buckets"]))

    @property
    def vertices(self) -> DataFrame:
        return self.rows("vertices")

    @property
    def edges(self) -> DataFrame:
        return self.rows("edges")

    @property
    def edges_in(self) -> DataFrame:
        return self.rows("edges_in")

    def parts_of(self, table: str, rows: DataFrame) -> list[int]:
        """The parts of ``table`` that ``rows`` (a frame with its placing id) fall into: at most as many as there are."""
        return [r[0] for r in rows.select(F.floor(F.col(TABLES[table][0]) / self.width)).distinct().collect()]

    def stored(self, table: str, only: list[int] | None = None) -> DataFrame:
        """The base rows of ``table``, of the given parts only."""
        of_folder: dict[str, list[int]] = {}
        for k, folder in self.commit.parts.items():
            if k.startswith(f"{table}/"):
                of_folder.setdefault(folder, []).append(int(k.split("/")[1]))
        frames = []
        for folder, parts in sorted(of_folder.items()):
            rows = self._read(table, folder, partitioned=True)
            now = parts if only is None else [p for p in parts if p in set(only)]
            if only is not None or len(of_folder) > 1:  # parts that were rewritten since are still in their old folders
                rows = rows.where(F.col("part").isin(now))
            frames.append(rows.drop("part"))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) if frames else self._empty(table)

    def _empty(self, table: str) -> DataFrame:
        if table == "vertices":
            return self.spark.createDataFrame([], StructType.fromJson(json.loads(self.commit.parts["columns"])))
        return self.spark.createDataFrame([], "label string, start_id bigint, end_id bigint, mgm int")

    def _read(self, table: str, folder: str, partitioned: bool) -> DataFrame:
        if table == "vertices":
            return self.spark.read.parquet(f"{folder}/{table}")
        rows = _read_edges(self.spark, f"{folder}/{table}", partitioned)
        return rows.select(*_EDGE, *(["part"] if partitioned else []))

    def layered(self, table: str, only: list[int] | None = None) -> DataFrame | None:
        """The layers' rows of ``table``, of each key the last one; None without layers."""
        place, key = TABLES[table]
        frames = []
        for n, k in enumerate(layers_of(self.commit)):
            rows = self._read("edges" if table == "edges_in" else table, self.commit.parts[k], partitioned=False)  # small: one layout
            frames.append(rows if only is None else rows.where(F.floor(F.col(place) / self.width).isin(only)))
            frames[-1] = frames[-1].withColumn("_layer", F.lit(n))
        if not frames:
            return None
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        if len(frames) == 1:
            return rows.drop("_layer")
        rest = [c for c in rows.columns if c not in (*key, "_layer")]
        last = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), "_layer").alias("_row"))
        return last.select(*key, *(F.col(f"_row.`{c}`").alias(c) for c in rest))

    @cached_property
    def _layer_starts(self) -> IdSet:
        """The starts of the layers' edges."""
        return pack_ids(reduce(DataFrame.unionByName, [
            self._read("edges", self.commit.parts[k], partitioned=False).select("start_id") for k in layers_of(self.commit)]), "start_id")

    def most(self, table: str) -> int:
        """The rows of ``table``, those that layers replace included."""
        over = [self._read("edges" if table == "edges_in" else table, self.commit.parts[k], partitioned=False) for k in layers_of(self.commit)]
        return self.stored(table).count() + sum(o.count() for o in over)

    def rows(self, table: str, only: list[int] | None = None) -> DataFrame:
        """The rows of ``table``: the base's that no layer replaces, and the layers'."""
        base, over = self.stored(table, only), self.layered(table, only)
        if over is None:
            return base
        key = list(TABLES[table][1])
        same, safe = base, []
        if table != "vertices" and self._layer_starts.small:  # an edge whose start has none in a layer stands, without a shuffle
            same, safe = self._layer_starts.of(base, "start_id"), [self._layer_starts.of(base, "start_id", "left_anti")]
        stands = reduce(DataFrame.unionByName, [*safe, same.join(over.select(*key), key, "left_anti")])
        out = stands.unionByName(over, allowMissingColumns=True)
        return out.select(*(["id", *(c for c in out.columns if c != "id")] if table == "vertices" else _EDGE))


def read_graph(spark: SparkSession, base: str) -> Graph:
    """The current version of the layered graph at ``base``."""
    commit = current_commit(spark, base)
    if commit is None or "width" not in commit.parts:
        raise ValueError(f"no layered graph at {base}: publish one with write_graph")
    return Graph(spark, commit)


def increment(spark: SparkSession, base: str, vertex_delta: DataFrame, edge_delta: DataFrame,
              rejects: DataFrame | None = None) -> Commit:
    """G6, G7 on a layered graph: add the layer that the deltas make, and publish it.

    ``vertex_delta``: (label, name, properties..., ord), ``edge_delta``: (start_name, label, end_name, mgm, ord).
    Same rows as ``increment_vertices`` and ``increment_edges`` on whole tables; read are the index buckets of the
    deltas' names and the parts of the rows they change, written those rows. The version's ``rejects`` (line,
    error) get the refused keys and edges, after the rows given.
    """
    v_delta, e_delta = freeze(vertex_delta, "vertex-delta"), freeze(edge_delta, "edge-delta")

    def make(last: Commit) -> dict:
        g, path = Graph(spark, last), next_version(base)
        number, top = int(last.parts["increments"]) + 1, int(last.parts["top"])
        ends = e_delta.select(F.explode(F.array("start_name", "end_name")).alias("name"))
        found = freeze(g.names.find(v_delta.select("name").unionByName(ends)), "found-names")
        touched = found.join(v_delta.select("name").distinct(), "name", "left_semi")
        now = freeze(g.rows("vertices", g.parts_of("vertices", touched)).join(touched.select("id"), "id", "left_semi"), "touched-vertices")
        next_rows = increment_vertices(now, v_delta, top=top).join(v_delta.select("label", "name").distinct(), ["label", "name"], "left_semi")
        next_rows.select("id", "label", "name", *(c for c in next_rows.columns if c not in ("id", "label", "name"))).repartitionByRange(
            "id").sortWithinPartitions("id").write.parquet(f"{path}/vertices")
        new = spark.read.parquet(f"{path}/vertices").where(F.col("id") > top).select("name", "id", "label")
        count = new.count()
        if count:
            write_names(new, f"{path}/names", int(last.parts["buckets"]), count)
        known = found.unionByName(new)
        resolved = freeze(resolve_delta(e_delta, known).sortWithinPartitions("start_id"), "resolved-delta")
        keys = resolved.select(*_EDGE[:3])
        starts, at = pack_ids(keys, "start_id"), g.rows("edges", g.parts_of("edges", keys))
        old = (starts.of(at, "start_id") if starts.small else at).join(keys, _EDGE[:3], "left_semi")
        changed = upsert_resolved(old, resolved)
        (changed.repartitionByRange("label", "start_id").sortWithinPartitions("label", "start_id").write
         .option("compression", PACKED).parquet(f"{path}/edges"))
        refused = vertex_rejects(now, v_delta).select(F.to_json(F.struct("label", "name")).alias("line"), "error")
        lost = dangling_edges(e_delta, known).select(F.to_json(F.struct("start_name", "label", "end_name")).alias("line"),
                                                     F.concat(F.lit("missing: "), "missing").alias("error"))
        reduce(DataFrame.unionByName, [*([] if rejects is None else [rejects]), refused, lost]).write.parquet(f"{path}/rejects")
        parts = {f"layer/{number:012d}": path, "increments": str(number), "top": str(top + count)}
        return {"path": path, "parts": parts | ({f"names/{number:012d}": f"{path}/names"} if count else {}), "reads": ["increments", "buckets", "width"]}

    return publish_retrying(spark, base, make)


def fold_layers(spark: SparkSession, base: str) -> Commit:
    """Compaction: fold the layers into the parts they touch. Other parts, and all rows, stay as they are.

    The index folders of increments are written together; with twice the names a bucket is made for, the
    whole index is written with twice the buckets.
    """
    def make(last: Commit) -> dict:
        g, path, done = Graph(spark, last), next_version(base), layers_of(last)
        parts, drop = {}, list(done)
        for table in TABLES if done else ():
            touched = g.parts_of(table, g.layered(table))
            if touched:
                parts |= _write_table(freeze(g.rows(table, touched), "folded"), table, path, g.width)
        more = sorted(k for k in last.parts if k.startswith("names/"))[1:]
        held, names = int(last.parts["buckets"]), g.names
        count = names.all_rows().count()
        wanted = buckets_for(count, int(last.parts["bucket_names"]))
        if wanted > held:
            write_names(names.all_rows(), f"{path}/names", wanted, count)
            parts |= {"buckets": str(wanted), "names/0": f"{path}/names"}
            drop += more
        elif len(more) > 1:
            write_names(NameIndex(spark, tuple(last.parts[k] for k in more), held).all_rows(), f"{path}/names", held)
            parts[more[0]], drop = f"{path}/names", drop + more[1:]
        return {"path": path, "parts": parts, "drop": drop, "reads": [*parts, *drop, "buckets"]}

    return publish_retrying(spark, base, make)
