"""Incremental import with Structured Streaming.

The increment jobs are batch upserts rerun on new files. Here new exported
vertex or edge text arriving in a folder is read with ``readStream.text``
and each micro-batch is folded into the current version of a state with the
operators used in batch. Every batch writes a new version folder and then
publishes it (``sinks.versions``): a crash in between leaves the state as it
was, and the batch runs again. Upserts are idempotent, so a batch that
is repeated after it was published changes nothing.
``trigger(availableNow=True)`` runs a stream as a catch-up job.

A version holds ``state`` (or a layer of the graph) and ``rejects``: the lines
and keys the batch could not take, with the reason. A vertex or edge state is
cut into parts by extendible hashing (``sinks.parts``): a part is a prefix of
the key's hash, the directory of parts is in the commit, and a part that would
outgrow its bound is written as its children. A batch reads and writes only
the parts that its keys fall into, the others stay where they are; two
streams that write one base both get in, one after the other.

"The last value wins" needs an order of lines: batch, then file, then the
place in the file (block, position of the row in its block).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import dangling_edges, merge_edges, merge_vertex_attrs, merge_vertices
from ..schema import VERTEX_LABELS
from ..session import freeze
from ..sinks import layers
from ..sinks.parts import PART_ROWS, merge_into_parts, read_parts
from ..sinks.tables import next_version
from ..sinks.versions import Commit, current_commit, publish_retrying
from ..sources.text import parse_edge_rows, parse_vertex_lines, with_load_errors

_PLACE = ["_file", "_block"]


def lines_of_files(reader, path: str) -> DataFrame:
    """Text lines with their place, from ``spark.read`` or ``spark.readStream``."""
    return reader.text(path).select("value", F.col("_metadata.file_path").alias("_file"),
                                    F.col("_metadata.file_block_start").alias("_block"))


def with_order(lines: DataFrame, batch_id: int) -> DataFrame:
    """Adds ``ord``: (batch, file, block, position), which sorts as the lines do."""
    place = [F.col(c) if c in lines.columns else F.lit(None) for c in _PLACE]
    return lines.withColumn("ord", F.struct(
        F.lit(batch_id).cast("bigint").alias("batch"), place[0].cast("string").alias("file"),
        place[1].cast("bigint").alias("block"), F.monotonically_increasing_id().alias("position")))


def _parsed_vertices(lines: DataFrame, batch_id: int) -> DataFrame:
    """(label, attrs, ord, line, error), stored: each line is parsed once."""
    ordered = with_order(lines, batch_id)
    parsed = parse_vertex_lines(ordered.select("value", "ord"), "ord")
    return freeze(with_load_errors(parsed, VERTEX_LABELS), "vertex-batch")


def _parsed_edges(lines: DataFrame, batch_id: int) -> DataFrame:
    ordered = with_order(lines, batch_id)
    return freeze(parse_edge_rows(ordered.select("value", "ord"), "labelled", "ord"), "edge-batch")


def _refused(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("error").isNotNull()).select("line", "error")


def _dangling(delta: DataFrame, vertices: DataFrame) -> DataFrame:
    return dangling_edges(delta, vertices).select(
        F.to_json(F.struct("start_name", "label", "end_name")).alias("line"),
        F.concat(F.lit("missing: "), "missing").alias("error"))


def _good(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("error").isNull())


def read_state(spark: SparkSession, base: str) -> DataFrame | None:
    """The current state below ``base``, or None where there is none."""
    commit = current_commit(spark, base)
    return read_parts(spark, commit.parts) if commit else None


def _upsert(spark: SparkSession, base: str, keys: list[str], delta: DataFrame, empty,
            merge: Callable[[DataFrame, DataFrame], DataFrame], rejects: DataFrame, part_rows: int) -> None:
    """Merge ``delta`` into the parts of the state that its keys touch, and publish the result."""
    def make(last: Commit) -> dict:
        out = next_version(base)
        change = merge_into_parts(spark, last.parts, keys, delta, empty, merge, f"{out}/state", part_rows)
        rejects.write.parquet(f"{out}/rejects")
        return {"path": out} | change

    publish_retrying(spark, base, make)


def _columns_delta(parsed: DataFrame, columns: list[str], casts: dict[str, str]) -> DataFrame:
    value = lambda c: F.col("attrs")[c].try_cast(casts[c]) if c in casts else F.col("attrs")[c]
    return _good(parsed).select("label", F.col("attrs")["name"].alias("name"),
                                *[value(c).alias(c) for c in columns], "ord")


def upsert_vertices_batch(spark: SparkSession, base: str, columns: list[str], casts: dict[str, str] | None = None,
                          part_rows: int = PART_ROWS) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function folding vertex lines into the state at ``base``."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        parsed = _parsed_vertices(batch, batch_id)
        delta = _columns_delta(parsed, columns, casts or {})
        _upsert(spark, base, ["label", "name"], delta, delta.drop("ord").schema, merge_vertices, _refused(parsed), part_rows)

    return apply


def upsert_open_vertices_batch(spark: SparkSession, base: str,
                               part_rows: int = PART_ROWS) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function folding vertex lines, with all their JSON
    properties, into an open-schema state (label, name, attrs) at ``base``."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        parsed = _parsed_vertices(batch, batch_id)
        delta = _good(parsed).select("label", F.col("attrs")["name"].alias("name"), "attrs", "ord")
        _upsert(spark, base, ["label", "name"], delta, "label string, name string, attrs map<string,string>",
                merge_vertex_attrs, _refused(parsed), part_rows)

    return apply


def upsert_edges_batch(spark: SparkSession, base: str, vertices: Callable[[], DataFrame],
                       part_rows: int = PART_ROWS) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function folding labelled edge lines into the edge state at ``base``.

    ``vertices()`` gives the vertices (name) known when the batch runs; edges with an unknown end are refused.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        parsed = _parsed_edges(batch, batch_id)
        delta = _good(parsed).select("start_name", "label", "end_name", "mgm", "ord")
        known = vertices()
        _upsert(spark, base, ["start_name", "label", "end_name"], delta,
                "start_name string, label string, end_name string, mgm int",
                lambda state, d: merge_edges(state, d, known, state_folded=True),
                _refused(parsed).unionByName(_dangling(delta, known)), part_rows)

    return apply


def increment_graph_batch(spark: SparkSession, base: str, columns: list[str], casts: dict[str, str] | None = None,
                          fold_after: int = 8) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function folding vertex and edge lines into the layered graph at ``base`` (``sinks.layers``).

    Lines that begin with a quote are edges, others are vertices. New vertices get ids, edges are resolved
    against old and new ones, and both are published together as one layer, so traversals over the current
    version see the increment as a whole or not at all. After ``fold_after`` layers they are folded into the
    parts they touch.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        is_edge = F.coalesce(F.ltrim("value").startswith('"'), F.lit(False))
        v_lines = _parsed_vertices(batch.where(~is_edge), batch_id)
        e_lines = _parsed_edges(batch.where(is_edge), batch_id)
        refused = _refused(v_lines).unionByName(_refused(e_lines))
        e_delta = _good(e_lines).select("start_name", "label", "end_name", "mgm", "ord")
        done = layers.increment(spark, base, _columns_delta(v_lines, columns, casts or {}), e_delta, refused)
        if len(layers.layers_of(done)) >= fold_after:
            layers.fold_layers(spark, base)

    return apply


def start_upsert_stream(spark: SparkSession, source_dir: str, checkpoint: str,
                        apply: Callable[[DataFrame, int], None], available_now: bool = True):
    """Watch ``source_dir`` for new text files and run ``apply`` per micro-batch."""
    w = lines_of_files(spark.readStream, source_dir).writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
