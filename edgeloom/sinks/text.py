"""Text sinks (K4-K7): adjacency lines, CSV, exported vertex and edge text.

Renderers return DataFrames of one ``line`` column so they can be checked
or fed straight back into the readers; ``write_lines`` writes them. Writes
are distributed (one file per task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import (CALL, DEVICE_COLUMNS, EXPORT_LABEL_CODES, MOBILE, MOBILE_EXPORT_COLUMNS, NULL_MARK)


def write_lines(lines: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None) -> None:
    """K4: one text line per row (the ``line`` column)."""
    w = lines.select("line").write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    w.text(path)


def write_adjacency_text(adj_lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K4: adjacency lines as text, one per vertex."""
    write_lines(adj_lines, path, mode)


def write_csv(df: DataFrame, path: str) -> None:
    """K5: CSV with a header, overwriting: a folder of part files, each with the header.

    Every task writes its own part, so there is no limit on the rows. Empty
    strings are written as "" and nulls as empty fields (the default
    ``emptyValue``), so the two stay distinguishable.
    """
    df.write.mode("overwrite").option("header", True).csv(path)


def _json_of(cols) -> F.Column:
    # to_json drops null fields: an absent property is not exported
    return F.to_json(F.struct(*[F.col(c) for c in cols]))


def export_vertices(vertices: DataFrame, label: str, key_col: str = "k", cols=None) -> DataFrame:
    """K6: ``label[code.key]{json}`` per vertex (label lower-case, as the source prints it).

    ``vertices`` carries the label's properties (``cols``, default: all of
    the label's exported properties) and a local key column.
    """
    cols = cols or (MOBILE_EXPORT_COLUMNS if label == MOBILE else DEVICE_COLUMNS)
    gid = F.concat(F.lit(f"{EXPORT_LABEL_CODES[label]}."), F.col(key_col).cast("string"))
    line = F.concat(F.lit(label.lower()), F.lit("["), gid, F.lit("]"), _json_of(cols))
    return vertices.select(line.alias("line"))


def _q(c) -> F.Column:
    return F.concat(F.lit('"'), F.col(c), F.lit('"'))


def export_edges(edges: DataFrame, label: str) -> DataFrame:
    """K7: ``"start","LABEL","end"`` lines; CALL adds ``,mgm`` with ``\\N`` for null.

    ``edges`` has start_name, end_name (and mgm for CALL).
    """
    parts = [_q("start_name"), F.lit(f',"{label}",'), _q("end_name")]
    if label == CALL:
        parts += [F.lit(","), F.coalesce(F.col("mgm").cast("string"), F.lit(NULL_MARK))]
    return edges.select(F.concat(*parts).alias("line"))


def export_edges_csv(edges: DataFrame, label: str, path: str) -> None:
    """K7 through the CSV writer: unquoted fields, ``\\N`` for null."""
    cols = [F.col("start_name"), F.lit(label), F.col("end_name")]
    if label == CALL:
        cols.append(F.col("mgm"))
    edges.select(*cols).write.mode("overwrite").option("nullValue", NULL_MARK).csv(path)
