"""Graph snapshot shapes used by the traversal operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import MOBILE_INT_COLUMNS, WIDE_VERTEX_COLUMNS


def wide_vertices(vertices_by_label: dict[str, DataFrame]) -> DataFrame:
    """(id, label, every property column) over all labels; absent properties are null."""
    parts = []
    for label, v in vertices_by_label.items():
        cols = [F.col("id"), F.lit(label).alias("label")]
        for c in WIDE_VERTEX_COLUMNS:
            typ = "int" if c in MOBILE_INT_COLUMNS else "string"
            cols.append((F.col(c) if c in v.columns else F.lit(None)).cast(typ).alias(c))
        parts.append(v.select(*cols))
    return reduce(DataFrame.unionByName, parts)


def by_label(wide: DataFrame) -> dict[str, DataFrame]:
    """Split a wide vertex table back into per-label staged tables (id + the label's columns)."""
    from ..schema import VERTEX_LABELS, columns_for
    return {label: wide.where(F.col("label") == label).select("id", *columns_for(label))
            for label in VERTEX_LABELS}
