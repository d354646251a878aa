"""Staging projections (P1-P3, P9): open JSON attributes to typed columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import parse_int, sha1_hex
from ..schema import DEVICE, DEVICE_COLUMNS, MOBILE, MOBILE_COLUMNS, MOBILE_INT_COLUMNS, WIFI


def add_name_digest(df: DataFrame, name_col: str = "name") -> DataFrame:
    """nm_pass (the name, passed through unencrypted) and nm_sha1 (hex SHA-1)."""
    return df.withColumn("nm_pass", F.col(name_col)).withColumn("nm_sha1", sha1_hex(name_col))


def _attr(key: str):
    return F.col("attrs").getItem(key)


def stage_mobile(vertices: DataFrame) -> DataFrame:
    """P1 (+P3): MOBILE vertices projected to the 11 staged columns, typed.

    ``vertices`` is the output of ``ingest_vertices``; other labels are
    ignored. Integer columns parse leniently (non-integers become null).
    """
    m = vertices.where(F.col("label") == MOBILE)
    return m.select(*[e.alias(c) for c, e in zip(MOBILE_COLUMNS, _mobile_cols())])


def stage_device(vertices: DataFrame, label: str = DEVICE) -> DataFrame:
    """DEVICE (or WIFI) vertices projected to name, is_exception, is_white."""
    if label not in (DEVICE, WIFI):
        raise ValueError(f"stage_device takes DEVICE or WIFI, not {label}")
    d = vertices.where(F.col("label") == label)
    return d.select(*[_attr(c).alias(c) for c in DEVICE_COLUMNS])


def stage_vertices_wide(vertices: DataFrame, *carried: str) -> DataFrame:
    """P1+P2 in one projection: (label, every staged column) for all labels, with the ``carried`` columns.

    MOBILE rows fill the mobile columns, other rows fill
    is_exception/is_white; the rest is null. Lets a pipeline parse and
    store the vertex text once and split it by label afterwards
    (``split_staged``).
    """
    is_m = F.col("label") == MOBILE
    cols = [F.col("label"), _attr("name").alias("name")]
    for c, expr in zip(MOBILE_COLUMNS[1:], _mobile_cols()[1:]):
        cols.append(F.when(is_m, expr).alias(c))
    for c in DEVICE_COLUMNS[1:]:
        cols.append(F.when(~is_m, _attr(c)).alias(c))
    return vertices.select(*cols, *carried)


def union_staged(vertices_by_label: dict[str, DataFrame]) -> DataFrame:
    """Staged tables of several labels as one wide table (label, every staged column)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                  [with_label(v, label) for label, v in vertices_by_label.items()])


def split_staged(wide: DataFrame) -> dict[str, DataFrame]:
    """Per-label staged tables from ``stage_vertices_wide`` output."""
    return {label: wide.where(F.col("label") == label).select(*(MOBILE_COLUMNS if label == MOBILE else DEVICE_COLUMNS))
            for label in (DEVICE, WIFI, MOBILE)}


def _mobile_cols():
    """Typed expressions of the 11 staged mobile columns, in order, from ``attrs``."""
    out = []
    for c in MOBILE_COLUMNS:
        if c == "nm_pass":
            out.append(_attr("name"))
        elif c == "nm_sha1":
            out.append(sha1_hex(_attr("name")))
        elif c in MOBILE_INT_COLUMNS:
            out.append(parse_int(_attr(c)))
        else:
            out.append(_attr(c))
    return out


def with_label(df: DataFrame, value: str, name: str = "label") -> DataFrame:
    """Add a constant tag column."""
    return df.withColumn(name, F.lit(value))
