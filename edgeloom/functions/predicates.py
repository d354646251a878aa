"""Property predicates (F1-F8) as Column expressions.

They compose with ``&``/``|`` and push down into parquet scans when they
reach a stored column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def has_eq(key: str, value) -> Column:
    """property equals ``value``."""
    return F.col(key) == F.lit(value)


def has_within(key: str, values) -> Column:
    """property is one of a literal list (for a large set use ``within_frame``)."""
    return F.col(key).isin(list(values))


def within_frame(df: DataFrame, key: str, values: DataFrame, value_col: str | None = None) -> DataFrame:
    """F2 for a large value set: semi-join against a DataFrame of values."""
    vc = value_col or values.columns[0]
    return df.join(values.select(F.col(vc).alias(key)).distinct(), key, "left_semi")


def has_neq(key: str, value) -> Column:
    """property differs from ``value``; a vertex lacking the property does not pass."""
    return F.col(key).isNotNull() & (F.col(key) != F.lit(value))


def or_(*preds: Column) -> Column:
    """disjunction (a null side counts as false)."""
    out = F.coalesce(preds[0], F.lit(False))
    for p in preds[1:]:
        out = out | F.coalesce(p, F.lit(False))
    return out


def has_label(label: str, col: str = "label") -> Column:
    """vertex or edge label equals ``label``."""
    return F.col(col) == F.lit(label)


def lt_or_missing(key: str, value) -> Column:
    """property is below ``value`` or absent."""
    v = value if isinstance(value, Column) else F.lit(value)
    return F.col(key).isNull() | (F.col(key) < v)


def drop_blank_label(col: str = "label") -> Column:
    """keep records whose label is neither null nor empty."""
    return F.col(col).isNotNull() & (F.length(F.col(col)) > 0)
