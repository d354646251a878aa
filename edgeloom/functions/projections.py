"""Result shaping (P4-P8): flat rows with defaults, value maps, named steps, headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project_or_constant(df: DataFrame, columns: dict[str, str], default: str = "null") -> DataFrame:
    """One flat row per match; ``columns`` maps output name -> source column.

    A missing property prints as the constant (the string "null" by
    default): lean rows, no lists or maps.
    """
    return df.select(*[F.coalesce(F.col(src).cast("string"), F.lit(default)).alias(out)
                       for out, src in columns.items()])


def value_map(keys: list[str]) -> Column:
    """P5: map of key -> list of values; keys whose value is absent are left out."""
    pairs = []
    for k in keys:
        pairs += [F.lit(k), F.when(F.col(k).isNotNull(), F.array(F.col(k).cast("string")))]
    return F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull())


def value_map_unfolded(keys: list[str]) -> Column:
    """As ``value_map`` with scalar values (``valueMap().by(unfold())``)."""
    m = F.map_from_arrays(F.array(*[F.lit(k) for k in keys]), F.array(*[F.col(k).cast("string") for k in keys]))
    return F.map_filter(m, lambda k, v: v.isNotNull())


def select_as(**steps: list[str]) -> list[Column]:
    """Keep named steps side by side, each a struct of its columns.

    ``select_as(m1=["a_name"], m2=["b_name", "b_status"])`` gives columns
    ``m1`` and ``m2``.
    """
    return [F.struct(*[F.col(c) for c in cols]).alias(name) for name, cols in steps.items()]


def map_text(m) -> Column:
    """Canonical text of a string map (or map of string lists): ``k=v`` sorted by key.

    For reports and comparisons; lists print as ``[a,b]``.
    """
    m = F.col(m) if isinstance(m, str) else m
    return F.array_join(F.transform(F.array_sort(F.map_entries(m)), _entry_text), ",")


def _entry_text(e: Column) -> Column:
    v = e["value"]
    return F.concat(e["key"], F.lit("="), v)


def list_map_text(m) -> Column:
    """``map_text`` for a map of lists: ``k=[v1,v2]``."""
    m = F.col(m) if isinstance(m, str) else m
    return F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat(
        e["key"], F.lit("=["), F.array_join(e["value"], ","), F.lit("]"))), ",")


def bulk_header(df: DataFrame, label: str, types: dict[str, str]) -> DataFrame:
    """Bulk-loader header names: ``name`` -> ``name:ID(label)``, typed ``c`` -> ``c:Type``."""
    names = []
    for c in df.columns:
        if c == "name":
            names.append(f"name:ID({label})")
        elif c in types:
            names.append(f"{c}:{types[c]}")
        else:
            names.append(c)
    return df.toDF(*names)
