"""Column-level helpers (all built-in expressions, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_to_empty(c) -> Column:
    """A null value prints as the empty string."""
    return F.coalesce(col(c).cast("string"), F.lit(""))


def join_fields(*cols, sep: str = ",") -> Column:
    """Join every field with ``sep``; nulls print as '' so columns never shift."""
    return F.concat_ws(sep, *[null_to_empty(c) for c in cols])


def blank_to_null(c) -> Column:
    """A value that is blank after trimming counts as absent."""
    return F.when(F.length(F.trim(col(c))) > 0, col(c))


def parse_int(c) -> Column:
    """Lenient integer parse; '', '1.5' and 'x' become null."""
    return _try_cast(col(c), "int")


def parse_long(c) -> Column:
    """Lenient long parse."""
    return _try_cast(col(c), "bigint")


def _try_cast(c: Column, to: str) -> Column:
    return c.try_cast(to)


def field(arr, i: int) -> Column:
    """Safe 0-based access into an array column (null past the end)."""
    return F.get(col(arr), i)


def java_split(c, sep: str) -> Column:
    """Split on a one-character separator like ``String.split`` on the JVM:
    trailing empty fields are dropped.

    Spark's ``split`` keeps trailing empties (``a,CALL,b,`` has four fields);
    the exported-text readers count fields the JVM way.
    """
    return F.split(F.rtrim(col(c), F.lit(sep)), _regex_literal(sep))


def _regex_literal(sep: str) -> str:
    return "\\" + sep if sep in ".$|()[]{}^?*+\\" else sep


def strip_quotes(c) -> Column:
    """Remove every double quote (literal replace, no regex)."""
    return F.replace(col(c), F.lit('"'), F.lit(""))


def label_of(line) -> Column:
    """Text before the first ``[``, upper-cased; null when there is none."""
    return F.when(F.instr(col(line), "[") > 0, F.upper(F.substring_index(col(line), "[", 1)))


def sha1_hex(c) -> Column:
    """Lower-case hex SHA-1 of the UTF-8 text."""
    return F.sha1(col(c).cast("string"))
