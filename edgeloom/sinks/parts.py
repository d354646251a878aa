"""States cut into parts by extendible hashing.

A part is a prefix of the hash of the key, written in bits ("p" alone is every
key, "p01" those whose hash begins with 01). The parts of a state cover all
keys without overlap; the directory of them, with the folder and the number
of rows of each, is kept in the commit (``sinks.versions``). A part whose rows
may exceed the bound is written as as many children as keep them below it. So
the number of parts grows with the state, each is a bounded amount of work
for several tasks, and parts that an increment does not touch are never rewritten.
Every part is a folder of files and an entry of the commit, so a bound below the standard one
holds only up to ``FEW_PARTS`` parts: past that the parts grow first (``part_size``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: rows a part may hold, tasks (and files) that write a part, bits of the hash
PART_ROWS, WRITERS, _BITS = 2_000_000, 4, 32
#: parts up to which a bound below the standard one holds
FEW_PARTS = 256


def part_size(total: int, wanted: int, standard: int) -> int:
    """What a part holds of ``total``: ``wanted``, or, where that makes more than ``FEW_PARTS`` parts, more, up to ``standard``."""
    return max(wanted, min(standard, -(-total // FEW_PARTS)))


def with_part(df: DataFrame, keys: list[str], parts: Iterable[str]) -> DataFrame:
    """Adds ``part``: the part that each row's key falls into.

    Every prefix of a length that occurs is looked up in the directory, an equality join; as parts do not
    overlap one of them is there. With one length the prefix is the part.
    """
    parts = sorted(parts)
    depths = sorted({len(p) - 1 for p in parts})
    bits = F.lpad(F.bin(F.shiftrightunsigned(F.xxhash64(*keys), 64 - _BITS)), _BITS, "0")
    prefixes = [F.concat(F.lit("p"), F.substring(bits, 1, d)) if d else F.lit("p") for d in depths]
    if len(prefixes) == 1:
        return df.withColumn("part", prefixes[0])
    directory = df.sparkSession.createDataFrame([(p,) for p in parts], "part string")
    return df.withColumn("part", F.explode(F.array(*prefixes))).join(directory, "part")


def _split(value: str) -> tuple[str, int]:
    folder, rows = value.rsplit("|", 1)
    return folder, int(rows)


def read_parts(spark: SparkSession, parts: dict[str, str], only: Iterable[str] | None = None) -> DataFrame | None:
    """The rows of all parts, or of those named, or None if they hold no rows."""
    folders = [f for f, rows in (_split(parts[p]) for p in (parts if only is None else only) if p in parts) if rows]
    return spark.read.parquet(*folders) if folders else None


def children(part: str, rows: int, part_rows: int) -> list[str]:
    """``part``, or its children: as many as hold ``part_rows`` rows each, if keys spread evenly."""
    out = [part]
    while rows > part_rows * len(out) and len(out[0]) <= _BITS:
        out = [p + bit for p in out for bit in "01"]
    return out


def merge_into_parts(spark: SparkSession, parts: dict[str, str], keys: list[str], delta: DataFrame, empty,
                     merge: Callable[[DataFrame, DataFrame], DataFrame], folder: str, part_rows: int = PART_ROWS) -> dict:
    """Write what ``merge(state, delta)`` makes of the touched parts; what a commit has to set, drop and have read.

    ``parts``: the directory so far, empty for no state. ``empty``: schema of a state without rows. ``part_rows``: the
    bound of a part, see ``part_size``.
    """
    directory = list(parts) or ["p"]
    keyed = delta.dropna("any", subset=keys).select(*keys).distinct()
    came = {r["part"]: r["count"] for r in with_part(keyed, keys, directory).groupBy("part").count().collect()}  # touched parts
    old = {p: _split(parts[p])[1] if p in parts else 0 for p in came}
    size = part_size(sum(_split(v)[1] for v in parts.values()) + sum(came.values()), part_rows, PART_ROWS)
    targets = {p: children(p, old[p] + n, size) for p, n in came.items()}
    written = [c for t in targets.values() for c in t]
    state = read_parts(spark, parts, came)
    if written:
        new = with_part(merge(spark.createDataFrame([], empty) if state is None else state, delta), keys, written)
        salt = F.pmod(F.xxhash64(*keys), F.lit(WRITERS))
        new.repartition("part", salt).write.partitionBy("part").parquet(folder)
        rows = {r["part"]: r["count"] for r in spark.read.schema(new.schema).parquet(folder).groupBy("part").count().collect()}
    return {"parts": {c: f"{folder}/part={c}|{rows.get(c, 0)}" for c in written},
            "drop": [p for p, t in targets.items() if t != [p]],
            "reads": list(came) if parts else None}  # a first version depends on there being none
