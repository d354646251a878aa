"""Dense global ids (U1, W1, J1) and numbered samples.

``row_number() over (order by name)`` would pull every name into one task.
``assign_dense_ids`` gives the same numbers with the work spread out:

1. distinct names (hash shuffle with map-side de-duplication, so a name
   repeated a billion times costs one row),
2. range-partition the unique names (balanced: no key repeats) and sort
   inside each partition,
3. tag each row with (partition, position) and freeze the result in the
   checkpoint folder, so both uses below see the same partitioning even if
   a stage is recomputed after an executor loss,
4. count rows per partition -> running offsets (one row per partition: a
   table whose size is bounded by the partition count, safe to broadcast),
5. id = offset + position + 1. No second shuffle of the names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import freeze

_POS_BITS = 33  # monotonically_increasing_id = partition << 33 | row position


def union_names(*frames: DataFrame, name_col: str = "name") -> DataFrame:
    """Distinct names over several vertex tables (null names dropped)."""
    cols = [f.select(F.col(name_col).alias("name")) for f in frames]
    return reduce(DataFrame.union, cols).where(F.col("name").isNotNull()).distinct()


def assign_dense_ids(names: DataFrame, name_col: str = "name",
                     num_partitions: int | None = None) -> DataFrame:
    """(id, name) with id = 1..N in name order; one id per distinct name."""
    distinct = names.select(F.col(name_col).alias("name")).where(F.col("name").isNotNull()).distinct()
    # Without an explicit count AQE sizes the range partitions from the data;
    # it only merges neighbouring ranges, so the global order is kept.
    by_range = (distinct.repartitionByRange(num_partitions, "name") if num_partitions
                else distinct.repartitionByRange("name"))
    ranked = (by_range
              .sortWithinPartitions("name")
              .select("name", F.monotonically_increasing_id().alias("_mid")))
    ranked = ranked.select(
        "name",
        F.shiftright("_mid", _POS_BITS).alias("_part"),
        (F.col("_mid") - F.shiftleft(F.shiftright("_mid", _POS_BITS), _POS_BITS)).alias("_pos"),
    )
    frozen = freeze(ranked, "ranked-names")
    counts = frozen.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # offsets has one row per range partition: bounded by n, not by the data.
    return (frozen.join(F.broadcast(offsets), "_part")
            .select((F.col("_off") + F.col("_pos") + 1).cast("bigint").alias("id"), "name"))


def attach_ids(vertices: DataFrame, ids: DataFrame, name_col: str = "name") -> DataFrame:
    """Prepend the id to each staged vertex row (inner equi-join on name)."""
    j = vertices.join(ids.withColumnRenamed("name", name_col), name_col)
    return j.select("id", *vertices.columns)


def number_rows(df: DataFrame, n: int = 100, order_col: str = "name",
                cols: tuple[str, ...] = ("name",)) -> DataFrame:
    """W2 + L1: a numbered sample of ``n`` rows, the first by ``order_col``.

    The limit is the feature here. ``orderBy().limit()`` plans as a
    distributed top-k (each task keeps n rows), so numbering afterwards
    touches only n rows.
    """
    top = df.select(*cols).orderBy(order_col).limit(n)
    return top.select(F.row_number().over(Window.orderBy(order_col)).cast("bigint").alias("rowid"), *cols)
