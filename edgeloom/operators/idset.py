"""Sets of ids, packed: a row for each run of 64 ids, with a bit for each of them.

A set of many ids that lie close together, as the dense ids of a graph do, has up to 64 times fewer rows than ids.
So rows are picked by a broadcast of the set where the ids themselves are too many for one, and the picked rows are
not shuffled. The set is stored and its rows are counted: one of more than ``SMALL_WORDS`` is left to the planner.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import freeze

#: rows up to which a set is broadcast: 16 bytes each, 64,000,000 ids that lie close together
SMALL_WORDS = 1_000_000
_SHIFT = 6  # a row has 2 ** 6 ids


@dataclass(frozen=True)
class IdSet:
    rows: DataFrame  # (word, bits)
    words: int

    @property
    def small(self) -> bool:
        return self.words <= SMALL_WORDS

    def of(self, df: DataFrame, column: str, how: str = "left_semi") -> DataFrame:
        """The rows whose ``column`` is in the set; with ``how`` left_anti those whose is not, or null."""
        id_ = df[column].cast("bigint")
        held = F.broadcast(self.rows) if self.small else self.rows
        return df.join(held, (F.shiftright(id_, _SHIFT) == held["word"]) & (F.getbit(held["bits"], _place(id_)) == 1), how)


def _place(id_: Column) -> Column:
    return id_.bitwiseAND(F.lit((1 << _SHIFT) - 1)).cast("int")


def pack_ids(ids: DataFrame, column: str) -> IdSet:
    """The set of the ids in ``column``; null ids are left out."""
    id_ = F.col(column).cast("bigint")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), _place(id_))
    rows = freeze(ids.where(id_.isNotNull()).groupBy(F.shiftright(id_, _SHIFT).alias("word")).agg(F.bit_or(bit).alias("bits")), "id-set")
    return IdSet(rows, rows.count())
