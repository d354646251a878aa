"""Name index: which vertex has a name, without a scan of the vertices.

(name, id, label) in buckets by the hash of the name, a folder each, sorted by
name inside and with Parquet bloom filters on it. A lookup opens the buckets of
its names only: given names become a literal bucket list (partition pruning),
a frame of names is asked for its distinct buckets first (at most as many as
there are buckets). An index may have several folders with the same number
of buckets: increments add a folder of their new names. A filter is sized for the
names that a file is expected to hold; unsized it takes 1 MB in every file.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .parts import part_size

#: names a bucket holds when the index is made; files of a bucket
BUCKET_NAMES, _FILES = 500_000, 4
_SCHEMA = "name string, id bigint, label string, bucket int"


def bucket_of(name: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(buckets)).cast("int")


def buckets_for(names: int, bucket_names: int = BUCKET_NAMES) -> int:
    """A power of two, so that doubling the buckets splits each in two; few larger ones rather than many small ones."""
    return 1 << (-(-max(names, 1) // part_size(names, bucket_names, BUCKET_NAMES)) - 1).bit_length()


def write_names(vertices: DataFrame, folder: str, buckets: int, names: int | None = None) -> None:
    """Index the names of ``vertices`` (name, id, label) below ``folder``; null names have no entry.

    ``names``: how many there are, counted if not given. The filters are made for twice a file's share.
    """
    names = vertices.agg(F.count("name")).first()[0] if names is None else names
    rows = vertices.select("name", "id", "label").where(F.col("name").isNotNull()).withColumn("bucket", bucket_of(F.col("name"), buckets))
    piece = F.pmod(F.shiftright(F.xxhash64("name"), 40), F.lit(_FILES))  # a bucket is written by several tasks
    (rows.repartition("bucket", piece).sortWithinPartitions("bucket", "name").write
     .option("parquet.bloom.filter.enabled#name", "true")
     .option("parquet.bloom.filter.expected.ndv#name", str(max(2 * names // (buckets * _FILES), 64))).partitionBy("bucket").parquet(folder))


@dataclass(frozen=True)
class NameIndex:
    spark: SparkSession
    folders: tuple[str, ...]
    buckets: int

    def all_rows(self) -> DataFrame:
        """(name, id, label, bucket) of the whole index."""
        return self.spark.read.schema(_SCHEMA).parquet(*self.folders) if len(self.folders) == 1 else self._several()

    def _several(self) -> DataFrame:
        out = self.spark.createDataFrame([], _SCHEMA)
        for f in self.folders:  # a folder each: bucket folders are found below every one
            out = out.unionByName(self.spark.read.schema(_SCHEMA).parquet(f))
        return out

    def find(self, names: Sequence[str] | DataFrame, label: str | None = None) -> DataFrame:
        """(name, id, label) of the vertices with one of ``names`` (of a column ``name``, if a frame)."""
        if isinstance(names, DataFrame):
            wanted = names.select("name").where(F.col("name").isNotNull()).distinct()
            touched = [r[0] for r in wanted.select(bucket_of(F.col("name"), self.buckets)).distinct().collect()]
            rows = self.all_rows().where(F.col("bucket").isin(touched)).join(wanted, "name", "left_semi")
        else:
            buckets = [bucket_of(F.lit(n), self.buckets) for n in names]
            rows = self.all_rows().where(F.col("bucket").isin(buckets) & F.col("name").isin(list(names)))
        rows = rows.select("name", "id", "label")
        return rows if label is None else rows.where(F.col("label") == label)

    def ids(self, names: Sequence[str], label: str | None = None) -> list[int]:
        """Ids of the vertices with one of the given names, for pushed-down filters (as many as names, if unique)."""
        return [r["id"] for r in self.find(names, label).select("id").collect()]
