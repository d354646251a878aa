"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Each shard has ``vnodes`` points on a ring of 2**32; the arc that ends at a
point belongs to its shard, and a row's home is the shard whose arc holds the
hash of its id. Loads are bounded: rows arrive in ring order, and one that finds
its shard full goes on clockwise to the next virtual node whose shard has room.
With ``slack`` 0 the bounds add up to the number of rows, so the shards' counts
are at most one apart (law "rows"); with more slack fewer rows leave home. A
shard more takes its arcs from all others alike, so few rows move.

Ring order needs no pass row by row: rows that arrive in one arc differ only by
their rank in it, so the number of rows in each arc (shards * vnodes numbers,
whatever the corpus) decides which ranks of an arc go to which shard, and with
which slots. Ranks are running totals inside (arc, bucket), with the buckets'
offsets from a small table. Rows that are equal in the result are one row with
a count, cut into blocks that fall into different buckets; so an id that a
third of all rows carry is spread, over tasks and, its shard being full, over shards.

Edge cases: a null text has size 1 and the checksum of the empty text, 0. A
null ``doc_id`` has the hash of the empty string. Repeated rows get a slot
each. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .frames import table, written

SHARDS, VNODES = 16, 64
#: equal rows in one block, hex digits of a bucket, cells of the ring for the arc lookup
_BLOCK, _HEX, _CELLS = 4096, 2, 4096
_RING = 1 << 32
_ROW = ["doc_id", "size", "text_crc32"]


def ring(shards: int = SHARDS, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """(point, shard) of every virtual node, clockwise."""
    return sorted((int(md5(f"{s}:{v}".encode()).hexdigest()[:8], 16), s) for s in range(shards) for v in range(vnodes))


def bounds(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """The largest number of rows of each shard."""
    if slack:
        return [-(-int(rows * (1 + slack) * 1000) // (1000 * shards)) + 1] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def deal(owners: list[int], counts: list[int], most: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, end rank, shard, slot of the first): where the rows of each arc go, in ring order."""
    used, out = [0] * len(most), []
    for arc, n in enumerate(counts):
        at, node = 0, arc
        while at < n:
            shard = owners[node % len(owners)]
            take = min(n - at, most[shard] - used[shard])
            if take > 0:
                out.append((arc, at, at + take, shard, used[shard]))
                used[shard] += take
                at += take
            node += 1
    return out


def _arcs(spark: SparkSession, points: list[int]) -> DataFrame:
    """(cell, arc, low, high): the arcs, cut at the cells of the ring; points p with low < p <= high."""
    width, rows = _RING // _CELLS, []
    spans = [(k, points[k - 1] if k else -1, p) for k, p in enumerate(points)] + [(0, points[-1], _RING - 1)]
    for arc, low, high in spans:
        if low < high:
            rows += [(cell, arc, low, high) for cell in range((low + 1) // width, high // width + 1)]
    return spark.createDataFrame(rows, "cell long, arc int, low long, high long")


def _point(key: Column) -> Column:
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, block, copies): rows that are equal in these columns, in blocks."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = rows.groupBy(*_ROW).agg(F.count("*").alias("n"))
    blocks = F.explode(F.sequence(F.lit(0), F.expr(f"(n - 1) div {_BLOCK}")))
    return (rows.withColumn("block", blocks)
            .select(*_ROW, "block", F.least(F.lit(_BLOCK), F.col("n") - F.col("block") * _BLOCK).alias("copies")))


def shard(docs: DataFrame, shards: int = SHARDS, vnodes: int = VNODES, slack: float = 0.0) -> DataFrame:
    """(doc_id, size, text_crc32, home, shard, slot) of every row; ``home`` is its shard on the ring without bounds."""
    spark, nodes = docs.sparkSession, ring(shards, vnodes)
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    tag = F.md5(F.concat_ws(":", key, "size", "text_crc32", "block").cast("binary"))
    rows = sized(docs).withColumn("point", _point(key)).withColumn("tag", tag)
    rows = (rows.withColumn("cell", F.expr(f"point div {_RING // _CELLS}"))
            .join(F.broadcast(_arcs(spark, [p for p, _ in nodes])), "cell")  # cells and arcs: bounded by parameters
            .where("point > low and point <= high")
            .select(*_ROW, "block", "copies", "arc", "tag", F.substring("tag", 1, _HEX).alias("bucket")))
    rows = written(rows, "shard-rows")

    counts = rows.groupBy("arc", "bucket").agg(F.sum("copies").alias("n"))
    before = Window.partitionBy("arc").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = written(counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "shard-buckets")
    in_arc = dict(counts.groupBy("arc").agg(F.sum("n")).collect())  # a number for each arc: shards * vnodes at most
    numbers = [in_arc.get(k, 0) for k in range(len(nodes))]
    owners = [s for _, s in nodes]
    pieces = [(*p, owners[p[0]]) for p in deal(owners, numbers, bounds(sum(numbers), shards, slack))]
    pieces = spark.createDataFrame(pieces, "arc int, low long, high long, shard int, slot long, home int")

    by_tag = Window.partitionBy("arc", "bucket").orderBy("tag", *_ROW, "block").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (rows.withColumn("upto", F.sum("copies").over(by_tag))
              .join(counts.select("arc", "bucket", "before"), ["arc", "bucket"])
              .select(*_ROW, "arc", (F.col("before") + F.col("upto") - F.col("copies")).alias("first"),
                      (F.col("before") + F.col("upto")).alias("end")))
    placed = ranked.join(F.broadcast(pieces), "arc").where("first < high and end > low")  # a piece an arc, one more a shard
    rank = F.explode(F.sequence(F.greatest("first", "low"), F.least("end", "high") - 1))
    return (placed.withColumn("rank", rank)
            .select(*_ROW, "home", "shard", (F.col("slot") + F.col("rank") - F.col("low")).alias("slot")))


def op11_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents")).select(
        *_ROW, F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def crc32_sql(text: str) -> str:
    """DuckDB SQL of the CRC-32 of a string's UTF-8 bytes; a byte's table entry is the sum of those of its bits."""
    entry = []
    for bit in range(8):
        c = 1 << bit
        for _ in range(8):
            c = (c >> 1) ^ (0xEDB88320 * (c & 1))
        entry.append(f"((xor(c, b) >> {bit}) & 1) * {c}")
    step = entry[0]
    for e in entry[1:]:
        step = f"xor({step}, {e})"
    byte_list = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)"
    return f"xor(list_reduce({byte_list}, lambda c, b: xor(c >> 8, {step}), 4294967295::BIGINT), 4294967295::BIGINT)"


ORACLE = f"""
WITH RECURSIVE v AS (SELECT ('0x' || substr(md5(s || ':' || v), 1, 8))::BIGINT AS p, s FROM range({SHARDS}) a(s), range({VNODES}) b(v)),
o AS (SELECT row_number() OVER (ORDER BY p, s) - 1 AS arc, p, s FROM v),
d AS (SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT + 1 AS size, {crc32_sql("coalesce(text, '')")} AS text_crc32 FROM documents),
c AS (SELECT *, (row_number() OVER (PARTITION BY doc_id, size, text_crc32) - 1) // {_BLOCK} AS block,
             ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS p FROM d),
a AS (SELECT c.*, CASE WHEN o.arc IS NULL THEN 0 ELSE o.arc END AS arc FROM c ASOF LEFT JOIN o ON c.p <= o.p),
k AS (SELECT doc_id, size, text_crc32, arc, row_number() OVER (PARTITION BY arc ORDER BY
             md5(concat_ws(':', coalesce(doc_id::VARCHAR, ''), size, text_crc32, block)), doc_id, size, text_crc32, block) - 1 AS rank FROM a),
n AS (SELECT list(coalesce(n, 0) ORDER BY o.arc) AS n, list(s ORDER BY o.arc) AS own, sum(n)::BIGINT AS total
      FROM o LEFT JOIN (SELECT arc, count(*) AS n FROM k GROUP BY arc) x ON x.arc = o.arc),
r AS (SELECT -1::BIGINT AS arc, 0::BIGINT AS node, 0::BIGINT AS low, 0::BIGINT AS high, 0::BIGINT AS shard, 0::BIGINT AS slot,
             list_transform(range({SHARDS}), lambda x: 0::BIGINT) AS used, TRUE AS done
      UNION ALL
      SELECT arc, node, low, low + take, s, used[s + 1],
             list_transform(used, lambda x, i: CASE WHEN i = s + 1 THEN x + take ELSE x END), low + take = n
      FROM (SELECT *, least(n - low, total // {SHARDS} + (s < total % {SHARDS})::BIGINT - used[s + 1]) AS take FROM (
              SELECT arc, node, low, used, n.n[arc + 1] AS n, n.own[node % len(n.own) + 1] AS s, total FROM (
                SELECT CASE WHEN done THEN arc + 1 ELSE arc END AS arc, CASE WHEN done THEN arc + 1 ELSE node + 1 END AS node,
                       CASE WHEN done THEN 0 ELSE high END AS low, used FROM r), n
              WHERE arc < len(n.own) AND total > 0)))
SELECT doc_id, size, text_crc32, 'rows' AS law, shard::INTEGER AS shard, slot + rank - low AS slot, NULL::INTEGER AS grown_shard
FROM k JOIN r ON r.arc = k.arc AND rank >= low AND rank < high
"""
