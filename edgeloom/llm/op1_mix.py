"""Mixing sources to target weights with a low-discrepancy schedule (DataFrame functions only).

1. Allotment: sources share a total by weight; none goes beyond ``cap`` times
   its size, and what is left over is shared by weight among the others
   (water filling, closed form over the sources ordered by cap per weight).
2. Blocks: the documents of a source, shuffled by the md5 of their id, form a
   stream of words that repeats; block r holds the words from r * block_words.
3. Schedule: slot i has the point frac(i * golden ratio). The sources'
   cumulative targets map it to a source, and its rank among that source's
   slots is the block it takes. Slots beyond a target are cut, the last one is
   cut to length, and a source whose slots fall short of its target by the
   sequence's discrepancy gets the missing blocks at the end.
4. The pieces of documents join the blocks on (source, r): ``mixed_pieces`` is
   the mix itself, in schedule order; ``mix`` adds its words up per document.

No running total runs over a whole source: totals are made per (source,
bucket) with the buckets' offsets from a small table, for documents (buckets
by md5) and for slots (buckets by range), so a hot source is spread.

Edge cases: a null or empty text has size 0 and takes 0 words. A null source
is a source of its own, last in order. A null ``doc_id`` is shuffled as the
empty id. Repeated rows count each, and share their source's stream in
turn. With no words at all every target and taken is 0. An empty table gives
an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .frames import table, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, SHARE, CAP, BLOCK_WORDS = (3, 1, 2), 1.5, 2.0, 512
#: buckets of the md5 (its first three hex digits) and slots per bucket of the schedule
_HEX, _SLOTS = 3, 1024
#: the golden ratio's fractional part in 2**-32 units, minus 2**32: i * step stays within 64 bits
_STEP, _TURN = 2654435769 - 2 ** 32, 2 ** 32
_KEY = ["is_null", "source_key"]


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, is_null, source_key, source, size, md5, bucket): one narrow row per document."""
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return docs.select("doc_id", F.col("source").isNull().alias("is_null"),
                       F.coalesce("source", F.lit("")).alias("source_key"),
                       F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       digest.alias("md5"), F.substring(digest, 1, _HEX).alias("bucket"))


def allot(sources: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Adds weight and target to (is_null, source_key, source_size): one row per source."""
    order = Window.orderBy(*_KEY)
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = sources.withColumn("weight", pick).withColumn("most", F.lit(float(cap)) * F.col("source_size"))
    everything = Window.partitionBy()
    by_level = Window.orderBy(F.col("most") / F.col("weight"), *_KEY)
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rows = (rows.withColumn("total", F.lit(float(share)) * F.sum("source_size").over(everything))
            .withColumn("left", F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
            .withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
            .withColumn("capped", F.col("left") / F.col("open") >= F.col("most") / F.col("weight")))
    rest = F.max(F.when(~F.col("capped"), F.struct("open", "left"))).over(everything)  # of the first one not capped
    target = F.when(F.col("capped"), F.col("most")).otherwise(
        F.col("weight") * (rest["left"] / rest["open"]))
    return (rows.withColumn("target", target)
            .select(*_KEY, "source_size", "weight", "target", F.floor("target").cast("long").alias("words")))


def _offsets(df: DataFrame, keys: list[str], order: str, value: str, name: str) -> DataFrame:
    """Total of ``value`` over the earlier buckets of each key."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.coalesce(F.sum(value).over(w), F.lit(0)).cast("long"))


def _point(slot: Column) -> Column:
    """frac(slot * golden ratio), in units of 2**-32."""
    return F.pmod(F.pmod(slot, F.lit(_TURN)) * F.lit(_STEP), F.lit(_TURN))


def schedule(spark: SparkSession, allotment: DataFrame, block_words: int = BLOCK_WORDS,
             cells: int = 1024) -> DataFrame:
    """(slot, is_null, source_key, block, take): the source and block of every slot, and the words it takes.

    ``allotment`` is a stored table with one row per source. Slots find their source by the cell of the
    unit interval their point lies in, so the lookup is an equality join however many sources there are.
    """
    share = F.nullif(F.sum("words").over(Window.partitionBy()), F.lit(0))  # without words no source has a span
    until = F.sum("words").over(Window.orderBy(*_KEY))
    edge = lambda words: F.round(words.cast("double") / share * _TURN).cast("long")
    spans = (allotment.select(*_KEY, "words", share.alias("total"), edge(until).alias("high"),
                              edge(until - F.col("words")).alias("low")).where("high > low"))
    width = _TURN // cells
    spans = spans.withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") / width),
                                                          F.floor((F.col("high") - 1) / width))))
    n = allotment.agg(F.ceil(F.coalesce(F.sum("words"), F.lit(0)) / block_words)).first()[0]
    slots = spark.range(n).select(F.col("id").alias("slot"), _point(F.col("id")).alias("point"))
    slots = (slots.withColumn("cell", F.floor(F.col("point") / width))
             .join(spans.select(*_KEY, "words", "low", "high", "cell"), "cell")
             .where("point >= low and point < high")
             .select("slot", *_KEY, "words", F.expr(f"slot div {_SLOTS}").alias("part")))
    counts = slots.groupBy(*_KEY, "part").agg(F.count("*").alias("n"))
    counts = _offsets(counts, _KEY, "part", "n", "before").select(*_KEY, "part", "before")
    rank = F.row_number().over(Window.partitionBy(*_KEY, "part").orderBy("slot"))
    ranked = slots.withColumn("rank", rank).join(counts, [*_KEY, "part"]).select(
        "slot", *_KEY, "words", (F.col("before") + F.col("rank") - 1).alias("block"))
    # sources whose slots end before their target: the missing blocks follow at the end
    got = slots.groupBy(*_KEY).agg(F.count("*").alias("n"))
    need = F.ceil(F.col("words") / block_words)
    short = (allotment.join(got, _KEY, "left").withColumn("n", F.coalesce("n", F.lit(0))).where(F.col("n") < need)
             .select(F.lit(n).cast("long").alias("slot"), *_KEY, "words",
                     F.explode(F.sequence(F.col("n"), need - 1)).alias("block")))
    take = F.least(F.lit(block_words), F.col("words") - F.col("block") * block_words)
    return ranked.unionByName(short).withColumn("take", take.cast("long")).where("take > 0").drop("words")


def _parts(docs: DataFrame, weights: tuple, share: float, cap: float, block_words: int) -> DataFrame:
    """Every (document, lap, block) with its slot, first word and words taken; also those that no slot takes."""
    spark = docs.sparkSession
    rows = written(sized(docs), "mix-sizes")
    buckets = rows.groupBy(*_KEY, "bucket").agg(F.sum("size").alias("words_in"))
    buckets = written(_offsets(buckets, _KEY, "bucket", "words_in", "before"), "mix-buckets")
    sources = buckets.groupBy(*_KEY).agg(F.sum("words_in").alias("source_size"))
    allotment = written(allot(sources, weights, share, cap), "mix-sources")

    by_bucket = Window.partitionBy(*_KEY, "bucket").orderBy("md5", "doc_id", "size")
    spread = rows.join(buckets.select(*_KEY, "bucket", "before"), [*_KEY, "bucket"])
    spread = (spread.withColumn("start", F.col("before") + F.sum("size").over(
                  by_bucket.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
              .withColumn("nth", F.row_number().over(by_bucket))
              .join(allotment.select(*_KEY, "source_size", "target"), _KEY))
    lap = F.explode_outer(F.when((F.col("size") > 0) & (F.col("target") > 0), F.sequence(
        F.lit(0).cast("long"), F.ceil(F.col("target") / F.col("source_size")) - 1)))
    pieces = spread.withColumn("lap", lap).withColumn("at", F.col("start") + F.col("lap") * F.col("source_size"))
    pieces = pieces.withColumn("block", F.explode_outer(F.sequence(
        F.expr(f"at div {block_words}"), F.expr(f"(at + size - 1) div {block_words}"))))
    slots = schedule(spark, allotment, block_words)
    joined = pieces.join(slots.select("slot", *_KEY, "block", "take"), [*_KEY, "block"], "left")
    first = F.col("block") * block_words
    begin = F.greatest(F.col("at"), first)
    words = F.greatest(F.lit(0), F.least(F.col("at") + F.col("size"), first + F.coalesce("take", F.lit(0))) - begin)
    return joined.withColumn("first_word", begin - F.col("at")).withColumn("words", words.cast("long"))


def mixed_pieces(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, cap: float = CAP,
                 block_words: int = BLOCK_WORDS) -> DataFrame:
    """(slot, source, block, at, doc_id, first_word, words): the mix, one row per piece of a document.

    In the order of (slot, source, block, at) the pieces are the mix: ``words`` words of the document from
    ``first_word`` (0 is its first) on; ``at`` is the piece's first word in its block. Blocks that make up
    for the schedule's discrepancy share the slot after the last one. Rows come in that order.
    """
    parts = _parts(docs, weights, share, cap, block_words).where("words > 0")
    at = F.col("at") + F.col("first_word") - F.col("block") * block_words
    source = F.when(~F.col("is_null"), F.col("source_key"))
    return (parts.select("slot", source.alias("source"), "block", at.alias("at"), "doc_id", "first_word", "words")
            .orderBy("slot", F.col("source").asc_nulls_last(), "block", "at"))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, cap: float = CAP,
        block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document: the pieces of the mix, added up."""
    return (_parts(docs, weights, share, cap, block_words)
            .groupBy(*_KEY, "bucket", "nth", "doc_id", "size", "source_size", "target")
            .agg(F.coalesce(F.sum("words"), F.lit(0)).cast("long").alias("taken"))
            .select("doc_id", "size", "source_size", "target", "taken"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: how much of each document the mix takes."""
    return mix(docs)


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                  md5(coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w FROM d GROUP BY source),
l AS (SELECT *, 1.5::DOUBLE * sum(source_size) OVER () AS total, 2.0::DOUBLE * source_size AS most FROM s),
f AS (SELECT *, total - coalesce(sum(most) OVER b, 0) AS rest, sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS open FROM l
      WINDOW b AS (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, CASE WHEN rest / open >= most / w THEN most ELSE w * (SELECT arg_max(rest / open, open) FROM f
      WHERE rest / open < most / w) END AS target FROM f),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS words,
             (sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS a
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(words, a + size) - a) + greatest(0, least(words - source_size, a + size) - a))::BIGINT AS taken FROM p
"""
