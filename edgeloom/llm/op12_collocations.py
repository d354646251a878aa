"""Phrase collocation mining with mergeable Misra-Gries summaries.

1. Texts are packed into chunks of one language. A chunk counts its distinct
   phrases of 1 to ``max_words`` words (words are numbered by their bytes, phrases
   by the numbers of a shorter phrase and a word, so no hash decides equality)
   and sends their hashes and counts to hash partitions: each such row is a
   Misra-Gries summary without error.
2. A hash partition merges its summaries. Its capacity exceeds the mass (sum
   of counts) divided by the threshold. Whenever the merged summary holds more
   entries, the count of the first one beyond the capacity is taken from all.
   Each unit taken off removes more than mass / threshold from the mass, so
   less than the threshold is ever taken from one entry, and every phrase
   that occurs that often survives. Keys that fall together only survive
   more easily. Partitions follow the bytes of text, so none grows with the corpus.
3. Second pass: every chunk counts its surviving phrases exactly and returns
   them as text; sums below the threshold are dropped. Parts of a frequent phrase
   are frequent as well, so all numbers that scores need are in that table.
4. Scores are exact integers (decimals of 38 digits), the ranking is made in
   two steps, so that a language with most candidates is ranked in many tasks.

Edge cases: a null or empty text has no words; a null lang is ``und``, with
the rows that say so. Repeated rows count each. Very long texts are chunks of
their own and are counted whole. An empty table, or one without any frequent
phrase, gives an empty result. ``doc_id`` and other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .chunks import CHUNK_BYTES, Chunk, bucket_of, buckets_for, by_bucket, exchange, planes, rows_of, unpack, unplanes, \
    with_replies
from .frames import table, written
from .words import Splitter, mix, row_groups, text_buffers

MAX_WORDS, THRESHOLD, LONGER_PERCENT, TOP = 3, 10, 50, 2000
_BLANKS, _STOPS = b" \t", b".,;:!?\n\x0b\x0c\r"
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
_KIND = np.array([1 if b in _BLANKS else 2 if b in _STOPS else 0 for b in range(256)], dtype=np.uint8)
_WHOLE = Splitter(b"")
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SALTS = 64
#: bits of a hash inside its partition: with some 2**20 phrases there, few rare ones fall on a frequent one (and are just counted)
_KEY = np.uint64((1 << 24) - 1)
#: larger chunks send fewer rows, as a phrase is sent once a chunk
_CHUNK = 2 * CHUNK_BYTES


@dataclass
class Phrases:
    """Distinct phrases of one length: numbers of their words, hash and count."""

    words: np.ndarray   # (phrases, length)
    hash: np.ndarray
    count: np.ndarray


def split_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(number of each word, the distinct lower-cased words, piece of each word) of the texts of a chunk."""
    if not len(data):
        return np.zeros(0, dtype=np.int64), pa.array([], pa.binary()), np.zeros(0, dtype=np.int64)
    data = _LOWER[data]
    kind = _KIND[data]
    word = kind == 0
    edges = np.unique(offsets[:-1][offsets[:-1] < len(data)])
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    first[edges] = word[edges]
    last[:-1] &= ~word[1:]
    last[edges[1:] - 1] = word[edges[1:] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    piece = np.searchsorted(np.sort(np.concatenate([np.flatnonzero(kind == 2), edges])), starts, "right")
    cuts = np.concatenate([[0], np.cumsum(ends - starts)])
    all_words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(cuts.astype(np.int64)),
                                                                                 pa.py_buffer(data[word])])
    coded = all_words.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary, piece


def phrases(chunk: Chunk, lang: str, max_words: int) -> tuple[pa.Array, list[Phrases], int]:
    """(distinct words, phrases of 1 to ``max_words`` words inside pieces, number of words) of a chunk of one language."""
    number, vocabulary, piece = split_words(chunk.data, chunk.offsets)
    size = len(vocabulary)
    raw, cuts = text_buffers(vocabulary)
    own = _WHOLE.split(raw, cuts).hash
    seed = np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest()))
    out, at = [], np.arange(len(number))
    words, code, hashes = np.arange(size)[:, None], number, mix(own ^ seed)
    for n in range(1, max_words + 1):
        if n > 1:  # a phrase is a shorter one, by its number, and a word
            go = (at + n - 1 < len(number))
            go[go] = piece[at[go]] == piece[at[go] + n - 1]
            at, code = at[go], code[go]
            pair, code = np.unique(code * max(size, 1) + number[at + n - 1], return_inverse=True)
            short, word = pair // max(size, 1), pair % max(size, 1)
            words = np.column_stack([words[short], word])
            hashes = mix(hashes[short] * _ODD + own[word])
        out.append(Phrases(words, hashes, np.bincount(code, minlength=len(words)).astype(np.int64)))
    return vocabulary, out, len(number)


def summarise(chunk: Chunk, lang: str, buckets: int, max_words: int) -> Iterator[tuple[int, bytes, bytes]]:
    """A chunk's summary for each hash partition: 24 bits of each phrase's hash, and its count."""
    _, found, _ = phrases(chunk, lang, max_words)
    key, count = (np.concatenate([getattr(p, c) for p in found]) for c in ("hash", "count"))
    for bucket, some in by_bucket(bucket_of(key, buckets)):
        low = (key[some] & _KEY).astype(np.uint32)
        order = np.argsort(low, kind="stable")
        yield bucket, planes(low[order]), planes(count[some][order].astype(np.uint32))


def merge(key: np.ndarray, count: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Misra-Gries summaries, one after the other, as one of at most ``capacity`` entries, and what was taken off."""
    key, where = np.unique(key, return_inverse=True)
    count, off = np.bincount(where, count, minlength=len(key)).astype(np.int64), 0
    if len(key) > capacity:
        off = int(np.partition(count, len(count) - capacity - 1)[len(count) - capacity - 1])
        key, count = key[count > off], count[count > off] - off
    return key, count, off


def survivors(asked: list[tuple[bytes, bytes]], threshold: int) -> list[tuple[bytes, bytes]]:
    """For each summary of a hash partition its keys that, by the merged summary, may reach the threshold."""
    counts = [unplanes(b, np.uint32) for _, b in asked]
    capacity = sum(int(c.sum(dtype=np.int64)) for c in counts) // threshold + 1
    key, count, taken = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64), 0
    held_key, held_count, held = [], [], 0
    for (a, _), c in zip(asked, counts, strict=True):
        held_key.append(unplanes(a, np.uint32))
        held_count.append(c)
        held += len(c)
        if held > capacity:  # several small summaries are merged at a time
            key, count, off = merge(np.concatenate([key, *held_key]), np.concatenate([count, *held_count]), capacity)
            held_key, held_count, held, taken = [], [], 0, taken + off
    key, count, off = merge(np.concatenate([key, *held_key]), np.concatenate([count, *held_count]), capacity)
    key = key[count + taken + off >= threshold]
    out = []
    for a, _ in asked:
        mine = np.unique(unplanes(a, np.uint32))
        out.append((planes(mine[np.isin(mine, key, assume_unique=True)]), b""))
    return out


def count_survivors(chunk: Chunk, lang: str, replies: list[dict] | None, buckets: int, max_words: int) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, count) of a chunk's surviving phrases; a null phrase counts all words."""
    vocabulary, found, words = phrases(chunk, lang, max_words)
    names = ["lang", "phrase", "count"]
    yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([None], pa.string()), pa.array([words], pa.int64())], names=names)
    if not replies:
        return
    alive = np.sort(np.concatenate([unplanes(r["a"], np.uint32).astype(np.uint64) | np.uint64(r["bucket"]) << np.uint64(32) for r in replies]))
    for p in found:
        code = (p.hash & _KEY) | bucket_of(p.hash, buckets).astype(np.uint64) << np.uint64(32)
        place = np.searchsorted(alive, code)
        place[place == len(alive)] = 0
        hit = alive[place] == code
        if not hit.any():
            continue
        parts = [vocabulary.take(pa.array(col)) for col in p.words[hit].T]
        text = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary())) if len(parts) > 1 else parts[0]
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(text), pa.string()), text.cast(pa.binary()).cast(pa.string()),
                                          pa.array(p.count[hit])], names=names)


def pack_by_lang(docs: DataFrame, chunk_bytes: int = _CHUNK) -> DataFrame:
    """Stored chunks of (lang, text), each of one language."""
    ddl = "chunk long, raw_bytes long, ids binary, known binary, lengths binary, texts binary, lang string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=3)
        for b in batches:
            langs = b.column("lang").dictionary_encode()
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                data, offsets = text_buffers(b.column("text").filter(pc.equal(langs.indices, k)))
                for i, j in row_groups(offsets, chunk_bytes, 1 << 16):
                    raw = data[offsets[i]:offsets[j]].tobytes()
                    yield pa.RecordBatch.from_pylist([{
                        "chunk": uuid.uuid4().int >> 65, "raw_bytes": len(raw), "ids": planes(np.zeros(j - i, dtype=np.int64)),
                        "known": bytes(j - i), "lengths": planes(np.diff(offsets[i:j + 1])),
                        "texts": codec.compress(raw, asbytes=True), "lang": lang}], schema=schema)

    schema = pa.schema([("chunk", pa.int64()), ("raw_bytes", pa.int64()), *((c, pa.binary()) for c in ("ids", "known", "lengths", "texts")),
                        ("lang", pa.string())])
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").where("text is not null and text <> ''")
    return written(rows.mapInArrow(run, ddl), "chunks")


def frequent_phrases(docs: DataFrame, max_words: int = MAX_WORDS, threshold: int = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Stored (lang, phrase, words, a) of every phrase that occurs ``threshold`` times or more, and (lang, n) of all words."""
    chunks = pack_by_lang(docs)
    buckets = buckets_for(chunks)
    replies = exchange(chunks, buckets, lambda c, row: summarise(c, row["lang"], buckets, max_words), lambda asked: survivors(asked, threshold))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in rows_of(b):
                yield from count_survivors(unpack(r), r["lang"], r["replies"], buckets, max_words)

    sums = (with_replies(chunks, replies).mapInArrow(run, "lang string, phrase string, count long")
            .groupBy("lang", "phrase").agg(F.sum("count").alias("a")))
    sums = written(sums.where((F.col("a") >= threshold) | F.col("phrase").isNull())
                   .withColumn("words", F.size(F.split("phrase", " "))), "phrases")
    return sums.where("phrase is not null"), sums.where("phrase is null").select("lang", F.col("a").alias("n"))


def _exact(c: str) -> Column:
    return F.col(c).cast("decimal(15,0)")


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, threshold: int = THRESHOLD, longer_percent: int = LONGER_PERCENT,
                 top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    A phrase is as good as its worst cut into two parts: floor(1000000 * a * a / (l * r)). Phrases inside a longer
    candidate that occurs ``longer_percent`` % as often or more are left out.
    """
    frequent, totals = frequent_phrases(docs, max_words, threshold)
    several = frequent.where("words > 1").withColumn("w", F.split("phrase", " "))
    part = "array_join(slice(w, {}, {}), ' ')".format
    inner = several.where("words > 2").select("lang", "a", F.expr(
        f"explode(flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1), i -> {part('i', 'm')}))))").alias("phrase"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    several = several.join(inner, ["lang", "phrase"], "left").where(f"longer is null or 100 * longer < {longer_percent} * a")
    cuts = several.select("lang", "phrase", "a", F.expr(
        f"explode(flatten(transform(sequence(1, words - 1), k -> array(struct(k, 'l' as side, {part(1, 'k')} as part), "
        f"struct(k, 'r' as side, {part('k + 1', 'words - k')} as part)))))").alias("cut")).select("lang", "phrase", "a", "cut.*")
    sizes = frequent.select("lang", F.col("phrase").alias("part"), F.col("a").alias("size"))
    side = lambda s: F.max(F.when(F.col("side") == s, F.col("size"))).alias(s)
    kept = (cuts.join(sizes, ["lang", "part"]).repartition("lang", "phrase")
            .groupBy("lang", "phrase", "a", "k").agg(side("l"), side("r"))
            .withColumn("top", F.lit(1000000).cast("decimal(7,0)") * _exact("a") * _exact("a")).withColumn("low", _exact("l") * _exact("r"))
            .groupBy("lang", "phrase", "a").agg(F.min(F.expr("struct(top div low as score, k, l, r)")).alias("cut"))
            .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    first = F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))
    best = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS))).withColumn("rank", first).where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = rf"""
WITH p AS (SELECT lang, regexp_extract_all(t, '[^\x20\x09]+') AS w FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS t FROM documents)),
t AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
g AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, w[i:i + m - 1] AS w FROM (
        SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM p, range(1, {MAX_WORDS + 1}) r(m) WHERE len(w) >= m)),
f AS (SELECT lang, m, phrase, any_value(w) AS w, count(*) AS a FROM g GROUP BY lang, m, phrase HAVING count(*) >= {THRESHOLD}),
c AS (SELECT lang, m, phrase, w, a, unnest(range(1, m)) AS k FROM f WHERE m > 1),
s AS (SELECT c.lang, c.m, c.phrase, c.a, c.k, x.a AS l, y.a AS r, 1000000::HUGEINT * c.a * c.a // (x.a::HUGEINT * y.a) AS score
      FROM c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ')
             JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (SELECT lang, phrase, max(a) AS longer FROM (SELECT lang, a, array_to_string(w[j:j + m - 2], ' ') AS phrase FROM (
        SELECT lang, a, w, m, unnest(range(1, 3)) AS j FROM f WHERE m = 3)) GROUP BY lang, phrase),
k AS (SELECT b.* FROM b LEFT JOIN i ON i.lang = b.lang AND i.phrase = b.phrase WHERE longer IS NULL OR 100 * longer < {LONGER_PERCENT} * b.a),
z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM k)
SELECT z.lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM z JOIN t ON t.lang = z.lang WHERE rank <= {TOP}
"""
