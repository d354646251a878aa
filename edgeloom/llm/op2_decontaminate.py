"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The alphabet is words. Patterns are the windows of 13 words of the benchmark
items (an item of fewer words is one pattern). Patterns of one length form a
matcher: a shift table over blocks of two words says how far the search may
jump, patterns that end with the block are bucketed by it and by their first
words, and a direct comparison of all words confirms an occurrence. One-word
patterns have no block of two; they use blocks of one. Words are numbers, all
tables are flat arrays: some 40 bytes a benchmark word, and its vocabulary once.

The patterns are the stated query set, and go to the executors in blocks of
at most ``block_words`` words, so a broadcast never exceeds that size however
large the benchmark grows; with several blocks each reads the documents, and
the hits of a document are merged.

Edge cases: a null or empty text has no words, no hits and is not
contaminated; an item without words (or null) has no windows; an item with a
null id still hits words but is not listed or counted. Repeated items with
one id count once. Rows that repeat (or share a null ``doc_id``) are answered
each. Other columns of either table are not read, except that
``drop_contaminated`` returns all columns of the documents.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .frames import columns, free_name, map_batches, table, written
from .words import mix

WINDOW = 13
#: ASCII separators become spaces, A-Z become a-z; all other bytes stay
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words of ASCII letters, digits and any character beyond ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split() if text else []


class WuManber:
    """Finds all patterns of one length, the windows of some items, in a sequence of word numbers."""

    def __init__(self, length: int, vocabulary: dict[bytes, int], flat: np.ndarray, first: np.ndarray, size: np.ndarray,
                 items: list[int | None]):
        """``flat``: the words of all items; ``first``, ``size``: where the items of this length are in it, and how many
        words they have; ``items``: their ids."""
        self.length, self.block, self.vocabulary, self.flat, self.items = length, min(2, length), vocabulary, flat, items
        owner = np.repeat(np.arange(len(first)), size)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
        keys = self._keys(flat)
        # shift of a block: how far the nearest end of a pattern after it is, in any item
        inside = offset + self.block <= size[owner]
        at, step = (first[owner] + offset)[inside], np.maximum(0, length - self.block - offset[inside])
        order = np.lexsort((step, keys[at]))
        key = keys[at][order]
        new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, dtype=bool)
        self.shift_key, self.shift = key[new], step[order][new].astype(np.int32)
        # patterns, bucketed by their last and first block
        window = offset + length <= size[owner]
        start, item = (first[owner] + offset)[window], owner[window].astype(np.int32)
        bucket = self._bucket(keys[start + length - self.block], keys[start])
        order = np.argsort(bucket, kind="stable")
        self.bucket, self.start, self.item = bucket[order], start[order], item[order]

    def _keys(self, words: np.ndarray) -> np.ndarray:
        """The block that begins at each word, as a number; -1 if a word is unknown (or the block would not end)."""
        if self.block == 1:
            return words.astype(np.int64)
        out = np.full(len(words), -1, dtype=np.int64)
        if len(words) > 1:
            a, b = words[:-1].astype(np.int64), words[1:].astype(np.int64)
            out[:-1] = np.where((a < 0) | (b < 0), -1, a * len(self.vocabulary) + b)
        return out

    @staticmethod
    def _bucket(last: np.ndarray, first: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix(last.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ first.astype(np.uint64))

    def find(self, words: np.ndarray) -> Iterator[tuple[int, list[int]]]:
        """(start, items) of each occurrence, by start."""
        m, b, n = self.length, self.block, len(words)
        if n < m or not len(self.start):
            return
        keys = self._keys(words)
        place = np.minimum(np.searchsorted(self.shift_key, keys), len(self.shift_key) - 1)
        steps = np.where(self.shift_key[place] == keys, self.shift[place], m - b + 1).tolist()
        ends, end = [], m
        while end <= n:
            step = steps[end - b]
            if step:
                end += step
            else:
                ends.append(end)
                end += 1
        if not ends:
            return
        start = np.array(ends) - m
        bucket = self._bucket(keys[start + m - b], keys[start])
        low, high = np.searchsorted(self.bucket, bucket, "left"), np.searchsorted(self.bucket, bucket, "right")
        for at, i, j in zip(start.tolist(), low.tolist(), high.tolist(), strict=True):
            hits = [k for k in range(i, j) if np.array_equal(self.flat[self.start[k]:self.start[k] + m], words[at:at + m])]
            if hits:
                ids = {self.items[self.item[k]] for k in hits}
                yield at, sorted(i for i in ids if i is not None)


def matchers(items: Iterable[tuple[int | None, str | None]], window: int = WINDOW) -> list[WuManber]:
    """A matcher for each pattern length: the windows of items, and whole items of fewer words."""
    vocabulary: dict[bytes, int] = {}
    flat, sizes, ids = array("i"), [], []
    for item, text in items:
        words = words_of(text)
        flat.extend(vocabulary.setdefault(w, len(vocabulary)) for w in words)
        sizes.append(len(words))
        ids.append(item)
    flat, size = np.frombuffer(flat, dtype=np.int32) if flat else np.zeros(0, dtype=np.int32), np.array(sizes, dtype=np.int64)
    first, out = np.cumsum(size) - size, []
    for length in np.unique(np.minimum(size, window)).tolist():
        if length:
            mine = np.flatnonzero(np.minimum(size, window) == length)
            out.append(WuManber(length, vocabulary, flat, first[mine], size[mine], [ids[k] for k in mine]))
    return out


def search(text: str | None, found: list[WuManber]) -> tuple[int, list[tuple[int, int]], set[int]]:
    """(words, merged hit spans in words, items with occurrences) of one whole text."""
    words = words_of(text)
    spans, items = [], set()
    known = found[0].vocabulary.get if found else None
    numbers = np.array([known(w, -1) for w in words], dtype=np.int32) if found else None
    for matcher in found:
        for start, ids in matcher.find(numbers):
            spans.append((start, start + matcher.length))
            items.update(ids)
    return len(words), merge_spans(spans), items


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], z))
        else:
            out.append((a, z))
    return out


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[int, str]]]:
    """Benchmark items in blocks of about ``block_words`` words, one block at a time on the driver."""
    block, size = [], 0
    for r in benchmark.select("item_id", "text").toLocalIterator():
        block.append((r[0], r[1]))
        size += len(words_of(r[1]))
        if size >= block_words:
            yield block
            block, size = [], 0
    if block:
        yield block


def _scan(docs: DataFrame, block: list[tuple[int, str]], window: int, prefix: str, text: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(block)
    found: list = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not found:
            found.extend(matchers(shared.value, window))
        for b in batches:
            got = [search(t.as_py(), found) for t in b.column(at)]
            yield pa.RecordBatch.from_arrays([
                *b.columns, pa.array([g[0] for g in got], pa.int64()),
                pa.array([[list(s) for s in g[1]] for g in got], pa.list_(pa.list_(pa.int64()))),
                pa.array([sorted(g[2]) for g in got], pa.list_(pa.int64())),
            ], names=[*b.schema.names, f"{prefix}n", f"{prefix}spans", f"{prefix}items"])

    extra = StructType.fromDDL(f"{prefix}n long, {prefix}spans array<array<long>>, {prefix}items array<long>")
    at = docs.columns.index(text)
    return map_batches(docs, run, extra)


def find_windows(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = 2_000_000,
                 prefix: str = "_hit_", text: str = "text") -> DataFrame:
    """``docs`` with ``{prefix}n`` (words), ``{prefix}spans`` (merged hit word spans) and ``{prefix}items``."""
    blocks = _blocks(benchmark, block_words)
    out = _scan(docs, next(blocks, []), window, prefix, text)
    for k, block in enumerate(blocks):  # a benchmark beyond one block: each further block reads what the last one wrote
        more = _scan(written(out, "decontaminate"), block, window, f"_more{k}_{prefix}", text)
        s, m = F.col(f"{prefix}spans"), F.col(f"_more{k}_{prefix}spans")
        out = (more.withColumn(f"{prefix}spans", _merged(F.array_sort(F.concat(s, m))))
               .withColumn(f"{prefix}items", F.array_sort(F.array_union(f"{prefix}items", f"_more{k}_{prefix}items")))
               .drop(*[f"_more{k}_{prefix}{c}" for c in ("n", "spans", "items")]))
    return out


def _merged(spans):
    """Sorted spans, overlapping or touching ones joined."""
    def step(done, s):
        last = F.element_at(done, -1)
        return F.when((F.size(done) == 0) | (s[0] > last[1]), F.concat(done, F.array(s))).otherwise(
            F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.array(last[0], F.greatest(last[1], s[1])))))
    return F.aggregate(spans, F.array().cast("array<array<long>>"), lambda d, s: F.when(F.size(d) == 0, F.array(s)).otherwise(step(d, s)))


def verdicts(hits: DataFrame, prefix: str = "_hit_") -> DataFrame:
    """Adds n_words, n_hit, n_items, items_sha256 and contaminated to the result of ``find_windows``."""
    n_hit = F.aggregate(f"{prefix}spans", F.lit(0).cast("long"), lambda s, x: s + x[1] - x[0])
    names = F.array_join(F.array_sort(F.transform(f"{prefix}items", lambda i: i.cast("string"))), ",")
    return hits.select("*", F.col(f"{prefix}n").alias("n_words"), n_hit.alias("n_hit"),
                       F.size(f"{prefix}items").cast("long").alias("n_items"),
                       F.sha2(names, 256).alias("items_sha256"),
                       contaminated(F.col(f"{prefix}n"), n_hit).alias("contaminated"))


def contaminated(n_words, n_hit):
    return (n_hit > 0) & (20 * n_hit >= n_words)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that are not contaminated, with their columns."""
    prefix = free_name(docs, "_hit_")
    hits = find_windows(docs, table(spark, sf_dir, "benchmark"), prefix=prefix)
    n_hit = F.aggregate(f"{prefix}spans", F.lit(0).cast("long"), lambda s, x: s + x[1] - x[0])
    return hits.where(~contaminated(F.col(f"{prefix}n"), n_hit)).select(*columns(docs))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = find_windows(docs, table(spark, sf_dir, "benchmark"))
    return verdicts(hits).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS s
      FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
o AS (SELECT x.r, x.i, x.n, p.item_id FROM (
        SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS s FROM (
          SELECT d.r, d.w, l.n, unnest(range(1, len(d.w) - l.n + 2)) AS i FROM d, (SELECT DISTINCT n FROM p) l)) x
      JOIN p ON p.s = x.s AND p.n = x.n),
h AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM (SELECT DISTINCT r, i, n FROM o)) GROUP BY r),
t AS (SELECT r, count(item_id) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s
      FROM (SELECT DISTINCT r, item_id FROM o WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)
"""
