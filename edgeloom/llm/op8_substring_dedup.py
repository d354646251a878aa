"""Substring dedup with fixed-block anchors.

Any 50 consecutive words hold a whole block of 25 words of the other copy, if
blocks are cut at every 25th word of it. So the index holds the
non-overlapping 25-word blocks of every document, each rolling 25-word window
of every document probes it, and 50-word windows are looked at only around
hits. Those are compared by 96 bits of hash: the smallest doc_id with
each window is found, every later window is marked, and marked windows that
overlap or touch make up the maximal repeats that are cut.

Both questions go through ``chunks.exchange``: first which windows of 25 have
a counterpart (an answer may hold false hits, which the second one discards),
then which windows of 50 start in a document with a smaller id. Windows of
different chunks count as equal if 96 bits agree, windows of one chunk (under a
million) if 64 bits do.

Edge cases: a null or empty text has no words, nothing removed and kept text
"". Texts under 50 words keep all. Repeated rows with one doc_id never remove
from each other. A row with a null doc_id has no place in the order: it keeps
all its words and removes none. Very long texts are handled whole, in a chunk
of their own. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunks import Chunk, bucket_of, buckets_for, by_bucket, exchange, pack, planes, rows_of, unpack, unplanes, \
    with_replies
from .frames import table
from .words import SPACES, Splitter, Words, windows

WINDOW = 50
_SPLIT = Splitter(SPACES)
_KEY = np.uint64((1 << 30) - 1)
_SECOND = 0x2545F4914F6CDD1D  # salt of the second hash


def _known_windows(chunk: Chunk, words: Words, n: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Windows of ``n`` words of the rows with an id."""
    at, key = windows(words, n, salt)
    ok = chunk.known[words.row[at]] if len(at) else np.zeros(0, dtype=bool)
    return (at, key) if ok.all() else (at[ok], key[ok])


def _runs(key: np.ndarray) -> np.ndarray:
    """Where a new value begins in a sorted array."""
    return np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)


def ask_blocks(chunk: Chunk, buckets: int, block: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Each distinct window of ``block`` words: 30 bits of its hash, whether several documents of the
    chunk hold it, and whether it is a block of one of them."""
    words = _SPLIT.split(chunk.data, chunk.offsets)
    at, key = _known_windows(chunk, words, block)
    if not len(at):
        return
    doc = chunk.ids[words.row[at]]
    first = np.searchsorted(words.row, words.row[at])
    aligned = (at - first) % block == 0
    order = np.argsort(key, kind="stable")
    key, doc, aligned = key[order], doc[order], aligned[order]
    starts = _runs(key)
    several = np.minimum.reduceat(doc, starts) != np.maximum.reduceat(doc, starts)
    packed = ((key[starts] & _KEY) << np.uint64(2) | several.astype(np.uint64) << np.uint64(1)
              | np.logical_or.reduceat(aligned, starts)).astype(np.uint32)
    for bucket, some in by_bucket(bucket_of(key[starts], buckets)):
        yield bucket, planes(np.sort(packed[some])), b""


def answer_blocks(asked: list[tuple[bytes, bytes]]) -> list[tuple[bytes, bytes]]:
    """The keys that are a block somewhere and stand in several documents."""
    parts = [unplanes(a, np.uint32) for a, _ in asked]
    every = np.concatenate(parts)
    key = every >> 2
    order = np.argsort(key, kind="stable")
    key, flags = key[order], every[order] & 3
    starts = _runs(key)
    flag = np.bitwise_or.reduceat(flags, starts)
    size = np.diff(np.append(starts, len(key)))
    # a chunk may hold two hashes of one key: then the size is 2 as well, a false hit at worst
    hits = key[starts][(flag & 1 > 0) & ((size > 1) | (flag & 2 > 0))]
    out = []
    for p in parts:
        mine = np.unique(p >> 2)
        out.append((planes(mine[np.isin(mine, hits, assume_unique=True)]), b""))
    return out


def _near_hits(chunk: Chunk, words: Words, at: np.ndarray, replies: list[dict] | None, buckets: int, block: int,
               window: int) -> np.ndarray:
    """Which of the windows that begin at ``at`` hold a hit of ``block`` words."""
    if not replies or not len(at):
        return np.zeros(len(at), dtype=bool)
    hits = np.sort(np.concatenate([unplanes(r["a"], np.uint32).astype(np.uint64) | np.uint64(r["bucket"]) << np.uint64(30)
                                   for r in replies]))
    block_at, block_key = _known_windows(chunk, words, block)
    code = (block_key & _KEY) | bucket_of(block_key, buckets).astype(np.uint64) << np.uint64(30)
    place = np.searchsorted(hits, code)
    place[place == len(hits)] = 0
    found = np.zeros(len(words.hash) + 1, dtype=np.int64)
    found[block_at[hits[place] == code] + 1] = 1
    found = np.cumsum(found)  # hits that begin before a position
    return found[at + window - block + 1] > found[at]


def ask_windows(chunk: Chunk, replies: list[dict] | None, buckets: int, block: int,
                window: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Each distinct window near a hit: its hash, the smallest id of the chunk that holds it, 32 bits of a second hash."""
    words = _SPLIT.split(chunk.data, chunk.offsets)
    at, key = _known_windows(chunk, words, window)
    near = _near_hits(chunk, words, at, replies, buckets, block, window)
    if not near.any():
        return
    key, doc = key[near], chunk.ids[words.row[at[near]]]
    second = (_known_windows(chunk, words, window, _SECOND)[1][near] >> np.uint64(32)).astype(np.uint32)
    order = np.argsort(key, kind="stable")
    starts = _runs(key[order])
    key, doc, second = key[order][starts], np.minimum.reduceat(doc[order], starts), second[order][starts]
    for bucket, some in by_bucket(bucket_of(key, buckets)):
        yield bucket, planes(key[some]), planes(doc[some]) + planes(second[some])


def answer_windows(asked: list[tuple[bytes, bytes]]) -> list[tuple[bytes, bytes]]:
    """For each chunk the windows that a smaller id of another chunk holds; both hashes have to agree."""
    keys = [unplanes(a, np.uint64) for a, _ in asked]
    docs = [unplanes(b[:len(a)], np.int64) for a, b in asked]
    key, doc = np.concatenate(keys), np.concatenate(docs)
    second = np.concatenate([unplanes(b[len(a):], np.uint32) for a, b in asked])
    order = np.lexsort((second, key))
    k, s = key[order], second[order]
    starts = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (s[1:] != s[:-1])]))
    least = np.empty(len(key), dtype=np.int64)
    least[order] = np.repeat(np.minimum.reduceat(doc[order], starts), np.diff(np.append(starts, len(k))))
    late = np.split(least < doc, np.cumsum([len(x) for x in keys])[:-1])
    return [(planes(x[m]), b"") for x, m in zip(keys, late, strict=True)]


def covered(chunk: Chunk, words: Words, replies: list[dict] | None, window: int) -> np.ndarray:
    """Which words of the chunk a window covers that also starts in a document with a smaller id."""
    out = np.zeros(len(words.hash) + 1, dtype=np.int64)
    at, key = _known_windows(chunk, words, window)
    if len(at):
        doc = chunk.ids[words.row[at]]
        order = np.argsort(key, kind="stable")
        starts = _runs(key[order])
        size = np.diff(np.append(starts, len(key)))
        late = np.empty(len(at), dtype=bool)
        late[order] = doc[order] > np.repeat(np.minimum.reduceat(doc[order], starts), size)
        if replies:
            elsewhere = np.sort(np.concatenate([unplanes(r["a"], np.uint64) for r in replies]))
            place = np.searchsorted(elsewhere, key)
            place[place == len(elsewhere)] = 0
            late |= elsewhere[place] == key
        np.add.at(out, at[late], 1)
        np.add.at(out, at[late] + window, -1)
    return np.cumsum(out)[:-1] > 0


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                     ("spans", pa.list_(pa.list_(pa.int64()))), ("kept", pa.string())])


def cut_repeats(chunk: Chunk, replies: list[dict] | None, window: int) -> Iterator[pa.RecordBatch]:
    """Result rows of a chunk, in batches of some MB."""
    words = _SPLIT.split(chunk.data, chunk.offsets)
    gone = covered(chunk, words, replies, window)
    n = words.per_row()
    first = np.concatenate([[0], np.cumsum(n)])
    rows, size = [], 0
    for r in range(len(chunk.ids)):
        own = gone[first[r]:first[r + 1]]
        kept = chunk.text(r).split()  # bytes split at ASCII white space: the separators of words
        spans = []
        if own.any():
            edge = np.flatnonzero(np.diff(own, prepend=False, append=False))
            spans = edge.reshape(-1, 2).tolist()
            kept = [w for w, x in zip(kept, own.tolist(), strict=True) if not x]
        kept = b" ".join(kept)
        rows.append((int(chunk.ids[r]) if chunk.known[r] else None, int(n[r]), int(own.sum()), spans, kept.decode()))
        size += len(kept)
        if size > 4 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _RESULT, strict=True)], schema=_RESULT)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _RESULT, strict=True)], schema=_RESULT)


def dedup_substrings(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept): word spans cut from each document, and the text left.

    ``window``: words of the shortest repeat. Blocks are half as long, so that every window holds one.
    """
    block = (window + 1) // 2
    chunks = pack(docs)
    buckets = buckets_for(chunks)
    hits = exchange(chunks, buckets, lambda c, _: ask_blocks(c, buckets, block), answer_blocks)
    late = exchange(with_replies(chunks, hits), buckets,
                    lambda c, row: ask_windows(c, row["replies"], buckets, block, window), answer_windows)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in rows_of(b):
                yield from cut_repeats(unpack(row), row["replies"], window)

    return with_replies(chunks, late).mapInArrow(
        cut, "doc_id long, n_words long, n_removed long, spans array<array<long>>, kept string")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_substrings(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT r, doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM (
        SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50 AND doc_id IS NOT NULL)),
m AS (SELECT h, min(doc_id) AS least FROM x GROUP BY h),
g AS (SELECT DISTINCT r, unnest(range(i, i + 50)) AS k FROM x JOIN m USING (h) WHERE doc_id > least),
t AS (SELECT d.r, d.doc_id, d.w, list(g.k) FILTER (g.k IS NOT NULL) AS gone FROM d LEFT JOIN g ON g.r = d.r GROUP BY ALL)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(coalesce(CASE WHEN gone IS NULL THEN array_to_string(w, ' ') ELSE array_to_string(
         [w[k] for k in range(1, len(w) + 1) if NOT list_contains(gone, k)], ' ') END, '')) AS kept_sha256 FROM t
"""
