"""Texts packed into chunks, and hashes exchanged between chunks through Spark.

A corpus-wide question about hashes ("does this window occur elsewhere?") is
asked chunk by chunk: a chunk sends each of its distinct hashes once, in one
compact row per bucket; a bucket gathers the rows of all chunks, and answers
each chunk in one row. So a value that every document holds costs one entry
per chunk, a bucket's size is set by ``bucket_bytes`` of text, and texts are
never regrouped by value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import written
from .words import row_groups, text_buffers

#: a chunk is what a Python worker holds at a time, some 40 times its bytes at the peak
CHUNK_BYTES, BUCKET_BYTES = 2 << 20, 4 << 20
CHUNK_DDL = "chunk long, raw_bytes long, ids binary, known binary, lengths binary, texts binary"
_CHUNK = pa.schema([("chunk", pa.int64()), ("raw_bytes", pa.int64()), ("ids", pa.binary()), ("known", pa.binary()),
                    ("lengths", pa.binary()), ("texts", pa.binary())])


def planes(a: np.ndarray) -> bytes:
    """Bytes of an integer array, all high bytes first: sorted or small values compress well."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.dtype.itemsize).T[::-1]).tobytes() if len(a) else b""


def unplanes(raw: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(width, -1)[::-1].T).view(dtype).reshape(-1)


@dataclass
class Chunk:
    """Rows of one chunk: ids, whether each id is known (not null), and the texts as bytes."""

    id: int
    ids: np.ndarray
    known: np.ndarray
    data: np.ndarray
    offsets: np.ndarray

    def text(self, row: int) -> bytes:
        return self.data[self.offsets[row]:self.offsets[row + 1]].tobytes()


def pack(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(doc_id, text) as a stored table of compressed chunks; a null text becomes an empty one.

    ``doc_id`` must be a long. A text longer than ``chunk_bytes`` is a chunk of its own.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=3)
        for b in batches:
            data, offsets = text_buffers(b.column("text"))
            ids = b.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            known = b.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            for i, j in row_groups(offsets, chunk_bytes, 1 << 16):
                raw = data[offsets[i]:offsets[j]].tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((
                    uuid.uuid4().int >> 65, len(raw), planes(ids[i:j]), known[i:j].tobytes(),
                    planes(np.diff(offsets[i:j + 1])), codec.compress(raw, asbytes=True)), _CHUNK, strict=True)],
                    schema=_CHUNK)

    return written(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, CHUNK_DDL), "chunks")


def unpack(row: dict) -> Chunk:
    lengths = unplanes(row["lengths"], np.int64)
    raw = pa.Codec("zstd").decompress(row["texts"], decompressed_size=row["raw_bytes"], asbytes=True) if row["raw_bytes"] else b""
    return Chunk(row["chunk"], unplanes(row["ids"], np.int64), np.frombuffer(row["known"], dtype=bool),
                 np.frombuffer(raw, dtype=np.uint8), np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64))


def buckets_for(chunks: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """One bucket for each ``bucket_bytes`` of text."""
    return max(1, -(-(chunks.agg(F.sum("raw_bytes")).first()[0] or 0) // bucket_bytes))


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    for k in range(batch.num_rows):
        yield {n: batch.column(i)[k].as_py() for i, n in enumerate(batch.schema.names)}


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, positions) for each bucket that occurs."""
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for a, z in zip(edges, [*edges[1:], len(order)], strict=False):  # no edges if nothing is given
        yield int(bucket[order[a]]), order[a:z]


def exchange(chunks: DataFrame, buckets: int, ask: Callable[[Chunk, dict], Iterator[tuple[int, bytes, bytes]]],
             answer: Callable[[list[tuple[bytes, bytes]]], list[tuple[bytes, bytes]]]) -> DataFrame:
    """Stored answers, one row per chunk: (chunk, replies array<struct<bucket, a, b>>).

    ``ask(chunk, row)`` yields (bucket, keys, values) of a chunk; ``answer`` gets the (keys, values) of all chunks
    for one bucket, and returns one (keys, values) for each, in order; empty keys mean no answer. The answers are
    written by a task a bucket at most.
    """
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in rows_of(b):
                out = list(ask(unpack(row), row))
                yield pa.RecordBatch.from_arrays([
                    pa.array([o[0] for o in out], pa.int64()), pa.array([row["chunk"]] * len(out), pa.int64()),
                    pa.array([o[1] for o in out], pa.binary()), pa.array([o[2] for o in out], pa.binary())],
                    names=["bucket", "chunk", "a", "b"])

    def gather(t: pa.Table) -> pa.Table:
        views = [[v.as_buffer() for v in t.column(c)] for c in ("a", "b")]  # of the batch's bytes, not copies
        got = answer(list(zip(*views, strict=True)))
        keep = pa.array([k for k, (a, _) in enumerate(got) if a], pa.int64())
        return pa.Table.from_arrays([t.column("bucket").take(keep), t.column("chunk").take(keep),
                                     pa.array([a for a, _ in got if a], pa.binary()),
                                     pa.array([b for a, b in got if a], pa.binary())],
                                    names=["bucket", "chunk", "a", "b"])

    ddl = "bucket long, chunk long, a binary, b binary"
    replies = chunks.mapInArrow(send, ddl).groupBy("bucket").applyInArrow(gather, ddl)
    return written(replies.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "a", "b")).alias("replies")), "replies", files=buckets)


def with_replies(chunks: DataFrame, replies: DataFrame) -> DataFrame:
    """Each chunk with its answers (null if it got none)."""
    return chunks.join(replies, "chunk", "left")
