"""N-gram Jaccard join with set-relation skipping: its links, links per document, and their components.

Sets are the distinct word shingles of whole texts, as 64-bit hashes. Tokens
are ordered by document frequency (counted over all documents by
``chunks.exchange``), rare ones first. Linked sets share a token among their
first n - ceil(t n) + 1 tokens; a set whose prefix holds only tokens of
its own has no partner, which settles most documents without a join.

Set relations save the rest of the work:

* Equal sets are one set (their first document stands for the class).
* Each remaining set is first compared with one similar set, its pivot: the
  smallest that shares a prefix token. The links found give first components.
* A set that its pivot did not link is compared, for a few turns, with one set
  of another component from its lists; while these link many, lists shrink.
* Index lists then serve only pairs of different components: lists of one
  component are skipped, a pair whose sets were both compared with one
  pivot is derived from those answers (Jaccard distance is a metric: the pair
  is too far if its distances differ by more than 1 - t). Lists are in order of
  component and position and are cut into blocks of ``_BLOCK`` entries, rows of
  their own, so a list of any length is many tasks' work; of two blocks of a
  list those are skipped that hold one component, or where the tokens left after
  the position cannot make up the overlap. Only what remains is compared.

So components of copies of any size need one comparison a set, and pairs inside
a component are not made for them; ``jaccard_components`` (and the pipeline's
stage) stops there. The join goes on: every link lies inside a component, so
the sets of each component are cut into blocks of similar ones, and blocks
whose index entries leave room for the overlap meet. There the answers of one set,
the block's pivot, are computed against all sets of the other block, and those
of the sets like it are derived from them: the pivot's overlap, less the tokens a
set lacks, plus those it has more. ``jaccard_links`` gives the links between
classes of equal sets, ``jaccard_join`` the number of links of each document. All
comparisons are exact on the hashes.

Edge cases: a null or empty text has the empty set, n_shingles 0 and links
with nothing; fewer words than a shingle make one shingle of all of them.
Rows that repeat a doc_id are one document in the graph (a link of either
counts) and are returned each. A null ``doc_id`` is in no link and has a null
component. ``n_links`` counts texts with an id: rows that repeat id and set
count once, an id with several sets once for each that links. Other columns
are not read; ``drop_duplicates`` keeps them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunks import Chunk, bucket_of, buckets_for, by_bucket, exchange, pack, planes, rows_of, unpack, unplanes, \
    with_replies
from .components import components
from .frames import columns, table, written
from .words import SPACES, Splitter, mix, windows

_SPLIT = Splitter(SPACES, lower=True)
#: entries of a block of an index list; sets and tokens of a block of one component, and cells of a matrix of 0 and 1
_BLOCK = 256
_GROUP, _GROUP_TOKENS, _CELLS = 256, 1 << 17, 1 << 22
#: turns in which a set meets one set of another component
_TURNS = 6
_SAME = ["n", "d1", "d2"]


def shingles(chunk: Chunk, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each distinct shingle, by row; short texts have one of all their words."""
    words = _SPLIT.split(chunk.data, chunk.offsets)
    at, key = windows(words, size)
    row = words.row[at]
    count = words.per_row()
    for n in range(1, size):
        if (short := count == n).any():
            s_at, s_key = windows(words, n)
            own = short[words.row[s_at]]
            row, key = np.concatenate([row, words.row[s_at[own]]]), np.concatenate([key, s_key[own]])
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    return row[new], key[new]


def ask_frequency(chunk: Chunk, buckets: int, size: int) -> Iterator[tuple[int, bytes, bytes]]:
    """32 bits of each distinct shingle of a chunk, and how many rows of the chunk hold it."""
    _, key = shingles(chunk, size)
    if not len(key):
        return
    key, n = np.unique(key, return_counts=True)
    for bucket, some in by_bucket(bucket_of(key, buckets)):
        low = (key[some] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        order = np.argsort(low, kind="stable")
        yield bucket, planes(low[order]), planes(n[some][order].astype(np.uint32))


def answer_frequency(asked: list[tuple[bytes, bytes]]) -> list[tuple[bytes, bytes]]:
    """Keys that two rows or more hold, with their number of rows."""
    keys = [unplanes(a, np.uint32) for a, _ in asked]
    known, where = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(where, np.concatenate([unplanes(b, np.uint32) for _, b in asked])).astype(np.int64)
    out = []
    for k in keys:
        n = total[np.searchsorted(known, k)]
        out.append((planes(k[n > 1]), planes(np.minimum(n[n > 1], 2 ** 32 - 1).astype(np.uint32))))
    return out


_SETS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()),
                   ("alone", pa.int64()), ("tokens", pa.binary())])
_SETS_DDL = "doc_id long, n long, d1 long, d2 long, alone long, tokens binary"


def ordered_sets(chunk: Chunk, replies: list[dict] | None, buckets: int, size: int, percent: int) -> pa.RecordBatch:
    """Each row's set size; for those that may have partners two digests, how many tokens no other row
    holds (``alone``), and the tokens, rare ones first."""
    row, key = shingles(chunk, size)
    many = np.ones(len(key), dtype=np.int64)
    if replies and len(key):
        code = np.concatenate([unplanes(r["a"], np.uint32).astype(np.uint64) | np.uint64(r["bucket"]) << np.uint64(32)
                               for r in replies])
        value = np.concatenate([unplanes(r["b"], np.uint32) for r in replies]).astype(np.int64)
        order = np.argsort(code)
        code, value = code[order], value[order]
        mine = (key & np.uint64(0xFFFFFFFF)) | bucket_of(key, buckets).astype(np.uint64) << np.uint64(32)
        place = np.searchsorted(code, mine)
        place[place == len(code)] = 0
        many = np.where(code[place] == mine, value[place], 1)
    order = np.lexsort((key, many, row))
    row, key, many = row[order], key[order], many[order]
    rows = len(chunk.ids)
    n = np.bincount(row, minlength=rows)
    alone = np.bincount(row[many == 1], minlength=rows)
    first = np.concatenate([[0], np.cumsum(n)])
    with np.errstate(over="ignore"):
        d1 = np.concatenate([[np.uint64(0)], np.cumsum(key)])
        d2 = np.concatenate([[np.uint64(0)], np.cumsum(mix(key ^ np.uint64(0x5851F42D4C957F2D)))])
        d1, d2 = d1[first[1:]] - d1[first[:-1]], d2[first[1:]] - d2[first[:-1]]
    open_ = (n > 0) & (100 * (n - alone) >= percent * n) & chunk.known
    return pa.RecordBatch.from_arrays([
        pa.array(chunk.ids, mask=~chunk.known), pa.array(n.astype(np.int64)),
        pa.array(d1.astype(np.uint64).view(np.int64), mask=~open_), pa.array(d2.astype(np.uint64).view(np.int64), mask=~open_),
        pa.array(alone.astype(np.int64)),
        pa.array([key[first[r]:first[r + 1]].tobytes() if open_[r] else None for r in range(rows)], pa.binary()),
    ], schema=_SETS)


def need(n, percent: int):
    """Tokens that a set of ``n`` shares with any set it links with, at least."""
    return -(-percent * n // 100)


def postings(sets: DataFrame, percent: int) -> DataFrame:
    """(token, rep, n, pos) of the prefix tokens that other documents hold too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            token, rep, size, pos = [], [], [], []
            for r in rows_of(b):
                a, z = r["alone"], r["n"] - need(r["n"], percent) + 1
                if a < z:
                    token.append(np.frombuffer(r["tokens"], dtype=np.int64)[a:z])
                    pos.append(np.arange(a, z))
                    rep.append(np.full(z - a, r["rep"]))
                    size.append(np.full(z - a, r["n"]))
            if token:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (token, rep, size, pos)],
                                                 names=["token", "rep", "n", "pos"])

    return sets.select("rep", "n", "alone", "tokens").mapInArrow(run, "token long, rep long, n long, pos long")


def compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, common, total): exact sizes of intersection and union for pairs (a, b) of representatives."""
    own = sets.select(F.col("rep").alias("a"), F.col("tokens").alias("x"))
    other = sets.select(F.col("rep").alias("b"), F.col("tokens").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            common, total = [], []
            for x, y in zip(b.column("x"), b.column("y"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.int64) for v in (x, y))
                both = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                common.append(both)
                total.append(len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(common, pa.int64()),
                                              pa.array(total, pa.int64())], names=["a", "b", "common", "total"])

    joined = pairs.select("a", "b").join(own, "a").join(other, "b").select("a", "b", "x", "y")
    return joined.mapInArrow(run, "a long, b long, common long, total long")


_LIST_DDL = "block long, token long, low long, high long, room long, few long, most long, entries binary"


def list_blocks(lists: DataFrame) -> DataFrame:
    """Blocks of at most ``_BLOCK`` entries of one list each, by component and falling room (tokens from the position on).

    ``lists``: (token, rep, n, pos, part, pivot, share). ``entries``: rep, n, room, part, pivot as rows of longs, and share as
    the bits of doubles. Range partitions cut a long list, so no task holds all of it.
    """
    order = ["token", "part", "back", "rep"]
    rows = lists.select("token", "part", F.expr("pos - n").alias("back"), "rep", "n", "pivot", "share")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # rows of (token, rep, n, room, part, pivot, share)

        def blocks(entries: np.ndarray, last: bool) -> tuple[list, np.ndarray]:
            """Rows of whole blocks, and the entries after them, as more of their list may come."""
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(entries[0])) + 1, [entries.shape[1]]]) if entries.shape[1] else [0]
            out, a = [], 0
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                for a in range(x, y, _BLOCK):
                    if not last and y == entries.shape[1] and y - a < _BLOCK:
                        return out, entries[:, a:]
                    e = entries[:, a:min(a + _BLOCK, y)]
                    out.append((uuid.uuid4().int >> 65, e[0, 0], e[4].min(), e[4].max(), e[3].max(), e[2].min(), e[2].max(), e[1:].tobytes()))
            return out, entries[:, :0]

        for b in batches:
            c = {n: b.column(n).to_numpy() for n in b.schema.names}
            held.append(np.stack([c["token"], c["rep"], c["n"], -c["back"], c["part"], c["pivot"], c["share"].view(np.int64)]))
            out, rest = blocks(np.concatenate(held, axis=1), False)
            held = [rest]
            if out:
                yield _columns(out, _LIST_DDL)
        if held and held[0].shape[1]:
            yield _columns(blocks(np.concatenate(held, axis=1), True)[0], _LIST_DDL)

    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, _LIST_DDL)


def _columns(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    """Rows as a batch with the columns of ``ddl``, whose types are long and binary."""
    fields = [f.strip().split(" ") for f in ddl.split(",")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.binary() if t == "binary" else pa.int64())
                                       for k, (_, t) in enumerate(fields)], names=[n for n, _ in fields])


def _block_pairs(x: np.ndarray, y: np.ndarray, same: bool, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (a < b) of entries of two blocks (or inside one) that the components, bounds and pivots leave open."""
    share_x, share_y = x[5].view(np.float64), y[5].view(np.float64)
    for i in range(x.shape[1]):
        j = slice(i + 1, None) if same else slice(None)
        rep, n, room, part, pivot = y[:5, j]
        least = -(-percent * (x[1, i] + n) // (100 + percent))
        ok = (part != x[3, i]) & (np.minimum(x[2, i], room) >= least)
        ok &= 100 * np.minimum(x[1, i], n) >= percent * np.maximum(x[1, i], n)
        ok &= ~((pivot == x[4, i]) & (np.abs(share_y[j] - share_x[i]) > 1 - percent / 100 + 1e-9))
        hit = rep[ok]
        if len(hit):
            yield np.minimum(x[0, i], hit), np.maximum(x[0, i], hit)


def candidates(blocks: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) from the stored blocks of index lists: inside each block, and between blocks of a list."""
    several = blocks.groupBy("token").count().where("count > 1").select("token")
    head = blocks.join(several, "token", "left_semi")
    x, y = (head.select("token", *(F.col(c).alias(f"{c}_{k}") for c in ("block", "low", "high", "room", "few", "most"))) for k in "xy")
    near = x.join(y, "token").where(
        f"block_x < block_y and (low_x < high_x or low_y < high_y or low_x <> low_y) "
        f"and {100 + percent} * least(room_x, room_y) >= {percent} * (few_x + few_y) "
        f"and 100 * most_x >= {percent} * few_y and 100 * most_y >= {percent} * few_x").select("block_x", "block_y")
    one, two = (blocks.select(F.col("block").alias(f"block_{k}"), F.col("entries").alias(k)) for k in "xy")
    pairs = near.join(one, "block_x").join(two, "block_y").select("x", "y")
    inside = blocks.where("low < high").select(F.col("entries").alias("x"), F.lit(None).cast("binary").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x, y in zip(b.column("x"), b.column("y"), strict=True):
                x, y = (None if v.as_buffer() is None else np.frombuffer(v.as_buffer(), dtype=np.int64).reshape(6, -1) for v in (x, y))
                for a, z in _block_pairs(x, x if y is None else y, y is None, percent):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(z)], names=["a", "b"])

    return pairs.unionByName(inside).mapInArrow(run, "a long, b long").distinct()


@dataclass
class Found:
    """Stored tables of a join: rows of documents, classes of equal sets, their index, pivots and components."""

    rows: DataFrame   # (doc_id, n, d1, d2, alone, tokens)
    sets: DataFrame   # (n, d1, d2, rep, alone, tokens)
    index: DataFrame  # (token, rep, n, pos)
    met: DataFrame    # (a, b, common, total): a set and its pivot
    parts: DataFrame  # (node, component) of every rep that has a link
    files: int        # of a table, at most


def _placed(index: DataFrame, parts: DataFrame, met: DataFrame, turn: int, files: int) -> tuple[DataFrame, DataFrame]:
    """Stored index entries with component, pivot and share of it; and of each list with several components two entries of
    different ones (by a hash of ``turn``, so that others come up the next time)."""
    known = (index.select("rep").distinct().join(parts, F.col("rep") == F.col("node"), "left")
             .join(met, F.col("rep") == F.col("a"), "left")
             .select("rep", F.coalesce("component", "rep").alias("part"), F.coalesce("b", "rep").alias("pivot"),
                     F.when(F.col("b").isNull(), 1.0).otherwise(F.col("common") / F.col("total")).alias("share")))
    placed = written(index.join(known, "rep"), "placed", files=files)
    entry = F.struct("part", F.xxhash64("rep", F.lit(turn)).alias("h"), "rep", "n", F.expr("n - pos").alias("room"))
    mixed = placed.groupBy("token").agg(F.min(entry).alias("low"), F.max(entry).alias("high")).where("low.part < high.part")
    return placed, written(mixed, "mixed", files=files)


def _one_each(placed: DataFrame, mixed: DataFrame, percent: int) -> DataFrame:
    """(a, b): each set of a mixed list with one of another component that the sizes and positions allow."""
    other = F.when(F.col("part") == F.col("low.part"), F.col("high")).otherwise(F.col("low"))
    return (placed.join(mixed, "token").withColumn("o", other)
            .where(f"100 * least(n, o.n) >= {percent} * greatest(n, o.n) "
                   f"and {100 + percent} * least(n - pos, o.room) >= {percent} * (n + o.n)")
            .groupBy("rep").agg(F.min(F.struct("o.h", "o.rep")).alias("o"))
            .select(F.least("rep", "o.rep").alias("a"), F.greatest("rep", "o.rep").alias("b")).distinct())


def find_components(docs: DataFrame, size: int, percent: int) -> Found:
    chunks = pack(docs)
    buckets = buckets_for(chunks)
    files = max(8, buckets // 4)  # tables after the chunks are smaller than the texts
    replies = exchange(chunks, buckets, lambda c, _: ask_frequency(c, buckets, size), answer_frequency)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in rows_of(b):
                yield ordered_sets(unpack(r), r["replies"], buckets, size, percent)

    rows = written(with_replies(chunks, replies).mapInArrow(run, _SETS_DDL), "sets", files=files)
    sets = written(rows.where("tokens is not null").groupBy(*_SAME).agg(
        F.min("doc_id").alias("rep"), F.first("alone").alias("alone"), F.first("tokens").alias("tokens")), "classes", files=files)
    index = written(postings(sets, percent), "postings", files=files)

    # each set meets its pivot
    lists = index.groupBy("token").agg(F.min(F.struct("rep", "n")).alias("first"), F.count("*").alias("size"))
    lists = lists.where("size > 1").select("token", F.col("first.rep").alias("b"), F.col("first.n").alias("m"))
    pivots = (index.join(lists, "token").where("rep > b")
              .where(f"100 * least(n, m) >= {percent} * greatest(n, m)")
              .groupBy(F.col("rep").alias("a")).agg(F.min("b").alias("b")))
    met = written(compare(written(pivots, "pivots", files=files), sets), "met", files=files)
    linked = f"100 * common >= {percent} * total"
    links = met.where(linked).select("a", "b")
    parts = components(links, files)

    # a set that its pivot did not link meets, turn by turn, one of another component; most find theirs soon
    turn, lists = 0, index
    while True:
        placed, mixed = _placed(lists, parts, met, turn, files)
        lists = placed.join(mixed.select("token"), "token", "left_semi")  # only lists that are mixed may stay so
        if turn == _TURNS or mixed.isEmpty():
            break
        pairs = written(_one_each(placed, mixed, percent), "turn", files=files)
        more = written(compare(pairs, sets).where(linked).select("a", "b"), "turn-links", files=files)
        found = more.count()
        if not found:
            break
        links = written(links.union(more), "links", files=files)
        parts = components(links, files)
        turn = turn + 1 if 4 * found >= pairs.count() else _TURNS  # few links: the lists settle the rest
        lists = lists.select(*index.columns)
    # pairs of different components that the answers so far leave open
    blocks = written(list_blocks(lists), "list-blocks", files=files)
    more = compare(written(candidates(blocks, percent), "candidates", files=files), sets).where(linked).select("a", "b")
    return Found(rows, sets, index, met, components(written(links.union(more), "links", files=files), files), files)


def jaccard_components(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id): documents link when 100 * intersection >= percent * union."""
    found = find_components(docs, size, percent)
    # back to documents: class, component of the class, smallest id
    return (found.rows.join(found.sets.select(*_SAME, "rep"), _SAME, "left")
            .join(found.parts, F.col("rep") == F.col("node"), "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.coalesce("component", "rep", "doc_id").alias("component_id")))


_BLOCKS_DDL = "block long, component long, classes binary, tokens binary"


def set_blocks(found: Found, weights: DataFrame, group: int) -> DataFrame:
    """Stored blocks of at most ``group`` sets of one component, neighbours by pivot and by distance from it.

    ``classes``: rep, n, d1, d2 and weight of each set, as five rows of longs. Range partitions cut a large
    component, so no task holds all of it.
    """
    near = found.met.groupBy(F.col("a").alias("rep")).agg(F.min("b").alias("pivot"), F.max(F.col("common") / F.col("total")).alias("share"))
    place = (found.parts.withColumnRenamed("node", "rep").join(near, "rep", "left")
             .select("rep", "component", F.coalesce("pivot", "rep").alias("pivot"), F.coalesce("share", F.lit(1.0)).alias("share")))
    order = ["component", "pivot", "share", "rep", *_SAME]
    rows = found.sets.join(place, "rep").join(weights, _SAME).select(*order, "weight", "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tokens = [], 0

        def block() -> pa.RecordBatch:
            classes = np.array([[r[c] for r in held] for c in ("rep", *_SAME, "weight")], dtype=np.int64)
            return pa.RecordBatch.from_arrays([
                pa.array([uuid.uuid4().int >> 65]), pa.array([held[0]["component"]]), pa.array([classes.tobytes()]),
                pa.array([b"".join(r["tokens"] for r in held)])], names=["block", "component", "classes", "tokens"])

        for b in batches:
            for r in rows_of(b):
                if held and (r["component"] != held[0]["component"] or len(held) == group or tokens + r["n"] > _GROUP_TOKENS):
                    yield block()
                    held, tokens = [], 0
                held.append(r)
                tokens += r["n"]
        if held:
            yield block()

    return written(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, _BLOCKS_DDL), "blocks", files=found.files)


def near_blocks(found: Found, blocks: DataFrame, percent: int) -> DataFrame:
    """(x, y): pairs of blocks of one component that an index list joins, with room for the overlap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in rows_of(b):
                rep = np.unique(np.frombuffer(r["classes"], dtype=np.int64).reshape(5, -1)[0])
                yield pa.RecordBatch.from_arrays([pa.array(rep), *(pa.array(np.full(len(rep), r[c])) for c in ("component", "block"))],
                                                 names=["rep", "component", "block"])

    several = blocks.groupBy("component").count().where("count > 1").select("component")
    place = blocks.join(several, "component", "left_semi").select("component", "block", "classes").mapInArrow(
        run, "rep long, component long, block long")
    spots = written(found.index.join(place, "rep").groupBy("component", "token", "block").agg(
        F.max(F.expr("n - pos")).alias("room"), F.min("n").alias("few"), F.max("n").alias("most")), "spots", files=found.files)
    x, y = (spots.select("component", "token", *(F.col(c).alias(f"{c}_{k}") for c in ("block", "room", "few", "most"))) for k in "xy")
    return written(x.join(y, ["component", "token"]).where(
        f"block_x < block_y and {100 + percent} * least(room_x, room_y) >= {percent} * (few_x + few_y) "
        f"and 100 * most_x >= {percent} * few_y and 100 * most_y >= {percent} * few_x"
    ).select(F.col("block_x").alias("x"), F.col("block_y").alias("y")).distinct(), "near-blocks", files=found.files)


def overlaps(x: np.ndarray, x_n: np.ndarray, y: np.ndarray, y_n: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of each set of ``x`` with each of ``y``: tokens set after set, ``_n`` their numbers.

    The first set of ``x`` is the pivot: its overlaps are counted, and those of the others derived from them by
    the tokens in which they differ from it. Tokens that all sets of ``x`` share take no further work.
    """
    known = np.intersect1d(x, y)
    out = np.zeros((len(x_n), len(y_n)), dtype=np.int64)
    if not len(known):
        return out
    sides = []
    for tokens, n in ((x, x_n), (y, y_n)):
        col = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
        own = known[col] == tokens
        col, row = col[own], np.repeat(np.arange(len(n)), n)[own]
        order = np.argsort(col, kind="stable")
        sides.append((len(n), col[order], row[order]))
    width = max(1, _CELLS // max(len(x_n), len(y_n)))
    for k in range(0, len(known), width):
        w = min(width, len(known) - k)
        one, two = (np.zeros((rows, w), dtype=np.float32) for rows, _, _ in sides)
        for m, (_, col, row) in zip((one, two), sides, strict=True):
            i, j = np.searchsorted(col, [k, k + w])
            m[row[i:j], col[i:j] - k] = 1
        pivot, differ = one[0], one - one[0]  # 1: a token more than the pivot, -1: one it lacks
        live = differ.any(axis=0)
        out += np.rint(two @ pivot + differ[:, live] @ two[:, live].T).astype(np.int64)
    return out


def block_links(found: Found, blocks: DataFrame, percent: int, give, ddl: str) -> DataFrame:
    """What ``give(x, y, i, j, common, total)`` makes of the links of each block and of each pair of near blocks:
    set i of ``x`` with set j of ``y``, where x and y are the ``classes`` of the blocks."""
    own = blocks.select(F.col("block").alias("x"), F.col("classes").alias("x_classes"), F.col("tokens").alias("x_tokens"))
    other = blocks.select(F.col("block").alias("y"), F.col("classes").alias("y_classes"), F.col("tokens").alias("y_tokens"))
    cols = ["x_classes", "x_tokens", "y_classes", "y_tokens"]
    pairs = near_blocks(found, blocks, percent).join(own, "x").join(other, "y").select(*cols)
    inside = own.select("x_classes", "x_tokens", F.lit(None).cast("binary").alias("y_classes"), F.lit(None).cast("binary").alias("y_tokens"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in rows_of(b):
                raw = {c: np.frombuffer(v, dtype=np.int64) for c, v in r.items() if v is not None}
                x = raw["x_classes"].reshape(5, -1)
                y = raw.get("y_classes", raw["x_classes"]).reshape(5, -1)
                common = overlaps(raw["x_tokens"], x[1], raw.get("y_tokens", raw["x_tokens"]), y[1])
                total = x[1][:, None] + y[1][None, :] - common
                hit = 100 * common >= percent * total
                i, j = np.nonzero(hit if r["y_classes"] is not None else np.triu(hit, 1))
                if len(i):
                    yield give(x, y, i, j, common[i, j], total[i, j])

    return pairs.union(inside).mapInArrow(run, ddl)


def class_weights(found: Found) -> DataFrame:
    """(n, d1, d2, weight): how many documents hold each set."""
    return written(found.rows.where("tokens is not null").select("doc_id", *_SAME).distinct()
                   .groupBy(*_SAME).agg(F.count("*").alias("weight")), "weights", files=found.files)


def jaccard_links(docs: DataFrame, size: int = 4, percent: int = 85, group: int = _GROUP) -> DataFrame:
    """(a, b, common, total) of every link between different sets, each by the smallest id that holds it; a <= b.

    Documents with equal sets link as well; they share the representative. Sizes are of intersection and union.
    """
    def give(x, y, i, j, common, total) -> pa.RecordBatch:
        a, b = x[0][i], y[0][j]
        return pa.RecordBatch.from_arrays([pa.array(v) for v in (np.minimum(a, b), np.maximum(a, b), common, total)],
                                          names=["a", "b", "common", "total"])

    found = find_components(docs, size, percent)
    return block_links(found, set_blocks(found, class_weights(found), group), percent, give,
                       "a long, b long, common long, total long")


def jaccard_join(docs: DataFrame, size: int = 4, percent: int = 85, group: int = _GROUP) -> DataFrame:
    """(doc_id, n_shingles, n_links, component_id): documents link when 100 * intersection >= percent * union.

    The links of a class are added up block by block with the weights of the other classes, so a group of m
    sets gives m rows a block it meets, not m * m.
    """
    def give(x, y, i, j, common, total) -> pa.RecordBatch:
        one = np.bincount(i, y[4][j], x.shape[1]).astype(np.int64)
        two = np.bincount(j, x[4][i], y.shape[1]).astype(np.int64)
        got = np.concatenate([np.vstack([x[1:4], one])[:, one > 0], np.vstack([y[1:4], two])[:, two > 0]], axis=1)
        return pa.RecordBatch.from_arrays([pa.array(v) for v in got], names=[*_SAME, "links"])

    found = find_components(docs, size, percent)
    weights = class_weights(found)
    counts = block_links(found, set_blocks(found, weights, group), percent, give, "n long, d1 long, d2 long, links long")
    counts = counts.groupBy(*_SAME).agg(F.sum("links").alias("links"))
    classes = written(weights.join(counts, _SAME, "left").join(found.sets.select(*_SAME, "rep"), _SAME)
                      .join(found.parts, F.col("rep") == F.col("node"), "left")
                      .select(*_SAME, F.coalesce("component", "rep").alias("component"),
                              (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "class-links", files=found.files)
    return found.rows.join(classes, _SAME, "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component", "doc_id").alias("component_id"))


def drop_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of near duplicates the document with the smallest id stays.

    As a stage it takes shingles of five words and a similarity of 0.8 or more.

    Rows that repeat one id are one document, and stay or go together; a null id always stays.
    """
    found = jaccard_components(docs, size=5, percent=80).where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*columns(docs))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 3], ' ')) AS h FROM (
        SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 3) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS MATERIALIZED (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (h) GROUP BY ALL)
      JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(k.n, 0) AS n_links, coalesce((SELECT min(b) FROM r WHERE r.a = d.doc_id), d.doc_id) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN (SELECT a, count(*) AS n FROM l WHERE a <> b GROUP BY a) k ON k.a = d.doc_id
"""
