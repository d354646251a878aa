"""Conversation structure repair with Four-Russians block tables.

A conversation should read ``(s?(ua)+)?`` in its role initials. Its rows are
symbols (role, whether the text is cut off, whether the row has to go), and the
cheapest edits are a shortest path through four states. Costs to the end of the
conversation, one a state, form a vector; less its minimum it is one of a few
dozen *normalised* vectors, so a table holds, for each of them and each block
of ``BLOCK`` symbols, the vector before the block and the cost added. Blocks
are taken from the end by lookup. Then each block is expanded backward, symbol
by symbol from the vector at its right edge, and its edits are read from left
to right, the least letter first among the cheapest. As costs reach to the
end of the conversation, that choice is safe: ties end in the least string.

Conversations need not fit a task. Rows are sorted by (conversation, turn, role,
text) over range partitions and cut into pieces of at most ``PIECE_ROWS`` rows
or ``PIECE_BYTES``. A conversation that lies inside a partition as one piece is
done there. For the others (at most two a partition, and those above a piece)
a piece is summed up as a function of the vector at its right edge (vector and
cost at its left edge, state it leaves in); these few numbers meet per
conversation, and each piece is traced on its own after that. Rows that are equal are
one row with a count, since all but the first go. Only ``repair_report``'s hash of
the whole repaired text must see a conversation in sequence: a stream of its
pieces, of which one is in memory at a time.

Edge cases: a null role or text is one space, as are a null conv_id or turn in
the damage key. A null ``conv_id`` is a conversation. Null turns come first;
rows of one turn are ordered by role, then text. A role of any other initial (or
none) is never kept. Repeated rows are duplicates. A conversation without rows
after the damage, or without any edit but deletions, has an empty repaired
text. Very long texts are handled whole. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .frames import table, written
from .op11_shard import crc32_sql

#: symbols of a table block; rows and bytes of text of a piece
BLOCK, PIECE_ROWS, PIECE_BYTES = 4, 1 << 16, 8 << 20
BLANKS = " \t\n\x0b\x0c\r"

#: states: nothing so far, after s, after u, after a. Kinds of role: s, u, a, other
_START, _S, _U, _A = range(4)
_KEEP = {(_START, 0): _S, (_START, 1): _U, (_S, 1): _U, (_U, 2): _A, (_A, 1): _U}
_NEXT = (_U, _U, _A, _U)   # where an inserted row, or one with a new role, leads
_ROLE = ("user", "user", "assistant", "user")
_LEGAL = {(0, 1), (1, 2), (2, 1)}
#: symbol: 2 * kind + truncated; GONE must be deleted
GONE, SYMBOLS = 8, 9
_DELETE, _NEW_ROLE, _INSERT, _CUT_OFF = 4, 3, 3, 3
#: cost to go, and letters, when no row is left
_END, _END_LETTERS = (0, 6, 3, 0), ("", "II", "I", "")


def _row_costs(symbol: int, after: tuple, state: int) -> dict[str, tuple[int, int]]:
    """Letter -> (cost to go, next state) of what can be done with a row in ``state``."""
    out = {"D": (_DELETE + after[state], state)}
    if symbol != GONE:
        more = _CUT_OFF * (symbol % 2)
        if (kept := _KEEP.get((state, symbol // 2))) is not None:
            out["K"] = (more + after[kept], kept)
        out["R"] = (_NEW_ROLE + more + after[_NEXT[state]], _NEXT[state])
    return out


class Tables:
    """Normalised vectors, what a symbol and a block of symbols make of each, and the edits of a symbol."""

    def __init__(self, block: int = BLOCK):
        self.block, self.vectors, known = block, [_END], {_END: 0}
        step, cost, self.moves = [], [], []
        for after in self.vectors:  # grows until no new vector turns up
            step.append([])
            cost.append([])
            self.moves.append([])
            for symbol in range(SYMBOLS):
                rows = [_row_costs(symbol, after, p) for p in range(4)]
                least = [min(c for c, _ in r.values()) for r in rows]
                before = [min(least[p], _INSERT + least[_NEXT[p]], 2 * _INSERT + least[_NEXT[_NEXT[p]]]) for p in range(4)]
                vector = tuple(c - min(before) for c in before)
                if vector not in known:
                    known[vector] = len(self.vectors)
                    self.vectors.append(vector)
                step[-1].append(known[vector])
                cost[-1].append(min(before))
                self.moves[-1].append([self._move(rows, before, p) for p in range(4)])
        self.step, self.cost = np.array(step), np.array(cost)
        self.leave = np.array([[[m[1] for m in by_state] for by_state in by_symbol] for by_symbol in self.moves])
        n = len(self.vectors)
        self.block_step, self.block_cost = np.arange(n)[:, None], np.zeros((n, 1), dtype=np.int64)
        self.block_leave = np.tile(np.arange(4), (n, 1, 1))
        for _ in range(block):  # one symbol more on the left
            v, codes = self.block_step, self.block_step.shape[1]
            pick = np.arange(SYMBOLS)[None, :, None]
            self.block_cost = (self.block_cost[:, None, :] + self.cost[v[:, None, :], pick]).reshape(n, -1)
            first = self.leave[v[:, None, :], pick]  # (vector, symbol, code, state): state after the new symbol
            self.block_leave = np.take_along_axis(np.broadcast_to(self.block_leave[:, None], (n, SYMBOLS, codes, 4)),
                                                  first, axis=3).reshape(n, -1, 4)
            self.block_step = self.step[v[:, None, :], pick].reshape(n, -1)

    @staticmethod
    def _move(rows: list[dict], before: list[int], state: int) -> tuple[str, int]:
        """The least letters that are cheapest up to and with the row, and the state after it."""
        letters = ""
        while True:
            for letter in "DIKR":
                if letter == "I":
                    if before[state] == _INSERT + before[_NEXT[state]]:
                        letters, state = letters + "I", _NEXT[state]
                        break
                elif letter in rows[state] and rows[state][letter][0] == before[state]:
                    return letters + letter, rows[state][letter][1]

    def codes(self, symbols: bytes) -> tuple[bytes, list[int]]:
        """Symbols before the first whole block, and the numbers of the blocks."""
        rest = len(symbols) % self.block
        own = np.frombuffer(symbols, dtype=np.uint8)[rest:].reshape(-1, self.block).astype(np.int64)
        return symbols[:rest], (own @ (SYMBOLS ** np.arange(self.block)[::-1])).tolist()

    def edges(self, symbols: bytes, right: int) -> tuple[list[int], int]:
        """Vectors at the block edges from left to right (the first one lies before all symbols), and the cost added."""
        rest, blocks = self.codes(symbols)
        out, cost, v = [right], 0, right
        for code in reversed(blocks):
            cost += int(self.block_cost[v, code])
            v = int(self.block_step[v, code])
            out.append(v)
        for s in reversed(rest):
            cost += int(self.cost[v, s])
            v = int(self.step[v, s])
        if rest:
            out.append(v)
        return out[::-1], cost

    def trace(self, symbols: bytes, edges: list[int], state: int) -> tuple[list[str], list[int], int]:
        """Letters of each row, the state before each row, and the state after the last."""
        letters, states = [], []
        rest = len(symbols) % self.block
        cuts = ([0] if rest else []) + list(range(rest, len(symbols), self.block)) + [len(symbols)]
        for k in range(len(cuts) - 1):
            own = symbols[cuts[k]:cuts[k + 1]]
            v, after = edges[k + 1], []
            for s in reversed(own):  # the block is expanded from its right edge
                after.append(v)
                v = int(self.step[v, s])
            for s, v in zip(own, reversed(after), strict=True):
                states.append(state)
                more, state = self.moves[v][s][state]
                letters.append(more)
        return letters, states, state

    def function(self, symbols: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every vector at the right edge: the vector at the left, the cost added, and where each state leads."""
        rest, blocks = self.codes(symbols)
        v = np.arange(len(self.vectors))
        cost, seen = np.zeros(len(v), dtype=np.int64), []
        for code in reversed(blocks):
            seen.append((self.block_leave, v, code))
            cost, v = cost + self.block_cost[v, code], self.block_step[v, code]
        for s in reversed(rest):
            seen.append((self.leave, v, s))
            cost, v = cost + self.cost[v, s], self.step[v, s]
        leave = np.tile(np.arange(4), (len(v), 1))
        for lead, at, code in reversed(seen):
            leave = np.take_along_axis(lead[at, code], leave, axis=1)
        return v, cost, leave


def undamaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) of conversation rows; a null role or text becomes a space."""
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"),
                       *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")), F.lit(1).cast("long").alias("copies"))


def damaged(rows: DataFrame) -> DataFrame:
    """``undamaged`` rows after a damage that crc32 of ``conv_id:turn`` decides.

    A conversation's dropped rows are still there, with 0 copies: they only name it.
    """
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    out = undamaged(rows).withColumn("fate", F.crc32(key.cast("binary")) % 20)
    gone = F.col("fate") == 0
    text = (F.when(gone | (F.col("fate") == 1), "").when(F.col("fate") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text")))
    return out.select("conv_id", F.when(~gone, F.col("turn")).alias("turn"),
                      F.when(gone, "").when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                      F.when(gone, 0).when(F.col("fate") == 3, 2).otherwise(1).cast("long").alias("copies"))


def symbols(rows: DataFrame) -> DataFrame:
    """Equal rows once, with kind (of the role), blank, again (a duplicate of an earlier turn's row) and symbol."""
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    kind = F.expr("instr('sua', substring(role, 1, 1)) - 1")
    rows = rows.select("*", F.when((kind < 0) | (F.col("role") == ""), 3).otherwise(kind).alias("kind"), (bare == "").alias("blank"),
                       (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"), F.sha2("text", 256).alias("hash"))
    first = (rows.where("not blank and copies > 0").groupBy("conv_id", "role", "hash")
             .agg(F.min(F.struct(F.col("turn").isNotNull().alias("has"), "turn")).alias("first"), F.count("*").alias("n"))
             .where("n > 1").select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("hash").alias("h"), "first"))
    rows = rows.join(first, rows["conv_id"].eqNullSafe(first["c"]) & (rows["role"] == first["r"]) & (rows["hash"] == first["h"]), "left")
    again = F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    return rows.select("conv_id", "turn", "role", "text", "copies", "kind", "blank", again.alias("again"),
                       F.when(F.col("blank") | again, GONE).otherwise(2 * F.col("kind") + F.col("cut").cast("int")).alias("symbol"))


_COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")
#: a row (pos >= 0) or the head of a piece (pos -1): its symbols and sums; ``whole``: the piece is a conversation and is done
_PIECES = ("piece long, pos long, turn long, role string, text string, copies long, symbols binary, whole boolean, blank long, "
           "duplicate long, truncated long, illegal long, cost long, first_kind int, last_kind int, first_turn long, "
           "last_turn long, n_turns long, gaps long, audit string, repaired_sha256 string")


class _Piece:
    def __init__(self):
        self.rows, self.bytes, self.symbols = [], 0, bytearray()
        self.sum = dict.fromkeys(_COUNTS, 0) | dict.fromkeys(("first_kind", "last_kind", "first_turn", "last_turn")) | {"n_turns": 0}

    def add(self, turn, role: str, text: str, copies: int, kind: int, blank: bool, again: bool, symbol: int) -> None:
        if not copies:
            return
        s = self.sum
        if s["last_kind"] is None:
            s["first_kind"] = kind
        else:
            s["illegal"] += (s["last_kind"], kind) not in _LEGAL
        s["last_kind"] = kind
        s["illegal"] += copies - 1
        if blank:
            s["blank"] += copies
        else:
            s["duplicate"] += copies - (not again)
            s["truncated"] += symbol != GONE and symbol % 2
        s["cost"] += _DELETE * (copies - 1)
        if turn is not None and turn != s["last_turn"]:
            s["n_turns"] += 1
            s["first_turn"] = turn if s["first_turn"] is None else s["first_turn"]
            s["last_turn"] = turn
        self.symbols.append(symbol)
        self.rows.append((turn, role, text, copies))
        self.bytes += len(text)


def repaired_lines(rows: list[tuple], letters: list[str], states: list[int]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of every row that stays, is changed or is put in; ``rows``: (turn, role, text, copies)."""
    for (_, role, text, _), own, state in zip(rows, letters, states, strict=True):
        for _ in own[:-1]:
            yield "I", _ROLE[state], ""
            state = _NEXT[state]
        if own[-1] == "K":
            yield "K", role, text
        elif own[-1] == "R":
            yield "R", _ROLE[state], text


def last_lines(state: int) -> Iterator[tuple[str, str, str]]:
    """What is put in after the last row."""
    for _ in _END_LETTERS[state]:
        yield "I", _ROLE[state], ""
        state = _NEXT[state]


def audit_of(rows: list[tuple], letters: list[str]) -> str:
    return "".join(own + "D" * (copies - 1) for own, (_, _, _, copies) in zip(letters, rows, strict=True))


class TextHash:
    """SHA-256 of newline-joined lines, line by line."""

    def __init__(self):
        self.sha, self.empty = hashlib.sha256(), True

    def add(self, lines: Iterator[tuple[str, str, str]]) -> None:
        for _, role, text in lines:
            self.sha.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
            self.empty = False


def pieces(rows: DataFrame, keep_rows: bool, piece_rows: int, piece_bytes: int) -> DataFrame:
    """Stored pieces in order, whole ones repaired; rows of the others, and of all with ``keep_rows``.

    With ``keep_rows`` the rows of whole pieces are repaired ones: ``symbols`` is the edit.
    """
    schema = StructType([rows.schema["conv_id"], *StructType.fromDDL(_PIECES).fields])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, number, base = Tables(), 0, TaskContext.get().partitionId() << 33
        piece, conv, first_conv, cut = None, None, True, False

        def flush(whole: bool) -> Iterator[pa.RecordBatch]:
            nonlocal number
            head = piece.sum | {"pos": -1, "symbols": bytes(piece.symbols), "whole": whole}
            out = [{"pos": k, "turn": t, "role": r, "text": x, "copies": n} for k, (t, r, x, n) in enumerate(piece.rows)]
            if whole:
                edges, cost = tables.edges(head["symbols"], 0)
                letters, states, state = tables.trace(head["symbols"], edges, _START)
                head["cost"] += cost + tables.vectors[edges[0]][_START]
                head["audit"] = audit_of(piece.rows, letters) + _END_LETTERS[state]
                lines = [*repaired_lines(piece.rows, letters, states), *last_lines(state)]
                sha = TextHash()
                sha.add(lines)
                head["repaired_sha256"] = sha.sha.hexdigest()
                head["gaps"] = gaps_of(head["first_turn"], head["last_turn"], head["n_turns"])
                out = [{"pos": k, "role": r, "text": x, "symbols": e.encode(), "whole": True} for k, (e, r, x) in enumerate(lines)] if keep_rows else []
            made = [head, *out]
            yield pa.RecordBatch.from_pylist([{n: r.get(n) for n in names} | {"conv_id": conv, "piece": base + number} for r in made],
                                             schema=arrow)
            number += 1

        def gathered(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size = [], 0  # a batch for some thousand rows, not for each conversation
            for p in parts:
                held.append(p)
                size += p.num_rows + p.nbytes // 1024
                if size > 4096:
                    yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    held, size = [], 0
            if held:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

        def all_pieces() -> Iterator[pa.RecordBatch]:
            nonlocal piece, conv, first_conv, cut
            for b in batches:
                for c, *row in zip(*(b.column(k).to_pylist() for k in range(b.num_columns)), strict=True):
                    if piece is None or c != conv:
                        if piece is not None:
                            yield from flush(not first_conv and not cut)
                            first_conv = cut = False
                        piece, conv = _Piece(), c
                    elif len(piece.rows) >= piece_rows or piece.bytes >= piece_bytes:
                        yield from flush(False)
                        piece, cut = _Piece(), True
                    piece.add(*row)
            if piece is not None:
                yield from flush(False)

        yield from gathered(all_pieces())

    arrow = _arrow(schema)
    # the range key takes the text's beginning only, as range bounds are sampled to the driver; the order takes all of it
    order = ["conv_id", "turn", "role"]
    placed = (rows.repartitionByRange(*order, F.substring("text", 1, 64)).sortWithinPartitions(*order, "text")
              .select("conv_id", "turn", "role", "text", "copies", "kind", "blank", "again", "symbol"))
    return written(placed.mapInArrow(run, schema), "pieces")


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


_SOLVED = "right int, entry int, last boolean"


def solve_open(heads: DataFrame) -> DataFrame:
    """Heads of open pieces with the vector at their right edge, the state they begin in, and whether they are the last.

    ``gaps`` and what the edges of pieces add to the sums of the conversation go to its first piece.
    """
    conv = heads.schema["conv_id"]
    narrow = StructType([conv, *StructType.fromDDL("piece long, first_kind int, last_kind int, first_turn long, last_turn long, "
                                                   "n_turns long, left_edge binary, costs binary, leave binary").fields])
    out = StructType([conv, *StructType.fromDDL(f"piece long, illegal long, cost long, gaps long, {_SOLVED}").fields])
    out_arrow = _arrow(out)

    def functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables()
        for b in batches:
            made = [tables.function(s.as_py()) for s in b.column("symbols")]
            yield pa.RecordBatch.from_arrays([
                *(b.column(n) for n in narrow.names[:-3]),
                *(pa.array([m[k].astype(np.int64).tobytes() for m in made], pa.binary()) for k in range(3))], names=narrow.names)

    def combine(t: pa.Table) -> pa.Table:
        rows = t.sort_by("piece").to_pylist()
        vectors, v, cost = Tables(1).vectors, 0, 0
        for r in reversed(rows):
            r["right"] = v
            cost += int(np.frombuffer(r["costs"], dtype=np.int64)[v])
            v = int(np.frombuffer(r["left_edge"], dtype=np.int64)[v])
        state, kind, turn, low, distinct, illegal = _START, None, None, None, 0, 0
        for r in rows:
            r |= {"entry": state, "last": False, "cost": 0, "illegal": 0, "gaps": 0}
            state = int(np.frombuffer(r["leave"], dtype=np.int64).reshape(-1, 4)[r["right"], state])
            if r["first_kind"] is not None:
                illegal += kind is not None and (kind, r["first_kind"]) not in _LEGAL
                kind = r["last_kind"]
            if r["first_turn"] is not None:
                distinct += r["n_turns"] - (turn == r["first_turn"])
                low, turn = r["first_turn"] if low is None else low, r["last_turn"]
        rows[-1]["last"] = True
        rows[0] |= {"cost": cost + vectors[v][_START], "illegal": int(illegal), "gaps": gaps_of(low, turn, distinct)}
        return pa.Table.from_pylist([{n: r[n] for n in out.names} for r in rows], schema=out_arrow)

    solved = heads.select(*narrow.names[:-3], "symbols").mapInArrow(functions, narrow).groupBy("conv_id").applyInArrow(combine, out)
    add = ["illegal", "cost", "gaps"]
    solved = written(solved, "solved").select("piece", *(F.col(c).alias(f"add_{c}") for c in add), *StructType.fromDDL(_SOLVED).names)
    more = {c: F.coalesce(F.col(c), F.lit(0)) + F.col(f"add_{c}") for c in add}
    return heads.join(solved, "piece").withColumns(more).select(*heads.columns, *StructType.fromDDL(_SOLVED).names)


def gaps_of(low: int | None, high: int | None, distinct: int) -> int:
    return 0 if low is None else min(high - low + 1 - distinct, 2 ** 63 - 1)


def _open_pieces(placed: DataFrame, by: list[str]) -> DataFrame:
    """Heads and rows of the open pieces, those of equal ``by`` in one partition, in order, each head before its rows."""
    heads = solve_open(placed.where("pos = -1 and not whole"))
    rows = placed.where("pos >= 0 and whole is null").withColumns(
        {n: F.lit(None).cast(heads.schema[n].dataType) for n in StructType.fromDDL(_SOLVED).names})
    return heads.unionByName(rows).repartition(*by).sortWithinPartitions("conv_id", "piece", "pos")


def _pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[tuple]]]:
    """Each piece: head and rows (turn, role, text, copies)."""
    head, rows = None, []
    for b in batches:
        for r in b.to_pylist():
            if r["pos"] < 0:
                if head is not None:
                    yield head, rows
                head, rows = r, []
            else:
                rows.append((r["turn"], r["role"], r["text"], r["copies"]))
    if head is not None:
        yield head, rows


def _open_report(placed: DataFrame) -> DataFrame:
    out = StructType([placed.schema["conv_id"], *StructType.fromDDL(_REPORT).fields])
    arrow = _arrow(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, sums, sha, audit = Tables(), None, None, []
        for head, rows in _pieces_of(batches):
            if sha is None:  # the first piece of a conversation
                sums, sha, audit = dict.fromkeys(_SUMS, 0), TextHash(), []
            letters, states, state = tables.trace(head["symbols"], tables.edges(head["symbols"], head["right"])[0], head["entry"])
            sums = {c: sums[c] + head[c] for c in _SUMS}
            audit.append(audit_of(rows, letters))
            sha.add(repaired_lines(rows, letters, states))
            if head["last"]:
                sha.add(last_lines(state))
                audit.append(_END_LETTERS[state])
                yield pa.RecordBatch.from_pylist([{"conv_id": head["conv_id"]} | sums | {
                    "audit": "".join(audit), "repaired_sha256": sha.sha.hexdigest()}], schema=arrow)
                sha = None

    return _open_pieces(placed, ["conv_id"]).mapInArrow(run, out)


_SUMS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def repair_report(rows: DataFrame, piece_rows: int = PIECE_ROWS, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of each conversation.

    ``rows``: (conv_id, turn, role, text, copies) as from ``undamaged`` or ``damaged``.
    """
    placed = pieces(symbols(rows), False, piece_rows, piece_bytes)
    names = ["conv_id", *StructType.fromDDL(_REPORT).names]
    return placed.where("pos = -1 and whole").select(*names).unionByName(_open_report(placed).select(*names))


def repaired_rows(rows: DataFrame, piece_rows: int = PIECE_ROWS, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """(conv_id, piece, pos, edit, role, text): the rows of the repaired conversations, in order of (piece, pos).

    ``edit`` is K (kept), R (new role) or I (put in).
    """
    placed = pieces(symbols(rows), True, piece_rows, piece_bytes)
    out = StructType([rows.schema["conv_id"], *StructType.fromDDL("piece long, pos long, edit string, role string, text string").fields])
    arrow = _arrow(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables()
        for head, own in _pieces_of(batches):
            letters, states, state = tables.trace(head["symbols"], tables.edges(head["symbols"], head["right"])[0], head["entry"])
            lines = [*repaired_lines(own, letters, states), *(last_lines(state) if head["last"] else ())]
            yield pa.RecordBatch.from_pylist([{"conv_id": head["conv_id"], "piece": head["piece"], "pos": k, "edit": e, "role": r, "text": x}
                                              for k, (e, r, x) in enumerate(lines)], schema=arrow)

    whole = placed.where("pos >= 0 and whole").select("conv_id", "piece", "pos", F.col("symbols").cast("string").alias("edit"), "role", "text")
    return whole.unionByName(_open_pieces(placed, ["conv_id", "piece"]).mapInArrow(run, out))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(damaged(table(spark, sf_dir, "conversations")))


def _oracle() -> str:
    add = "{{'c': {w}.c + {c}, 'a': '{e}' || {w}.a, 't': {t} || {w}.t}}".format
    line = lambda role: f"chr(10) || '{role}:'"
    fine, more = "fault IN ('', 't')", "CASE fault WHEN 't' THEN 3 ELSE 0 END"
    base, closed = [], []
    for p in range(4):
        keep = " ".join(f"WHEN k = '{'sua'[kind]}' THEN {add(w=f'w[{q + 1}]', c=more, e='K', t='r')}"
                        for (state, kind), q in _KEEP.items() if state == p)
        role = add(w=f"w[{_NEXT[p] + 1}]", c=f"3 + {more}", e="R", t=f"{line(_ROLE[p])} || text")
        base.append(f"list_min(list_filter([{add(w=f'w[{p + 1}]', c=4, e='D', t=repr(''))}, CASE WHEN {fine} THEN {role} END, "
                    f"CASE WHEN NOT {fine} THEN NULL {keep} END], lambda x: x IS NOT NULL))")
        one, two = _NEXT[p], _NEXT[_NEXT[p]]
        closed.append(f"list_min([b[{p + 1}], {add(w=f'b[{one + 1}]', c=3, e='I', t=line(_ROLE[p]))}, "
                      f"{add(w=f'b[{two + 1}]', c=6, e='II', t=line(_ROLE[p]) + ' || ' + line(_ROLE[one]))}])")
    end = ", ".join(f"{{'c': {c}::BIGINT, 'a': '{a}', 't': {' || '.join(t) or repr('')}}}" for c, a, t in zip(
        _END, _END_LETTERS, ([], [line("user"), line("assistant")], [line("assistant")], []), strict=True))
    return f"""
WITH RECURSIVE c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS f FROM conversations),
e AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
             CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
             unnest(range(CASE f WHEN 3 THEN 2 ELSE 1 END)) FROM c WHERE f <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
             rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM e),
g AS (SELECT conv_id, turn, role, text, i, left(role, 1) AS k, coalesce(lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1), 'ua') AS two,
             CASE WHEN bare = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                  WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault FROM n),
s AS (SELECT conv_id, coalesce(least(max(turn)::HUGEINT - min(turn) + 1 - count(DISTINCT turn), {2 ** 63 - 1}), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
             count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
             count(*) FILTER (two NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS rows FROM g GROUP BY conv_id),
w AS (SELECT conv_id, rows AS i, [{end}] AS w FROM s
      UNION ALL
      SELECT conv_id, i, [{", ".join(closed)}] FROM (SELECT conv_id, i, [{", ".join(base)}] AS b FROM (
          SELECT w.conv_id, w.i - 1 AS i, w.w, g.k, g.fault, g.text, chr(10) || g.role || ':' || g.text AS r
          FROM w JOIN g ON g.conv_id IS NOT DISTINCT FROM w.conv_id AND g.i = w.i)))
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(w[1].c, 0)::BIGINT AS cost,
       coalesce(w[1].a, '') AS audit, sha256(coalesce(substr(w[1].t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN w ON w.conv_id IS NOT DISTINCT FROM o.conv_id AND w.i = 0
"""


ORACLE = _oracle()
