"""Vectorised word splitting and hashing over UTF-8 bytes.

Text columns arrive as Arrow buffers. A batch is cut into groups of rows of a
few MB; inside a group every byte, word and word window is handled by numpy,
so no Python object is made per word. Hashes are 64-bit polynomial sums over
random byte values, mixed at the end; they do not depend on the process.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
SPACES = bytes([0x20, *range(0x09, 0x0E)])
#: bytes that are not in [0-9A-Za-z] and below 0x80
NOT_ALNUM = bytes(b for b in range(128) if not chr(b).isalnum())
GROUP_BYTES = 1 << 21
#: bytes hashed at a time: the working arrays take about 40 times as much
HASH_BYTES = 1 << 18
_P, _Q = U(0x9E3779B97F4A7C15), U(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: np.uint64):
        self.base, self.inverse = int(base), pow(int(base), -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=U)

    @staticmethod
    def _table(base: int, n: int) -> np.ndarray:
        steps = np.full(n, base, dtype=U)
        steps[0] = 1
        return np.cumprod(steps, dtype=U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = 1 << (n - 1).bit_length()
            self.up, self.down = self._table(self.base, size), self._table(self.inverse, size)
        return self.up[:n], self.down[:n]


_BYTE_POWERS, _WORD_POWERS = _Powers(_P), _Powers(_Q)


@dataclass
class Words:
    """Words of a group of rows, in order: hash, row (0-based in the group), byte start and end."""

    hash: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    n_rows: int

    def per_row(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.n_rows).astype(np.int64)


class Splitter:
    """Splits at any byte of ``separators``; ``lower`` maps A-Z to a-z before hashing."""

    def __init__(self, separators: bytes, lower: bool = False):
        self.is_sep = np.zeros(256, dtype=bool)
        self.is_sep[list(separators)] = True
        code = np.arange(256, dtype=U)
        if lower:
            code[65:91] += U(32)
        self.value = mix((code + U(1)) * _P)

    def _cuts(self, data: np.ndarray, offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
        at, stop = int(offsets[0]), int(offsets[-1])
        while at < stop:
            size = limit
            while True:
                cut = min(at + size, stop)
                if cut == stop:
                    break
                edge = int(offsets[np.searchsorted(offsets, cut, "right") - 1])
                seps = np.flatnonzero(self.is_sep[data[at:cut]])
                best = max(edge, at + int(seps[-1]) + 1 if len(seps) else 0)
                if best > at:
                    cut = best
                    break
                size *= 2
            yield at, cut
            at = cut

    def split(self, data: np.ndarray, offsets: np.ndarray, limit: int = HASH_BYTES) -> Words:
        """``data``: bytes of the rows; ``offsets``: n_rows + 1 positions in it."""
        parts = []
        for a, z in self._cuts(data, offsets, limit):
            b = data[a:z]
            word = ~self.is_sep[b]
            edges = offsets[np.searchsorted(offsets, a):np.searchsorted(offsets, z)] - a
            first = word.copy()
            first[1:] &= ~word[:-1]
            first[edges] = word[edges]
            last = word.copy()
            last[:-1] &= ~word[1:]
            inner = edges[edges > 0] - 1
            last[inner] = word[inner]
            starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
            up, down = _BYTE_POWERS.get(len(b) + 1)
            total = np.zeros(len(b) + 1, dtype=U)
            np.cumsum(self.value[b] * up[:-1], out=total[1:])
            h = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U))
            parts.append((h, starts + a, ends + a))
        if not parts:
            z = np.zeros(0, dtype=np.int64)
            return Words(z.astype(U), z, z, z, len(offsets) - 1)
        h, s, e = (np.concatenate(x) if len(parts) > 1 else x[0] for x in zip(*parts, strict=True))
        row = np.searchsorted(offsets, s, "right") - 1
        return Words(h, row, s, e, len(offsets) - 1)


def windows(words: Words, n: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(position of the first word, hash) of each run of ``n`` words inside one row.

    Hashes with different ``salt`` are independent of each other.
    """
    size = len(words.hash)
    if size < n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=U)
    at = np.flatnonzero(words.row[: size - n + 1] == words.row[n - 1:])
    up, down = _WORD_POWERS.get(size + 1)
    total = np.zeros(size + 1, dtype=U)
    np.cumsum((mix(words.hash ^ U(salt)) if salt else words.hash) * up[:-1], out=total[1:])
    return at, mix((total[at + n] - total[at]) * down[at] + U(n))


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string column; nulls count as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    if len(col) == 0 or off is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(col) + 1, dtype=np.int64)
    offsets = np.frombuffer(off, dtype=np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw, offsets.astype(np.int64)


def row_groups(offsets: np.ndarray, limit: int = GROUP_BYTES, rows: int = 4096) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes and at most ``rows`` rows each (one row at least)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), i + rows, n)
        yield i, j
        i = j


def groups(col: pa.Array, limit: int = GROUP_BYTES, rows: int = 4096) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row exclusive, bytes, offsets into them) for each row group of a text column."""
    data, offsets = text_buffers(col)
    for i, j in row_groups(offsets, limit, rows):
        a, z = int(offsets[i]), int(offsets[j])
        yield i, j, data[a:z], offsets[i:j + 1] - a
