"""Statistics of whole texts, computed for a batch of rows at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .words import SPACES, Splitter, groups, mix, windows

SYMBOLS = b"#*$%&|<>"
_WORDS, _LINES = Splitter(SPACES), Splitter(b"\n")

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("log_words", "chars_per_word", "symbols_per_word", "dup_line_share", "repeat_word_share",
            "distinct_word_share", "upper_share", "digit_share", "stops_per_word", "marks_per_word",
            "words_per_line", "wide_share", "bars_per_word", "longest_word_share", "top_byte_share")


def _byte_class(chars: bytes) -> np.ndarray:
    out = np.zeros(256)
    out[list(chars)] = 1
    return out


_CLASSES = np.stack([
    _byte_class(bytes([*range(0x80), *range(0xC0, 0x100)])),  # code points
    _byte_class(SPACES), _byte_class(SYMBOLS), _byte_class(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    _byte_class(b"abcdefghijklmnopqrstuvwxyz"), _byte_class(b"0123456789"), _byte_class(b".,;:"),
    _byte_class(b"!?"), _byte_class(bytes(range(0xC0, 0x100))), _byte_class(b"|"),
], axis=1)


def _firsts(row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (row, key) as one mixed key, and where a new pair begins in it."""
    k = mix(key ^ mix(row.astype(np.uint64) + np.uint64(7)))
    order = np.argsort(k, kind="stable")
    k = k[order]
    new = np.ones(len(k), dtype=bool)
    new[1:] = k[1:] != k[:-1]
    return order, new


def _group_stats(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    n = len(offsets) - 1
    per = np.zeros((n, 256))
    for i in range(n):
        a, z = offsets[i], offsets[i + 1]
        if z > a:
            per[i] = np.bincount(data[a:z], minlength=256)
    points, spaces, symbols, upper, lower, digits, stops, marks, wide, bars = (per @ _CLASSES).T
    w = _WORDS.split(data, offsets)
    n_words = w.per_row()

    lines = _LINES.split(data, offsets)
    real = np.searchsorted(w.start, lines.end) > np.searchsorted(w.start, lines.start)
    row, key = lines.row[real], lines.hash[real]
    order, new = _firsts(row, key)
    n_lines = np.bincount(row, minlength=n)
    dup_lines = n_lines - np.bincount(row[order][new], minlength=n)

    at, key = windows(w, 3)
    order, new = _firsts(w.row[at], key)
    again = ~new
    again[:-1] |= ~new[1:]  # the first of several
    covered = np.zeros(len(w.hash) + 2, dtype=bool)
    hit = at[order[again]]
    for k in range(3):
        covered[hit + k] = True
    repeated = np.bincount(w.row[covered[:len(w.hash)]], minlength=n)

    order, new = _firsts(w.row, w.hash)
    distinct = np.bincount(w.row[order][new], minlength=n)
    longest = np.zeros(n)
    np.maximum.at(longest, w.row, (w.end - w.start).astype(float))

    words, chars = np.maximum(n_words, 1), np.maximum(points - spaces, 1)
    return {
        "n_words": n_words, "word_chars": (points - spaces).astype(np.int64), "n_symbols": symbols.astype(np.int64),
        "n_dup_lines": dup_lines.astype(np.int64), "n_repeat_words": repeated.astype(np.int64),
        "log_words": np.log1p(n_words), "chars_per_word": (points - spaces) / words,
        "symbols_per_word": symbols / words, "dup_line_share": dup_lines / np.maximum(n_lines, 1),
        "repeat_word_share": repeated / words, "distinct_word_share": distinct / words,
        "upper_share": upper / np.maximum(upper + lower, 1), "digit_share": digits / chars,
        "stops_per_word": stops / words, "marks_per_word": marks / words,
        "words_per_line": np.log1p(n_words / np.maximum(n_lines, 1)), "wide_share": wide / chars,
        "bars_per_word": bars / words, "longest_word_share": longest / chars,
        "top_byte_share": per.max(axis=1) / np.maximum(per.sum(axis=1), 1),
    }


def text_stats(col: pa.Array) -> dict[str, np.ndarray]:
    """COUNTS (long) and FEATURES (double) of every row of a text column; a null text counts as empty."""
    parts = [_group_stats(d, o) for _, _, d, o in groups(col)]
    if not parts:
        return {k: np.zeros(0, dtype=np.int64 if k in COUNTS else float) for k in (*COUNTS, *FEATURES)}
    return {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}


def feature_matrix(stats: dict[str, np.ndarray]) -> np.ndarray:
    return np.stack([stats[f] for f in FEATURES], axis=1) if len(stats["n_words"]) else np.zeros((0, len(FEATURES)))
