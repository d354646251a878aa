"""Personal data with a skip-chain conditional random field.

Exact patterns (with Luhn, octet and digit-count checks) give the base spans.
Around them a CRF labels every token that holds a digit or an ``@``: its unary
potentials come from the token's shape, neighbours share a chain potential,
and distant tokens that repeat or resemble each other (same text, same
digits, same last seven digits) share a skip potential, so that an entity
keeps its label throughout a document. Loopy sum-product message passing
gives the marginals. Tokens under a base span are clamped to its label; an
unclamped token with an ``@`` or seven digits whose marginal favours a label
adds a span.

The potentials are trained piecewise (counts of labels by shape, of label
pairs on chain edges and on skip edges), from the base spans of all documents.
The patterns do not label everything: a token without a label that repeats or
resembles a labelled one is hidden from the counts, not counted as "none". So
skip potentials say how labels agree where they are known. And as the marks by
which a pattern knows its entity may be what another form of it lacks, a share of
the "none" counts of every shape (``doubt``) goes to the other labels, as common as they are: too little for
an entity by itself, enough for one that a linked token is.

Offsets are code points, ends exclusive. Edge cases: a null text counts as
empty and has no spans (``base_sha256`` of the empty string). Repeated rows
and null ids are answered each. Long texts are searched whole: each token has
one skip edge per key, to the next token with that key, so edges grow with
the number of tokens. Other columns are not read by the query; ``redact``
keeps them.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import add_columns, columns, free_name, table

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
# The base patterns
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@]+")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(c)] for c in even)) % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind index) by start, then kind."""
    out = []
    done, at = 0, text.find("@")
    while at >= 0:  # a match holds one @, and begins where the run of local characters before it does
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _EMAIL.match(text, start) if start < at else None
        if m:
            out.append((start, m.end(), 0))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    if _HINT.search(text):
        out += [(m.start(), m.end(), 1) for m in _IP.finditer(text) if all(map(_octet, m[0].split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
                out.append((m.start(), m.end(), 2))
        if "+" in text:
            out += [(m.start(), m.end(), 3) for m in _PHONE.finditer(text)
                    if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


@dataclass
class Tokens:
    """The tokens of a text that hold a digit or an @, and the edges among them."""

    span: list[tuple[int, int]]
    shape: list[str]
    strong: list[bool]  # an @ or at least seven digits: only such a token is an entity by itself
    label: np.ndarray  # of the base spans; 0: none
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]


def _shape(token: str, digits: str) -> str:
    n = len(digits)
    size = "0" if not n else "1-6" if n < 7 else "7-9" if n < 10 else "10-13" if n < 14 else "14-19" if n < 20 else "20+"
    dots = min(token.count("."), 4)
    good = n and 14 <= n <= 19 and luhn(digits)
    parts = token.strip(".,;:!?()").split(".")
    ip = len(parts) == 4 and all(p.isascii() and p.isdigit() and _octet(p) for p in parts)
    return f"{size}|{dots}|{token.count('@') > 0:d}|{token[0] == '+':d}|{any(map(str.isalpha, token)):d}|{bool(good):d}|{ip:d}"


def hidden(t: Tokens) -> np.ndarray:
    """Tokens without a label that a skip edge links to a labelled one: what they are is not known."""
    out = np.zeros(len(t.span), dtype=bool)
    for a, b in t.skip:
        out[a] |= not t.label[a] and t.label[b] > 0
        out[b] |= not t.label[b] and t.label[a] > 0
    return out


def tokens_of(text: str, spans: list[tuple[int, int, int]]) -> Tokens:
    t = Tokens([], [], [], np.zeros(0, dtype=int), [], [])
    last, keys_at = 0, {}
    labels = []
    k = 0
    for m in _HINT.finditer(text):
        if m.start() < last:
            continue
        a, z = m.start(), m.end()
        while a > last and not text[a - 1].isspace():
            a -= 1
        while z < len(text) and not text[z].isspace():
            z += 1
        token, i = text[a:z], len(t.span)
        digits = _NOT_DIGIT.sub("", token)
        t.span.append((a, z))
        t.shape.append(_shape(token, digits))
        t.strong.append("@" in token or len(digits) >= 7)
        if i and text[last:a].isspace():
            t.chain.append((i - 1, i))
        keys = {("t", token.strip(".,;:!?()").lower())}
        if len(digits) >= 7:
            keys |= {("d", digits), ("s", digits[-7:])}
        for key in sorted(keys):
            if key in keys_at and (keys_at[key], i) not in t.skip[-3:]:
                t.skip.append((keys_at[key], i))
            keys_at[key] = i
        while k < len(spans) and spans[k][1] <= a:
            k += 1
        labels.append(next((s[2] + 1 for s in spans[k:k + 8] if s[0] < z and s[1] > a), 0))
        last = z
    t.label = np.array(labels, dtype=int)
    return t


@dataclass(frozen=True)
class Crf:
    unary: dict[str, np.ndarray]  # log potentials by shape
    other: np.ndarray             # of unseen shapes
    chain: np.ndarray             # (labels, labels)
    skip: np.ndarray

    def marginals(self, t: Tokens, rounds: int = 8) -> np.ndarray:
        """Loopy sum-product over chain and skip edges, all messages at once each round."""
        n, width = len(t.span), len(LABELS)
        u = np.array([self.unary.get(s, self.other) for s in t.shape])
        clamped = t.label > 0
        u[clamped] = -30.0
        u[clamped, t.label[clamped]] = 0.0
        edges = [(a, b, 0) for a, b in t.chain] + [(a, b, 1) for a, b in t.skip]
        if edges:
            a, b, kind = (np.array(x) for x in zip(*edges, strict=True))
            src, dst = np.concatenate([a, b]), np.concatenate([b, a])
            pot = np.stack([self.chain, self.skip])[kind]
            pot = np.exp(np.concatenate([pot, pot.transpose(0, 2, 1)]))
            back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
            msg = np.zeros((len(src), width))
            for _ in range(rounds):
                belief = u.copy()
                np.add.at(belief, dst, msg)
                out = belief[src] - msg[back]
                out = np.exp(out - out.max(axis=1, keepdims=True))
                new = np.log(np.einsum("el,elm->em", out, pot) + 1e-30)
                msg = 0.5 * msg + 0.5 * (new - new.max(axis=1, keepdims=True))
            np.add.at(u, dst, msg)
        p = np.exp(u - u.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def find(text: str, crf: Crf, threshold: float = 0.6) -> tuple[list, list]:
    """(base spans, base and added spans), each (start, end, kind index) by start, then kind."""
    if not _HINT.search(text):
        return [], []
    base = base_spans(text)
    t = tokens_of(text, base)
    free = [i for i in np.flatnonzero(t.label == 0) if t.strong[i]]
    if not free:
        return base, base
    p = crf.marginals(t)
    kind, sure = p.argmax(axis=1), p.max(axis=1) >= threshold
    joined = set(t.chain)
    added = set()
    for i in free:
        if not kind[i] or not sure[i]:
            continue
        first = last = i  # with its neighbours of the same label: the parts of one number
        while (first - 1, first) in joined and kind[first - 1] == kind[i] and t.label[first - 1] == 0 and not t.strong[first - 1]:
            first -= 1
        while (last, last + 1) in joined and kind[last + 1] == kind[i] and t.label[last + 1] == 0 and not t.strong[last + 1]:
            last += 1
        a, z = t.span[first][0], t.span[last][1]
        raw = text[a:z]
        a += len(raw) - len(raw.lstrip("[{<\"'"))
        z -= len(raw) - len(raw.rstrip(".,;:!?]}>\"'"))
        if a < z:
            added.add((a, z, int(kind[i]) - 1))
    return base, sorted([*base, *added], key=lambda s: (s[0], s[2]))


def train(docs: DataFrame, text: str = "text", doubt: float = 0.05) -> Crf:
    """Potentials from counts over all documents; the counts are few (shapes and label pairs).

    ``doubt``: share of the tokens no pattern labels that may be personal data all the same.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter = Counter()
        for b in batches:
            for value in b.column(text):
                doc = value.as_py()
                if doc and _HINT.search(doc):
                    t = tokens_of(doc, base_spans(doc))
                    unknown = hidden(t)
                    n.update(("unary", s, int(y)) for s, y, skip in zip(t.shape, t.label, unknown, strict=True) if not skip)
                    for name, edges in (("chain", t.chain), ("skip", t.skip)):
                        n.update((name, str(t.label[i]), int(t.label[j])) for i, j in edges if not (unknown[i] or unknown[j]))
        yield pa.RecordBatch.from_pydict(
            {"part": [k[0] for k in n], "key": [k[1] for k in n], "label": [k[2] for k in n], "n": list(n.values())},
            pa.schema([("part", pa.string()), ("key", pa.string()), ("label", pa.int64()), ("n", pa.int64())]))

    got = (docs.select(text).mapInArrow(count, "part string, key string, label long, n long")
           .groupBy("part", "key", "label").agg(F.sum("n").alias("n")).collect())
    width = len(LABELS)
    unary: dict[str, np.ndarray] = {}
    pairs = {"chain": np.full((width, width), 0.5), "skip": np.full((width, width), 0.5)}
    for r in got:
        if r["part"] == "unary":
            unary.setdefault(r["key"], np.full(width, 0.1))[r["label"]] += r["n"]
        else:
            pairs[r["part"]][int(r["key"]), r["label"]] += r["n"]
    kinds = sum(unary.values(), np.full(width, 0.1))[1:]
    doubted = np.concatenate([[1 - doubt], doubt * kinds / kinds.sum()])  # of a token that no pattern labels
    for v in unary.values():
        v += v[0] * (doubted - np.eye(width)[0])

    def association(c: np.ndarray, most: float) -> np.ndarray:
        """Log of observed over expected under independence: 0 where a pair says nothing."""
        c = (c + c.T) / 2
        return np.clip(np.log(c * c.sum() / np.outer(c.sum(1), c.sum(0))), -most, most)

    return Crf({k: np.log(v / v.sum()) for k, v in unary.items()}, np.log(doubted),
               association(pairs["chain"], 4), association(pairs["skip"], 6))


RESULT_DDL = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{z}" for a, z, k in spans)


def detect(docs: DataFrame, crf: Crf, text: str = "text") -> DataFrame:
    """``docs`` with the base counts, the digest of the base spans and all spans."""
    def one(col: pa.Array) -> dict:
        counts, digests, spans = [], [], []
        for value in col:
            base, every = find(value.as_py() or "", crf)
            n = Counter(k for _, _, k in base)
            counts.append([n[k] for k in range(len(KINDS))])
            digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
            spans.append(_joined(every))
        c = np.array(counts, dtype=np.int64).reshape(-1, len(KINDS))
        return {f"n_{k}": c[:, i] for i, k in enumerate(KINDS)} | {
            "base_sha256": pa.array(digests, pa.string()), "spans": pa.array(spans, pa.string())}

    return add_columns(docs, RESULT_DDL, text, one)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans become one."""
    out, done = [], 0
    for a, z, k in spans:
        if a >= done:
            out += [text[done:a], f"[{KINDS[k].upper()}]"]
        done = max(done, z)
    return "".join([*out, text[done:]])


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: all documents, personal data replaced by ``[KIND]``; ``n_chars`` follows the new text."""
    crf, name = train(docs), free_name(docs, "masked")

    def one(col: pa.Array) -> dict:
        texts = (v.as_py() for v in col)
        return {name: pa.array([masked(t, find(t, crf)[1]) if t else t for t in texts], pa.string())}

    out = add_columns(docs, f"`{name}` string", "text", one)
    cols = {"text": F.col(name), "n_chars": F.when(F.col(name).isNull(), F.col("n_chars")).otherwise(
        F.char_length(name).cast("long"))} if "n_chars" in docs.columns else {"text": F.col(name)}
    return out.select(*[cols.get(n, c).alias(n) for n, c in zip(docs.columns, columns(docs), strict=True)])


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return detect(docs, train(docs)).drop("text")
