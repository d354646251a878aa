"""Language identification: family first, then one-versus-one linear support vector machines.

Features are hashed byte bigrams and trigrams of the letters (A-Z lowered,
everything that is not a letter is one space), square-rooted and scaled to
length one. One linear machine per family decides the family; inside it, a
linear machine for each pair of languages votes with its margin.

Training uses at most ``per_language`` rows of a language and ``max_rows`` in
all (both documented bounds of the sample), rows whose crc32(doc_id as text)
mod 3 is not 1 and whose lang and text are not null. Every text is predicted
whole.

Edge cases: a null text, or one without any letter, is ``und`` with score 0;
so is every row if nothing could be learned. A null ``doc_id`` gives
``held_out`` false. Repeated rows are answered each. Other columns are not
read by the query; ``identify`` keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .frames import add_columns, fold, table
from .words import groups

FOLDS, HELD_OUT, WIDTH = 3, 1, 2048
# Families of ISO 639-1 codes. A language not listed is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fo", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "ky", "tr", "tt", "uz"),
    "indo-aryan": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "semitic": ("ar", "he", "mt"),
}
_LETTER = np.array([32 if b < 128 and not chr(b).isalpha() else b + 32 if 65 <= b <= 90 else b for b in range(256)],
                   dtype=np.uint32)
_IS_ASCII_LETTER = np.array([b < 128 and chr(b).isalpha() for b in range(256)])


def family_of(lang: str) -> str:
    return next((f for f, codes in FAMILIES.items() if lang in codes), f"={lang}")


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(rows, WIDTH) unit vectors of hashed letter n-grams."""
    n = len(offsets) - 1
    out = np.zeros(n * WIDTH)
    for lo in range(0, len(data), 1 << 20):  # n-grams that begin in this part of the bytes
        b = _LETTER[data[lo:lo + (1 << 20) + 2]]
        for size in (2, 3):
            starts = min(len(b) - size + 1, 1 << 20)
            if starts <= 0:
                continue
            code = b[:starts].copy()
            for k in range(1, size):
                code = code * np.uint32(256) + b[k:starts + k]
            at = np.arange(lo, lo + starts)
            row = np.searchsorted(offsets, at, "right") - 1
            ok = (at + size <= offsets[row + 1]) & ((code & np.uint32(0xFFFF)) != 0x2020)
            slot = (code[ok] * np.uint32(2654435761)) >> np.uint32(21)  # 2**11 slots
            out += np.bincount(row[ok] * WIDTH + slot, minlength=n * WIDTH)
    x = np.sqrt(out.reshape(n, WIDTH))
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text holds a letter of any script."""
    total = np.concatenate([[0], np.cumsum(_IS_ASCII_LETTER[data])])
    out = total[offsets[1:]] > total[offsets[:-1]]
    for i in np.flatnonzero(~out):
        raw = data[offsets[i]:offsets[i + 1]]
        if len(raw) and raw.max() >= 0x80:
            out[i] = any(c.isalpha() for c in raw.tobytes().decode("utf-8", "replace"))
    return out


def linear_svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, steps: int = 150) -> np.ndarray:
    """Weights (and a last bias) of the squared-hinge linear machine for labels -1 and +1, by accelerated descent."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * len(y)
    rate = 1 / (1 + 4 * cost * share.max())
    w = v = np.zeros(x1.shape[1])
    for k in range(steps):
        gap = np.maximum(0, 1 - y * (x1 @ v))
        grad = v - 2 * cost / len(y) * (x1.T @ (share * gap * y))
        new = v - rate * grad
        v, w = new + k / (k + 3) * (new - w), new
    return w


@dataclass(frozen=True)
class Model:
    families: list[str]
    members: dict[str, list[str]]
    top: np.ndarray                                # (families, WIDTH + 1)
    pairs: dict[str, list[tuple[int, int, np.ndarray]]]  # family -> (i, j, weights): positive for i

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language, score 0 to 1) of each row."""
        lang, score = np.full(len(x), "und", dtype=object), np.zeros(len(x))
        if not self.families or not len(x):
            return lang, score
        x1 = np.hstack([x, np.ones((len(x), 1))])
        f, p = _choose(x1 @ self.top.T)
        for k, name in enumerate(self.families):
            rows = np.flatnonzero(f == k)
            votes = np.zeros((len(rows), len(self.members[name])))
            for i, j, w in self.pairs[name]:
                d = np.clip(x1[rows] @ w, -1, 1)
                votes[:, i] += d
                votes[:, j] -= d
            best, q = _choose(votes)
            lang[rows] = np.array(self.members[name], dtype=object)[best]
            score[rows] = p[rows] * q
        return lang, score


def _choose(value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    e = np.exp(2 * (value - value.max(axis=1, keepdims=True))) if value.size else np.zeros(value.shape)
    return (e.argmax(axis=1), e.max(axis=1) / e.sum(axis=1)) if value.size else (np.zeros(0, int), np.zeros(0))


def fit(x: np.ndarray, langs: np.ndarray) -> Model:
    known = sorted(set(langs))
    members: dict[str, list[str]] = {}
    for lang in known:
        members.setdefault(family_of(lang), []).append(lang)
    families = sorted(members)
    of = np.array([family_of(lang) for lang in langs], dtype=object)
    top = np.array([linear_svm(x, np.where(of == f, 1.0, -1.0)) if len(families) > 1 else np.zeros(WIDTH + 1)
                    for f in families])
    pairs = {}
    for f, names in members.items():
        pairs[f] = []
        for i in range(len(names)):
            for j in range(i + 1, len(names)):
                rows = (langs == names[i]) | (langs == names[j])
                pairs[f].append((i, j, linear_svm(x[rows], np.where(langs[rows] == names[i], 1.0, -1.0))))
    return Model(families, members, top, pairs)


def train(docs: DataFrame, per_language: int = 800, max_rows: int = 8_000) -> Model:
    """Model of a bounded sample: the rows of each language with the smallest hash of their id.

    Rows are counted by language first; then only a share of them, three times as many as wanted, goes to
    the ranking, so no task ranks a language's whole rows.
    """
    usable = (docs.where((fold(F.col("doc_id"), FOLDS) != HELD_OUT) & F.col("lang").isNotNull())
              .select("doc_id", "lang", "text").where("text is not null"))
    keys, slots = usable.select("doc_id", "lang"), 1 << 30
    sizes = keys.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(max_rows)
    share = F.least(F.lit(1.0), F.lit(3.0 * per_language) / F.col("n"))
    keys = (keys.join(F.broadcast(sizes), "lang")  # max_rows languages at most
            .where(F.pmod(F.xxhash64("doc_id"), F.lit(slots)) < share * slots))
    order = [F.pmod(F.xxhash64("doc_id"), F.lit(slots)), F.col("doc_id")]
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ids = keys.withColumn("rank", rank).where(F.col("rank") <= per_language)
    ids = ids.orderBy("rank", "lang").limit(max_rows).select("doc_id", "lang").distinct()
    sample = usable.join(F.broadcast(ids), ["doc_id", "lang"])  # max_rows ids at most

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offsets in groups(b.column("text"), rows=512):
                x = features(data, offsets).astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, j - i), b.column("lang").slice(i, j - i),
                     pa.array([r.tobytes() for r in x], pa.binary())], names=["doc_id", "lang", "x"])

    got = sample.mapInArrow(vectors, "doc_id long, lang string, x binary").limit(max_rows).toArrow().sort_by(
        [("doc_id", "ascending"), ("lang", "ascending"), ("x", "ascending")])
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), dtype=np.float32).reshape(-1, WIDTH).astype(float)
    return fit(x, np.array(got.column("lang").to_pylist(), dtype=object))


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` of each whole text."""
    def one(col: pa.Array) -> dict:
        langs, scores = [], []
        for _, _, data, offsets in groups(col, rows=512):
            lang, score = model.predict(features(data, offsets))
            none = ~has_letter(data, offsets)
            lang[none], score[none] = "und", 0.0
            langs.extend(lang)
            scores.append(score)
        return {"lang_pred": pa.array(langs, pa.string()), "score": np.concatenate(scores) if scores else np.zeros(0)}

    return add_columns(docs, "lang_pred string, score double", text, one)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = identify(docs.select("doc_id", "text"), train(docs))
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                      "lang_pred", "score")
