"""License scans with a positional rare-token index.

Templates are word sequences with a mandatory key phrase. The inverse
document frequency of every template word is counted over all documents; a
template is indexed by the positions of the highest-IDF words of its key
phrase. A document's words are looked up by the rarest word of a phrase; that
word's relative positions (in the document minus in the template) are then
intersected with those of the phrase's next rarest words, until none is left
or all agree. An alignment that remains counts only if the key phrase stands there
word for word. Its score is the IDF share of the template's words that stand in
place. An occurrence of the phrase holds all of its words, so none is missed.

The three base phrases are templates of their own. Edge cases: a null or
empty text has no words, no labels, score 0 and null first and last word.
Repeated rows and null ids are answered each. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import add_columns, table
from .op2_decontaminate import words_of

# Label, template words, mandatory phrase. The first three are the base phrases.
BASE = (
    ("mit", "mit license", "mit license"),
    ("apache", "apache license", "apache license"),
    ("gpl", "general public license", "general public license"),
)
TEMPLATES = BASE + (
    ("agpl-3.0", "gnu affero general public license version 3", "affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     "redistribution and use in source and binary forms"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-nc-nd-4.0", "licensed under cc by nc nd 4 0", "cc by nc nd 4 0"),
    ("cc-by-nc-sa-4.0", "licensed under cc by nc sa 4 0", "cc by nc sa 4 0"),
    ("cc-by-nd-4.0", "licensed under cc by nd 4 0", "cc by nd 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    ("cc0-1.0", "dedicated to the public domain under cc0 1 0", "cc0 1 0"),
    ("gpl-2.0", "gnu general public license version 2", "general public license version 2"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee",
     "permission to use copy modify and or distribute this software"),
    ("lgpl", "gnu lesser general public license", "lesser general public license"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     "permission is hereby granted free of charge"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "free and unencumbered software"),
)


def document_frequency(docs: DataFrame, templates=TEMPLATES) -> tuple[int, dict[str, int]]:
    """(documents, documents holding each template word), counted over all documents."""
    vocabulary = {w for _, t, _ in templates for w in words_of(t)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter = Counter()
        for b in batches:
            for text in b.column("text"):
                n.update(vocabulary.intersection(words_of(text.as_py())))
                n[b""] += 1
        yield pa.RecordBatch.from_pydict({"word": [w.decode() for w in n], "n": list(n.values())},
                                         pa.schema([("word", pa.string()), ("n", pa.int64())]))

    got = docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {r["word"]: r["n"] for r in got.collect()}  # at most the template words
    return found.pop("", 0), found


class Index:
    """Positions of the rare words of each template's key phrase, and what verifies an alignment."""

    def __init__(self, n_docs: int, frequency: dict[str, int], templates=TEMPLATES, base=BASE, rare_words: int = 3):
        def idf(w: bytes) -> float:
            return math.log((1 + n_docs) / (1 + frequency.get(w.decode(), 0))) + 1e-3

        self.by_rarest: dict[bytes, list[int]] = {}
        self.indexed: set[bytes] = set()
        self.templates, self.rare = [], []
        base_labels = {label for label, _, _ in base}
        for k, (label, text, phrase) in enumerate(templates):
            words, key = words_of(text), words_of(phrase)
            at = next(i for i in range(len(words)) if words[i:i + len(key)] == key)
            self.templates.append((label, words, [idf(w) for w in words], at, key, label in base_labels))
            ranked = sorted(range(at, at + len(key)), key=lambda i: (-idf(words[i]), words[i], i))[:rare_words]
            self.rare.append([(i, words[i]) for i in ranked])
            self.by_rarest.setdefault(words[ranked[0]], []).append(k)
            self.indexed.update(words[i] for i in ranked)

    def alignments(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """(template, shift) where all indexed words of the template's phrase stand in place."""
        where: dict[bytes, list[int]] = {}
        for at, w in enumerate(words):
            if w in self.indexed:
                where.setdefault(w, []).append(at)
        for w in where.keys() & self.by_rarest.keys():
            for k in self.by_rarest[w]:
                (first, _), *others = self.rare[k]
                shifts = {at - first for at in where[w]}
                for i, other in others:
                    shifts &= {at - i for at in where.get(other, ())} if shifts else shifts
                yield from ((k, shift) for shift in shifts)

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int]], dict[str, float]]:
        """(words, (template, key phrase start) of base templates, best score of each label)."""
        words = words_of(text)
        places, labels = [], {}
        for k, shift in self.alignments(words):
            label, template, weight, at, key, is_base = self.templates[k]
            start = shift + at
            if start < 0 or words[start:start + len(key)] != key:
                continue
            hit = sum(v for i, (w, v) in enumerate(zip(template, weight, strict=True))
                      if 0 <= shift + i < len(words) and words[shift + i] == w)
            labels[label] = max(labels.get(label, 0.0), hit / sum(weight))
            if is_base:
                places.append((k, start))
        return len(words), places, labels


RESULT_DDL = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan_licenses(docs: DataFrame, index: Index, text: str = "text") -> DataFrame:
    """``docs`` with the counts, labels and score of each whole text."""
    def one(col: pa.Array) -> dict:
        out: dict[str, list] = {c.split()[0]: [] for c in RESULT_DDL.split(", ")}
        for t in col:
            n, places, labels = index.scan(t.as_py())
            starts = [s for _, s in places]
            row = (n, len(starts), min(starts, default=None), max(starts, default=None),
                   ",".join(sorted({index.templates[k][0] for k, _ in places})), ",".join(sorted(labels)),
                   min(1.0, max(labels.values(), default=0.0)))
            for values, v in zip(out.values(), row, strict=True):
                values.append(v)
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        return {c: pa.array(v, k) for (c, v), k in zip(out.items(), kinds, strict=True)}

    return add_columns(docs, RESULT_DDL, text, one)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_licenses(docs, Index(*document_frequency(docs))).drop("text")
