"""Quality rules: gradient-boosted trees over document statistics with monotonic constraints.

The trees are learned from ``labels.quality`` and flattened into numpy node
arrays; each batch of rows descends them level by level. Constraints state
what a rule must never do: more symbols, repeated lines, repeated words,
shouting or table bars never raise a score, and more distinct words never
lower it.

Edge cases: a null text counts as empty (no words, all counts 0, base rule
failed). A null ``doc_id`` is scored like any other row and returned as null.
Repeated rows are scored and returned each. Without usable labels every row
gets the prior (0.5), so only the base rule rejects. Other columns of the
input are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import trees
from .docstats import COUNTS, FEATURES, feature_matrix, text_stats
from .frames import add_columns, table
from .labelled import labelled_statistics

#: feature -> -1: the score never rises with it; +1: never falls
MONOTONE = {"symbols_per_word": -1, "dup_line_share": -1, "repeat_word_share": -1, "upper_share": -1,
            "bars_per_word": -1, "marks_per_word": -1, "longest_word_share": -1, "distinct_word_share": 1}
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
SCORE_DDL = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, " \
            "base_failed boolean, score double, kept boolean"


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, **params) -> trees.Forest:
    """The forest of a bounded sample (``max_rows`` labelled documents)."""
    x, y = labelled_statistics(docs, labels, max_rows=max_rows)
    return trees.fit(x, y, {FEATURES.index(f): s for f, s in MONOTONE.items()}, **params)


def apply_rules(docs: DataFrame, forest: trees.Forest, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """``docs`` with the counts, ``base_failed``, ``score`` and ``kept`` of each whole text."""
    def one(col):
        s = text_stats(col)
        failed = (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEATED_PERCENT * s["n_words"])
        score = forest.score(feature_matrix(s))
        return {c: s[c] for c in COUNTS} | {"base_failed": failed, "score": score,
                                            "kept": ~failed & (score >= threshold)}

    return add_columns(docs, SCORE_DDL, text, one)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    forest = train(docs, table(spark, sf_dir, "labels"))
    return apply_rules(docs, forest).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                            "n_repeat_words", "base_failed", "kept", "score")
