"""Quality classifier: histogram gradient-boosted trees over document statistics.

Learned from ``labels.quality`` of the rows whose crc32(doc_id as text) mod 5
is not 0 (a bounded sample of them, ``max_rows``), flattened into arrays, and
applied to every whole text in vectorised batches. Only statistics of the
text are inputs.

Edge cases: a null text counts as empty and gets the score of an empty text.
A null ``doc_id`` gives ``held_out`` false. Repeated rows are scored each.
Without usable labels the score is the prior 0.5 for every row. ``classify``
keeps all columns of its input and fails early if a result column exists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import trees
from .docstats import feature_matrix, text_stats
from .frames import add_columns, columns, fold, free_name, table
from .labelled import labelled_statistics

FOLDS, THRESHOLD = 5, 0.3


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, **params) -> trees.Forest:
    """The forest of at most ``max_rows`` labelled rows outside the held-out fold."""
    x, y = labelled_statistics(docs, labels, fold(F.col("doc_id"), FOLDS) != 0, max_rows)
    return trees.fit(x, y, **params)


def classify(docs: DataFrame, forest: trees.Forest, score: str = "score", text: str = "text") -> DataFrame:
    """``docs`` with the probability of label 1 of each whole text in column ``score``."""
    return add_columns(docs, f"`{score}` double", text,
                       lambda col: {score: forest.score(feature_matrix(text_stats(col)))})


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that the classifier does not reject, with their columns."""
    forest = train(docs, table(spark, sf_dir, "labels"))
    name = free_name(docs, "score")
    return classify(docs, forest, name).where(F.col(name) >= THRESHOLD).select(*columns(docs))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = classify(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == 0, F.lit(False)).alias("held_out"),
                         "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).cast("int").alias("predicted"))
