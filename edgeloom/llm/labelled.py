"""Training matrices from the ``labels`` table: a bounded sample of labelled texts and their statistics."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .docstats import FEATURES, feature_matrix, text_stats
from .frames import add_columns


def labelled_statistics(docs: DataFrame, labels: DataFrame, keep: Column | None = None,
                        max_rows: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """(features, quality) of at most ``max_rows`` labelled documents, the smallest by a hash of their id.

    ``keep``: condition on ``doc_id`` of the rows that may be learned from.
    ``max_rows`` bounds the sample only; the model made from it scores every row.
    """
    ids = (labels.select("doc_id", "quality").where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)))
    if keep is not None:
        ids = ids.where(keep)
    ids = (ids.groupBy("doc_id").agg(F.max("quality").alias("quality"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    texts = docs.select(F.col("doc_id"), F.col("text")).where(F.col("text").isNotNull())
    texts = texts.join(F.broadcast(ids), "doc_id").select("doc_id", "quality", "text")  # max_rows ids at most
    stats = add_columns(texts, ", ".join(f"{f} double" for f in FEATURES), "text", text_stats)
    got = (stats.drop("text").orderBy(F.xxhash64("doc_id"), "doc_id", *FEATURES).limit(max_rows).toArrow())
    x = feature_matrix({f: got.column(f).to_numpy() for f in FEATURES} | {"n_words": got.column("doc_id")})
    return x, got.column("quality").to_numpy().astype(float)
