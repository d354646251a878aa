"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from edgeloom.llm import op1_mix, op2_decontaminate, op4_pii, op7_jaccard_join, op9_quality_classifier
from edgeloom.llm.frames import table, written

STAGES = [
    ("quality_classifier", op9_quality_classifier.keep_good),
    ("near_duplicates", op7_jaccard_join.drop_duplicates),
    ("decontamination", op2_decontaminate.drop_contaminated),
    ("personal_data", op4_pii.redact),
    ("mixing", op1_mix.mix_stage),
]

#: trained trees cannot be stated in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
