"""Corpus pipeline: quality, near-duplicates, decontamination, secrets, packing.

Every stage reads its predecessor's Parquet and writes its own; all but the last return the
columns of ``documents``. Packing is not SQL, so ``run`` is tested against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from finflow.llm import decontam, near_dup, packing, quality, secrets
from finflow.llm.common import table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what the classifier scores 0.7 and more."""
    return quality.accepted(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group (five-word shingles, similarity 0.8 and more)."""
    return near_dup.one_of_each(docs.select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which benchmark windows cover a twentieth or more."""
    return decontam.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts; ``n_chars`` follows."""
    return secrets.redact(docs.select(*COLUMNS))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 2048 tokens."""
    return packing.packed(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; every stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
