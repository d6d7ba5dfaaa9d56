"""The corpus pipeline: five stages over `documents`, each written as Parquet
and reread as the next one's input.

Language ID drops documents without a language, near-dedup keeps one document of
each group, decontamination drops documents that hold a benchmark passage, the
secret scan redacts what it finds, and packing returns the pieces' places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakesync.llm import decontaminate, language_id, near_dedup, packing, secrets_scan
from lakesync.llm.common import stored, table
from lakesync.llm.queries import tokenizer_path


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language; the model learns from the rows of
    ``docs`` with a lang value. Texts without letters (or null) go."""
    model = language_id.fit(docs)
    return language_id.in_a_language(docs, model)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity
    0.8), that of the smallest doc_id; documents without words stay."""
    return near_dedup.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in their texts."""
    return secrets_scan.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all token pieces."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("language_id", language_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("secret_scan", secret_stage),
    ("best_fit_packing", packing_stage),
]

# Sketches, fitted models and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
