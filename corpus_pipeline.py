"""A corpus cleaning pipeline over ``documents``: five stages, each on all that its predecessor kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame.  All but the last return the columns of ``documents``;
the last returns the tokens of the documents that remain.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traitmatch.llm.bpe import encode_documents
from traitmatch.llm.contamination import drop_contaminated
from traitmatch.llm.jaccard import keep_one_per_component
from traitmatch.llm.quality_rules import keep_good
from traitmatch.llm.secrets import redact_secrets
from traitmatch.plans.lineage import cut_lineage


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the least id) of each group of linked documents, and all without a shingle."""
    return keep_one_per_component(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by a benchmark item."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with found secrets replaced by a mark (and ``n_chars`` set anew)."""
    return redact_secrets(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of every remaining document."""
    return encode_documents(docs, hand_back=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_stage),
    ("jaccard_join", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secret_scan", secret_stage),
    ("bpe_encoding", token_stage),
]

# Compression ratios, token-efficiency tests and BPE merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
