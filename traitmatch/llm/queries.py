"""The registered queries of the text operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from traitmatch.llm.bpe import encode_documents
from traitmatch.llm.contamination import FIND_CONTAMINATION_SQL, find_contamination
from traitmatch.llm.fixity import AUDIT_SQL, audit_damaged_copy
from traitmatch.llm.jaccard import JACCARD_SQL, jaccard_components
from traitmatch.llm.langid import predict_language
from traitmatch.llm.quality_model import score_quality
from traitmatch.llm.quality_rules import quality_rules
from traitmatch.llm.resampling import RESAMPLE_SQL, resample
from traitmatch.llm.secrets import scan_secrets
from traitmatch.llm.suffix_lm import score_documents
from traitmatch.llm.token_counts import count_tokens
from traitmatch.llm.toxicity import score_toxicity
from traitmatch.llm.whitening import whiten_embeddings


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_language(table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op5_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_damaged_copy(table(spark, sf_dir, "pages"))


def op6_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), max_run=1)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten_embeddings(table(spark, sf_dir, "embeddings"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_bpe_encode_decode, op2_jaccard_join, op3_language_id, op4_secret_scan, op5_merkle_fixity,
                              op6_suffix_tree_scores, op7_quality_rules, op8_quality_classifier, op9_decontamination,
                              op10_token_counts, op11_importance_resampling, op12_embedding_whitening, op13_toxicity)
}

ORACLE_SQL: dict[str, str] = {"op2_jaccard_join": JACCARD_SQL, "op5_merkle_fixity": AUDIT_SQL,
                              "op9_decontamination": FIND_CONTAMINATION_SQL, "op11_importance_resampling": RESAMPLE_SQL}
