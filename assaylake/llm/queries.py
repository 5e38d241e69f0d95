"""One query per operator over the whole documents table, with SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from assaylake.llm import oracles
from assaylake.llm.common import documents
from assaylake.llm.conversation_repair import repaired
from assaylake.llm.dual_tree_search import ranked_search
from assaylake.llm.fingerprints import document_fingerprints
from assaylake.llm.license_scan import license_scan
from assaylake.llm.line_dedup import line_dedup
from assaylake.llm.mixing import mix_sources
from assaylake.llm.ngram_join import ngram_classes
from assaylake.llm.packing import best_fit_packing
from assaylake.llm.quality_rules import MEASURES, quality_rules
from assaylake.llm.rule_ensemble import quality_scores
from assaylake.llm.sharding import balanced_shards
from assaylake.llm.suffix_dedup import removal_digests
from assaylake.llm.token_output import token_digests


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup(documents(spark, folder))


def op2_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    return token_digests(documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"))


def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan(documents(spark, folder))


def op3_license_layouts(spark: SparkSession, folder: str) -> DataFrame:
    """Licence scan that also finds notices within lines and licences of several paragraphs within documents."""
    return license_scan(documents(spark, folder), layouts=True)


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules(documents(spark, folder)).select("doc_id", *MEASURES, "base_failed", "kept")


def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return best_fit_packing(documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"))


def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return balanced_shards(documents(spark, folder))


def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return removal_digests(documents(spark, folder))


def op8_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_classes(documents(spark, folder))


def op9_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return document_fingerprints(documents(spark, folder))


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(documents(spark, folder)).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op11_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_scores(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repaired(spark.read.parquet(f"{folder}/conversations.parquet"))


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_token_ids,
        op3_license_scan,
        op4_quality_rules,
        op5_best_fit_packing,
        op6_sharding,
        op7_suffix_dedup,
        op8_ngram_join,
        op9_fingerprints,
        op10_mixing,
        op11_quality_classifier,
        op12_conversation_repair,
        op13_ranked_search,
        op3_license_layouts,
    )
} | {"pipeline": corpus_pipeline.run}
ORACLES = dict(oracles.SQL) | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
