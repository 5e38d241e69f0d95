"""A corpus from raw documents to packed sequences: each stage's rows are written and read again as the next one's."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from assaylake.llm.common import documents, stored
from assaylake.llm.line_dedup import deduplicated
from assaylake.llm.mixing import mixed
from assaylake.llm.ngram_join import one_of_each
from assaylake.llm.packing import best_fit_packing
from assaylake.llm.quality_rules import keep_good

# Near-duplicates: shingles of five words, likeness in percent.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines are deleted; ``n_chars`` follows. Documents of which no line is left go."""
    return deduplicated(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return one_of_each(docs, NEAR_WORDS, NEAR_PERCENT)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences: one row per document or piece of one."""
    return best_fit_packing(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("line_dedup", lines), ("near_duplicates", near_duplicates), ("mix", mix), ("pack", pack)]

# Tokenization and the hashed draws of the mix are no SQL; tests compare with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
