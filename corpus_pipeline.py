"""From raw documents to token ids: five stages, each over all that the one before kept.

Between stages the documents are written as Parquet to the shared folder and read again, so
a lost executor costs no finished stage. Stages 1 to 4 return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storefront.llm import bpe
from storefront.llm.common import documents, land, load
from storefront.llm.decontamination import apply_decontamination
from storefront.llm.line_dedup import apply_line_dedup
from storefront.llm.ngram_join import apply_near_duplicates
from storefront.llm.quality_rules import apply_quality_rules

VOCABULARY = "word_bpe_49k.json"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, without their hosts' template lines."""
    return apply_quality_rules(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later copies of repeated runs of lines."""
    return apply_line_dedup(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return apply_near_duplicates(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return apply_decontamination(docs, load(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the ids of the text, and how many."""
    coded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path(VOCABULARY))
    return coded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", benchmark_stage),
    ("BPE encoding and decoding", token_stage),
]

# Stages 4 and 5 (SimHash radius, merges of a vocabulary) are beyond SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
