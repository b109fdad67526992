"""From raw documents to token ids: quality, exact and near duplicates, benchmark leaks, encoding.

Every stage takes the documents that its predecessor kept and all but the last return them with their columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from panelmill.llm.common import store, table
from panelmill.llm.decontaminate import drop_contaminated
from panelmill.llm.exact_dedup import drop_exact
from panelmill.llm.minhash_join import drop_near
from panelmill.llm.prefix_bpe import encode_documents
from panelmill.llm.quality_trees import drop_low_quality
from panelmill.llm.queries import VOCABULARY

#: The classifier has no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return drop_low_quality(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_exact(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return drop_near(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, with their number and digests, of what is left; an id that does not decode to the text raises."""
    return encode_documents(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, keep_ids=True)


STAGES = [("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("encode", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}").df
    return STAGES[-1][1](spark, docs, sf_dir)
