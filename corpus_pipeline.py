"""From raw documents to token ids: five stages, each over all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringtally.llm import byte_bpe, language_mixture, mixing, near_dedup, quality_rules
from ringtally.llm.common import staged, table
from ringtally.llm.queries import tokenizer

# A document mostly in one of three languages still passes.
LEAST_SHARE = 0.34


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality rules reject go."""
    return quality_rules.good_documents(docs, table(spark, sf_dir, "labels"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language, or without a leading one, go."""
    return language_mixture.identified_documents(docs, LEAST_SHARE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return near_dedup.distinct_documents(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text."""
    coded = byte_bpe.round_trip(docs, *tokenizer())
    text = F.encode(F.coalesce("row.text", F.lit("")), "UTF-8")
    return coded.select(
        "row.doc_id",
        "row.lang",
        "row.source",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        (F.col("decoded") == text).alias("decodes"),
    )


STAGES = [
    ("quality_rules", quality),
    ("language_mixture", language),
    ("near_dedup", near_duplicates),
    ("mixing", mix),
    ("byte_bpe", tokens),
]

# Language inference, signatures and merges are beyond SQL; tests/llm/test_pipeline.py computes
# all five stages directly.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; what a stage returns is written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
