"""Corpus pipeline: quality rules, line dedup, near-dedup, secret scans, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's ``docs``. All but the last return the
columns of ``documents`` (with ``n_chars`` brought up to date where the text
changes) and leave other columns alone:

1. quality rules drop the documents that fail them;
2. line dedup takes repeated lines out of the texts;
3. near-dedup keeps the document with the smallest id of each group
   (5-word shingles, similarity 0.8 or more);
4. the secret scan replaces every secret by a mark;
5. packing puts every document that is left into a length bucket and a batch.

Null texts fail the quality rules; an empty table stays empty through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbusmart.llm import linededup, neardup, packing, quality, secrets
from nimbusmart.llm.registry import ship_package
from nimbusmart.llm.tables import materialise, table

BYTE_VOCABULARY = "byte_bpe_50k.tiktoken"


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text, where there is such a column."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = quality.quality_verdict(F.col("text"))
    return docs.where(kept)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return _recounted(linededup.drop_repeated_lines(docs))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return neardup.drop_near_duplicates(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return _recounted(secrets.redact(docs, public_tokenizers.path(BYTE_VOCABULARY), public_tokenizers.PATTERN))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("secret_scan", secret_stage),
    ("packing", packing_stage),
]

# The secret scan's tokenizer and the similarity of word sets are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
