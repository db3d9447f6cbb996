"""Corpus pipeline: quality rules, exact dedup, SimHash near-dedup, PII, packing.

Each stage takes what the one before kept, as Parquet, and all but the last return the columns
of ``documents``. ``ORACLE_SQL`` is None: no SQL expresses the trained tagger, the tokenizer or
the packing order; ``tests/llm/test_pipeline.py`` compares with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cauce.llm import exact_dedup, pii, quality, simhash
from cauce.llm.base import documents, importable, written
from cauce.llm.packing import pack


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    importable(spark)
    return quality.kept_documents(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest doc_id stays."""
    importable(spark)
    return exact_dedup.distinct_documents(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates the smallest doc_id stays."""
    importable(spark)
    return simhash.distinct_documents(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    importable(spark)
    return pii.redacted(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all remaining documents."""
    importable(spark)
    return pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("simhash", near_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
