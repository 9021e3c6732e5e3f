"""A training-data pipeline over ``documents``: quality rules, exact deduplication, near-duplicate
removal, secret redaction, packing.

Every stage works on all that its predecessor kept; its result is written as Parquet to the
shared checkpoint folder and read again. All stages but the last return the columns of
``documents``. A stage's result has to be written before the next stage is called: the tables it
was computed from are deleted then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mailsift.llm import exact, jaccard, packing, quality, secrets_scan
from mailsift.llm.bpe import vocabulary_path
from mailsift.llm.common import end_stages, next_stage, prepare, scratch, table

WORD_VOCABULARY = "word_bpe_49k.json"


def _begin(spark: SparkSession) -> None:
    prepare(spark)
    next_stage(spark)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or a certified cutoff reject go."""
    _begin(spark)
    return quality.filter_documents(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    _begin(spark)
    return exact.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id stays."""
    _begin(spark)
    return jaccard.drop_near_copies(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; no document goes."""
    _begin(spark)
    return secrets_scan.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    _begin(spark)
    return packing.pack_documents(docs, vocabulary_path(WORD_VOCABULARY))


STAGES = [
    ("quality rules", quality_stage),
    ("exact dedup", exact_stage),
    ("n-gram Jaccard join", near_stage),
    ("secret scans", secrets_stage),
    ("best-fit packing", packing_stage),
]

# Fingerprints, similarity joins and tokens are beyond SQL: tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    prepare(spark)
    folder = scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{number}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{number}")
    end_stages(spark)
    return docs
