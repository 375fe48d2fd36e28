"""A corpus pipeline: each stage takes the documents that the one before it kept.

Every stage is a function of (spark, docs, sf_dir). All but the last return the columns of
``documents``; the last returns the encoded documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rostra.llm import decontaminate, pieces, quality, secrets, simhash
from rostra.llm.common import prepare, table
from rostra.session import staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the estimated quality rejects go."""
    prepare(spark)
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints link, by chains too, the one with the smallest identifier stays."""
    prepare(spark)
    return simhash.keep_one(docs, width=simhash.SHINGLE, radius=simhash.RADIUS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten consecutive words of a benchmark item go."""
    prepare(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay; their secrets are masked."""
    prepare(spark)
    return secrets.mask_secrets(docs)


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Identifier, ids and their number, and whether the ids decode to the text."""
    prepare(spark)
    return pieces.encoded_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("SentencePiece encoding and decoding", sentencepiece_encoding),
]

# Estimation, connected components and scored cuts are beyond SQL; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next one."""
    docs = table(prepare(spark), sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = staged(docs, f"stage-{number}")
    return docs
