"""The corpus pipeline: five stages from raw documents to a training mix.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which :func:`run` writes as
Parquet below the shared checkpoint folder and reads again as the next stage's documents.
All stages but the last return the columns of their input.

Defined results, for every stage: a null or empty text is a document like any other (the classifier
scores it, its fingerprint is zero, it holds no benchmark window and no secret, and it has no tokens to
mix). Nulls in other columns stay. Very long texts are read whole, one at a time. Of repeated rows and
of rows that share an id or miss it, the near-duplicate stage keeps one of each group of near copies, ties going to the
least text. Empty tables pass through as empty tables with the same columns. Further columns, whatever their
names, come out as they went in; a document column called mix_rate or mix_copies makes the last stage
number its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketlake.llm import decontamination, mixing, quality_gam, secret_scan, simhash_dedup
from marketlake.llm._store import written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from these documents' labels, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_gam.good_documents(docs, quality_gam.fit_quality(docs, labels))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return simhash_dedup.near_duplicates_removed(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    return secret_scan.redacted(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with at least one copy in the mix, with their rate and copies."""
    return mixing.mixed_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("mixing sources to target weights", source_mixing),
]

#: a learned classifier, fingerprints and components are beyond SQL; tests hold a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage{number}")
    return docs
