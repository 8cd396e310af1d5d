"""From raw documents to a training mixture, in five stages.

Each stage takes what the one before kept, as rows of ``documents``, and decides on
all of it: texts without a recognised language go, one document of each group of near
copies stays, documents with benchmark passages go, secrets are blacked out, and
sources are brought to their shares of the mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paperlake.llm import decontaminate, language_id, mixing, ngram_join, secrets
from paperlake.session import materialize


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without letters and those whose language is little more than a guess."""
    return language_id.accepted(docs, language_id.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group linked by five-word shingles at 0.8."""
    return ngram_join.one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a benchmark item."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret; no document goes."""
    return secrets.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replicates documents to tempered source weights, in global random order."""
    return mixing.mix_sources(docs)


STAGES = [
    ("language_id", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("mixture", mixture),
]

# SQL cannot express the byte network of the first stage; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents below ``sf_dir``, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
