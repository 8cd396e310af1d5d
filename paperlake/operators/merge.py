"""Upsert of staged papers into the master relation.

Rows match on id, year, month and day. A matched row takes every staged value
that is not null and the staged stamp; an unmatched staged row is added as is.
Both sides hold one row per id, so no join key is hot whatever the date skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperlake import schema

_KEYS = list(schema.MERGE_KEYS)


def _staged_first(column: str) -> Column:
    return F.coalesce(F.col(f"staged.{column}"), F.col(f"kept.{column}")).alias(column)


def merge(target: DataFrame, staging: DataFrame) -> DataFrame:
    """The target after the upsert: one full outer join.

    Rows are dealt by id alone, as the dedup leaves them, so staged texts are not shuffled
    again for the join. The date is compared where ids meet; as a difference, because
    Spark would deal by the sides of an equality.
    """
    marked = staging.withColumn("_staged", F.lit(True))
    same_day = [F.col(f"kept.{c}") - F.col(f"staged.{c}") == 0 for c in schema.PARTITION_COLUMNS]
    same = [F.col("kept.id") == F.col("staged.id"), *same_day]
    joined = target.alias("kept").join(marked.alias("staged"), same, "full_outer")
    stamp = F.when(F.col("_staged"), F.col("staged.ingestion_timestamp")).otherwise(
        F.col("kept.ingestion_timestamp")
    )
    return joined.select(
        *[stamp.alias(c) if c == "ingestion_timestamp" else _staged_first(c) for c in schema.MASTER_TABLE_COLUMNS]
    )


def matched_rows(target: DataFrame, staging: DataFrame) -> DataFrame:
    """Only the rows the upsert updates, with their new values."""
    joined = target.alias("kept").join(staging.alias("staged"), _KEYS, "inner")
    stamp = F.col("staged.ingestion_timestamp")
    return joined.select(
        *[F.col(c) if c in _KEYS else stamp if c == "ingestion_timestamp" else _staged_first(c) for c in schema.MASTER_TABLE_COLUMNS]
    )


def inserted_rows(target: DataFrame, staging: DataFrame) -> DataFrame:
    """Only the rows the upsert adds."""
    return staging.join(target.select(*_KEYS), _KEYS, "left_anti").select(*schema.MASTER_TABLE_COLUMNS)
