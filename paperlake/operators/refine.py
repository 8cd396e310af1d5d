"""Row-wise refinement: clean, drop bad titles, truncate, flag DOIs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperlake import schema
from paperlake.functions.dates import partition_values, within_lookback
from paperlake.functions.identity import record_hash
from paperlake.functions.text import clean_text, doi_is_valid, long_enough, truncate
from paperlake.settings import LakeSettings


def clean(df: DataFrame) -> DataFrame:
    return df.withColumns({name: clean_text(F.col(name)) for name in schema.CLEANED_FIELDS})


def keep_titled(df: DataFrame, min_chars: int) -> DataFrame:
    return df.filter(long_enough(F.col("title"), min_chars))


def truncate_long_text(df: DataFrame, abstract_chars: int, full_text_chars: int) -> DataFrame:
    return df.withColumns(
        {
            "abstract": truncate(F.col("abstract"), abstract_chars),
            "full_text": truncate(F.col("full_text"), full_text_chars),
        }
    )


def flag_doi(df: DataFrame) -> DataFrame:
    return df.withColumn("doi_valid", doi_is_valid(F.col("doi")))


def refine(df: DataFrame, settings: LakeSettings) -> DataFrame:
    """The whole chain: one narrow stage, no shuffle."""
    return (
        df.transform(clean)
        .transform(keep_titled, settings.min_title_length)
        .transform(truncate_long_text, settings.max_abstract_length, settings.max_full_text_length)
        .transform(flag_doi)
    )


def add_partition_columns(df: DataFrame) -> DataFrame:
    return df.withColumns(partition_values(F.col("publication_date")))


def add_record_hash(df: DataFrame) -> DataFrame:
    """Fingerprint of what a record says; neither stamps nor the run that fetched it count."""
    return df.withColumn("record_hash", record_hash(*map(F.col, schema.CONTENT_COLUMNS)))


def to_records(papers: DataFrame, stamp: Column | None = None) -> DataFrame:
    """Refined papers as raw-table rows: fingerprint, date partition, landing stamp, one stamp per batch."""
    batch_stamp = F.current_timestamp() if stamp is None else stamp
    return (
        papers.transform(add_partition_columns)
        .transform(add_record_hash)
        .withColumn("landed_at", F.col("ingestion_timestamp"))
        .withColumn("ingestion_timestamp", batch_stamp)
    )


def recent(df: DataFrame, as_of: dt.date | None, days: int) -> DataFrame:
    return df.filter(within_lookback(F.col("publication_date"), as_of, days))
