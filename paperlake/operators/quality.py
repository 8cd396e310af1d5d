"""Counts that describe how a batch went through the rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperlake.functions.text import NULL_SPELLINGS, clean_text, doi_is_valid, long_enough


def source_counts(refined: DataFrame) -> DataFrame:
    """Rows per source after the rules: one aggregate instead of one count per source."""
    return refined.groupBy("source").agg(F.count("*").alias("n_rows"))


def quality_report(papers: DataFrame, min_title_length: int) -> DataFrame:
    """Per source: rows in, rows kept, and why or in which state the others are."""
    titled = F.coalesce(long_enough(clean_text(F.col("title")), min_title_length), F.lit(False))
    counts = {
        "rows_in": F.lit(True),
        "rows_kept": titled,
        "short_titles": ~titled,
        "null_abstracts": clean_text(F.col("abstract")).isNull(),
        "invalid_dois": F.col("doi").isNotNull() & ~doi_is_valid(F.col("doi")),
        "null_spelled_dois": F.coalesce(F.col("doi").isin(*NULL_SPELLINGS), F.lit(False)),
    }
    return papers.groupBy("source").agg(*[F.count_if(test).alias(name) for name, test in counts.items()])


def stale_doi_flags(master: DataFrame) -> DataFrame:
    """Per source: rows whose kept DOI is valid while the flag says it is not.

    The upsert can leave such rows: the flag is never null and so always comes
    from the staged row, while a null staged DOI leaves the older one in place.
    """
    stale = doi_is_valid(F.col("doi")) & ~F.col("doi_valid")
    return master.groupBy("source").agg(
        F.count("*").alias("n_rows"), F.count_if(stale).alias("stale_flags")
    )
