"""Cleaning, title, length and DOI rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: null spellings and DOI pattern ---
NULL_SPELLINGS = ("null", "NULL")
DOI_PATTERN = r"^10\.\d{4,}/.+"


def clean_text(c: Column) -> Column:
    """Trimmed text; null when blank or when the untrimmed value spells null.

    Only U+0020 is trimmed and the null spelling is tested before trimming, so
    ``' null '`` becomes ``'null'`` and a lone tab is kept.
    """
    return F.when(~c.isin(*NULL_SPELLINGS) & (F.trim(c) != ""), F.trim(c))


def long_enough(c: Column, min_chars: int) -> Column:
    """True when the trimmed text has at least ``min_chars`` characters; null for null."""
    return F.length(F.trim(c)) >= min_chars


def truncate(c: Column, max_chars: int) -> Column:
    """The first ``max_chars`` characters; shorter text and null stay as they are."""
    return F.substring(c, 1, max_chars)


def doi_is_valid(c: Column) -> Column:
    """Whether a DOI has the registered form; never null."""
    return F.coalesce(c.rlike(DOI_PATTERN), F.lit(False))


def embedding_text(*parts: Column) -> Column:
    """The text given to the encoder: the non-null parts joined by one space."""
    return F.concat_ws(" ", *parts)
