"""Paper identity, record fingerprint and PDF object path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.strip() removes; ids were made with that notion of blank.
STRIPPED_CHARACTERS = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def _normalized(c: Column) -> Column:
    return F.coalesce(F.trim(F.lower(c), F.lit(STRIPPED_CHARACTERS)), F.lit(""))


def paper_id(title: Column, authors: Column, publication_date: Column) -> Column:
    """Hex SHA-256 over the raw title, authors and date text.

    It must see the raw strings: cleaning or casting the date first changes ids.
    """
    parts = (_normalized(title), _normalized(authors), F.coalesce(publication_date, F.lit("")))
    return F.sha2(F.concat(parts[0], F.lit("||"), parts[1], F.lit("||"), parts[2]), 256)


def record_hash(*columns: Column) -> Column:
    """60-bit fingerprint of a record's content: MD5 over the MD5 of each value, ``-`` for null."""
    values = [F.coalesce(F.md5(c.cast("string")), F.lit("-")) for c in columns]
    return F.conv(F.substring(F.md5(F.concat_ws(",", *values)), 1, 15), 16, 10).cast("bigint")


def pdf_object_path(bucket: str, source: Column, run_date: Column, id_: Column, url: Column) -> Column:
    """Where the PDF of a record is stored; null when the record has no URL."""
    path = F.concat(
        F.lit(f"s3://{bucket}/raw_pdfs/"),
        source,
        F.lit("/"),
        F.date_format(run_date, "yyyy/MM/dd"),
        F.lit("/"),
        id_,
        F.lit(".pdf"),
    )
    return F.when(url != "", path)
