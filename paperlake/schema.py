"""Schemas of the raw records, the refined papers and the vector table."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: paper columns, in table order ---
PAPER_FIELDS: tuple[tuple[str, str], ...] = (
    ("id", "string"),
    ("doi", "string"),
    ("title", "string"),
    ("authors", "string"),
    ("abstract", "string"),
    ("full_text", "string"),
    ("journal", "string"),
    ("publication_date", "date"),
    ("keywords", "string"),
    ("pdf_url", "string"),
    ("pdf_s3_path", "string"),
    ("source", "string"),
    ("ingestion_timestamp", "timestamp"),
)

# --- Fixed values: columns that get the text cleaning rule ---
CLEANED_FIELDS: tuple[str, ...] = ("title", "abstract", "full_text", "authors", "keywords")

PARTITION_COLUMNS: tuple[str, ...] = ("year", "month", "day")
MERGE_KEYS: tuple[str, ...] = ("id", *PARTITION_COLUMNS)

# The business columns of the master table: every paper field but the stamp, plus the DOI flag.
MASTER_COLUMNS: tuple[str, ...] = (
    *(name for name, _ in PAPER_FIELDS if name != "ingestion_timestamp"),
    "doi_valid",
)
# What a record says. The PDF path names the day of the run that fetched it.
CONTENT_COLUMNS: tuple[str, ...] = tuple(c for c in MASTER_COLUMNS if c != "pdf_s3_path")
MASTER_TABLE_COLUMNS: tuple[str, ...] = (*MASTER_COLUMNS, *PARTITION_COLUMNS, "ingestion_timestamp")

# --- Fixed values: payload stored beside each vector ---
PAYLOAD_FIELDS: tuple[str, ...] = ("id", "title", "authors", "publication_date", "doi", "source")


def _struct(fields: list[tuple[str, str]]) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in fields))


def raw_schema() -> T.StructType:
    """Landed records as text: dates and stamps are ISO strings."""
    return _struct([(name, "string") for name, _ in PAPER_FIELDS])


def paper_schema() -> T.StructType:
    return _struct(list(PAPER_FIELDS))


def raw_table_schema() -> T.StructType:
    return _struct(
        [
            *PAPER_FIELDS,
            ("doi_valid", "boolean"),
            ("record_hash", "bigint"),
            ("landed_at", "timestamp"),
            *((c, "int") for c in PARTITION_COLUMNS),
        ]
    )


def master_schema() -> T.StructType:
    kinds = {**dict(PAPER_FIELDS), "doi_valid": "boolean", **{c: "int" for c in PARTITION_COLUMNS}}
    return _struct([(c, kinds[c]) for c in MASTER_TABLE_COLUMNS])


def points_schema() -> T.StructType:
    payload = ", ".join(f"{n}: {dict(PAPER_FIELDS)[n]}" for n in PAYLOAD_FIELDS)
    return _struct(
        [
            ("id", "string"),
            ("vector", "array<float>"),
            ("payload", f"struct<{payload}>"),
            ("text_hash", "string"),
            *((c, "int") for c in PARTITION_COLUMNS),
        ]
    )
