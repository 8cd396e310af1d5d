"""Paper relations derived from the ``documents`` table.

The driver's tables hold no papers, so each document stands for one: its first
line is the title, its second the abstract, its whole text the full text.
Copies of a document share title, language and length, and so one paper id.
Editions differ in which fields are missing and which provider delivered a
document, so that an upsert of one edition into another has work to do.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperlake.functions.identity import paper_id
from paperlake.operators.dedup import best_per_key
from paperlake.operators.refine import add_partition_columns, refine
from paperlake.settings import LakeSettings
from paperlake.sources.records import to_papers

# Parameters of the registered queries.
AS_OF = dt.date(2024, 3, 1)
BUCKET = "papers-bucket"
DIM = 64
K = 10
MASTER_STAMP = "2024-02-01 00:00:00"
STAGING_STAMP = "2024-03-01 00:00:00"
SETTINGS = LakeSettings(root="", vector_dim=DIM)


# Declared schemas of the tables used; reading them needs no footer job.
TABLE_SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "benchmark": "item_id bigint, text string",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


_PROVIDERS = ", ".join(f"'{s.name}'" for s in SETTINGS.sources)


def raw_papers(spark: SparkSession, sf_dir: str, edition: int = 0) -> DataFrame:
    """``doc_id`` and the raw string columns of every document's record."""
    doc = f"(doc_id + {edition})"
    raw = table(spark, sf_dir, "documents").selectExpr(
        "doc_id",
        f"""case {doc} % 5 when 0 then concat('10.', 1000 + doc_id, '/', source)
            when 1 then concat('doi:10.1000/', source) when 2 then concat('10.12/', source)
            when 3 then concat('10.5555/', lang, ' ', source) end as doi""",
        "substring_index(text, char(10), 1) as title",
        "lang as authors",
        f"""case {doc} % 7 when 0 then 'null' when 1 then '   ' when 2 then null
            else regexp_extract(text, '^[^\\n]*\\n([^\\n]*)', 1) end as abstract""",
        "text as full_text",
        "concat('J ', source) as journal",
        "cast(date_add(date'2024-01-01', cast(n_chars % 60 as int)) as string) as publication_date",
        f"""case {doc} % 6 when 0 then 'NULL' when 1 then ' null ' when 2 then 'Null'
            else concat(' ', lang, '; ', source, ' ') end as keywords""",
        f"case when {doc} % 4 <> 3 then concat('https://example.org/', doc_id, '.pdf') end as pdf_url",
        "cast(null as string) as pdf_s3_path",
        f"array({_PROVIDERS})[(cast(substr(source, 4) as int) + {edition}) % 5] as source",
        "cast(null as string) as ingestion_timestamp",
    )
    return raw.withColumn("id", paper_id(F.col("title"), F.col("authors"), F.col("publication_date")))


def papers(spark: SparkSession, sf_dir: str, edition: int = 0) -> DataFrame:
    """The records with typed columns, before cleaning; ``doc_id`` stays beside them."""
    return to_papers(raw_papers(spark, sf_dir, edition), keep=["doc_id"])


def refined(spark: SparkSession, sf_dir: str, edition: int = 0) -> DataFrame:
    return add_partition_columns(refine(papers(spark, sf_dir, edition), SETTINGS))


def _one_per_id(df: DataFrame, stamp: str) -> DataFrame:
    best = best_per_key(df, SETTINGS.sources, ties=[F.col("doc_id")])
    return best.withColumn("ingestion_timestamp", F.lit(stamp).cast("timestamp"))


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State before the upsert: the earlier edition from the enabled sources."""
    enabled = [s.name for s in SETTINGS.enabled_sources]
    return _one_per_id(refined(spark, sf_dir, 1).filter(F.col("source").isin(enabled)), MASTER_STAMP)


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch to merge: the current edition of all sources."""
    return _one_per_id(refined(spark, sf_dir, 0), STAGING_STAMP)
