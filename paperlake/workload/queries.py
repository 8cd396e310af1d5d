"""One registered query per operator. Each reads whole tables below ``sf_dir``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperlake import schema
from paperlake.functions.identity import paper_id, pdf_object_path
from paperlake.functions.sql import register_functions
from paperlake.functions.text import clean_text, doi_is_valid, embedding_text
from paperlake.functions.vectors import cosine, l2_normalize
from paperlake.operators import embed, merge, quality, refine, search
from paperlake.operators.dedup import best_per_key
from paperlake.plans import stages, tables
from paperlake.session import materialize, scratch_path
from paperlake.sources import records
from paperlake.streaming.landing import ingest_new_files
from paperlake.workload import relations as r

Query = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register under the function's name; a trailing underscore only avoids a clash."""
    _REGISTRY[function.__name__.removesuffix("_")] = function
    return function


def registered() -> dict[str, Query]:
    return dict(_REGISTRY)


def _stamped(df: DataFrame) -> DataFrame:
    """The stamp as text, so that results do not depend on the session's time zone."""
    return df.withColumn(
        "ingestion_timestamp", F.date_format("ingestion_timestamp", "yyyy-MM-dd HH:mm:ss")
    )


# --- Scans and sinks ---------------------------------------------------------


@query
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = "doc_id bigint, text string, lang string, source string, doi string, n_chars bigint"
    columns = records.T.StructType.fromDDL(declared)
    return records.read_records(spark, f"{sf_dir}/documents.parquet", "parquet", columns)


def _landed(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    path = scratch_path(spark, f"landed-{fmt}")
    records.write_records(r.raw_papers(spark, sf_dir), path, r.AS_OF, fmt)
    return records.to_papers(records.read_records(spark, path, fmt)).drop("ingestion_timestamp")


@query
def scan_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, sf_dir, "json")


@query
def scan_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, sf_dir, "parquet")


@query
def scan_typed_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder that three writers filled: text, real dates and times, and columns that are all null."""
    path = scratch_path(spark, "landed-typed")
    raw = r.raw_papers(spark, sf_dir)
    third = F.pmod("doc_id", F.lit(3))
    typed = {
        "publication_date": F.col("publication_date").cast("date"),
        "ingestion_timestamp": F.lit(r.MASTER_STAMP).cast("timestamp"),
    }
    placeholders = {"pdf_s3_path": F.lit(None).cast("int"), "ingestion_timestamp": F.lit(None).cast("int")}
    records.write_records(raw.filter(third == 0), path, r.AS_OF)
    raw.filter(third == 1).drop("doc_id").withColumns(typed).write.parquet(f"{path}/typed")
    raw.filter(third == 2).drop("doc_id").withColumns(placeholders).write.parquet(f"{path}/placeholders")
    return _stamped(records.to_papers(records.read_records(spark, path)))


def _records(df: DataFrame) -> DataFrame:
    return refine.to_records(df.drop("doc_id"), F.lit(r.STAGING_STAMP).cast("timestamp"))


def _raw_table(spark: SparkSession, path: str) -> DataFrame:
    stored = spark.read.schema(schema.raw_table_schema()).parquet(path)
    return _stamped(stored).drop("record_hash", "landed_at")


@query
def raw_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "raw-table")
    first, second = (_records(r.refined(spark, sf_dir, edition)) for edition in (0, 1))
    tables.append_new_records(spark, first, path)
    tables.append_new_records(spark, first.unionByName(second), path)
    return _raw_table(spark, path)


@query
def landing_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = replace(r.SETTINGS, root=scratch_path(spark, "stream-lake"))
    source = settings.source("pubmed")
    stamp = F.lit(r.STAGING_STAMP).cast("timestamp")
    for edition in (0, 1):
        raw = r.raw_papers(spark, sf_dir, edition)
        records.write_records(raw, settings.landing_path(source.name), r.AS_OF, source.format)
        ingest_new_files(spark, settings, source, f"{settings.root}/checkpoint", stamp)
    return _raw_table(spark, settings.raw_table_path(source.name))


def _landed_on(spark: SparkSession, sf_dir: str, settings, edition: int, day: dt.date) -> None:
    """An edition as all sources land it on a day, with that day's stamp and PDF paths."""
    raw = r.raw_papers(spark, sf_dir, edition).drop("doc_id")
    for source in settings.sources:
        prepared = records.prepare_records(
            raw.filter(F.col("source") == source.name), r.BUCKET, day, F.lit(str(day)).cast("timestamp")
        )
        records.write_records(prepared, settings.landing_path(source.name), day, source.format)


@query
def raw_refetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records fetched on three days: each is one raw row, of the day it came first."""
    settings = replace(r.SETTINGS, root=scratch_path(spark, "refetch-lake"))
    stamp = F.lit(r.STAGING_STAMP).cast("timestamp")
    for back in (2, 1, 0):
        _landed_on(spark, sf_dir, settings, 0, r.AS_OF - dt.timedelta(back))
        stages.refine_sources(spark, settings, stamp)
    tables_ = [
        spark.read.schema(schema.raw_table_schema()).parquet(settings.raw_table_path(s.name))
        for s in settings.enabled_sources
    ]
    stored = records.union_papers(tables_).drop("ingestion_timestamp")
    return stored.withColumn("landed_at", F.date_format("landed_at", "yyyy-MM-dd"))


@query
def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two editions landed on two days and refined in one batch: the best source's latest landing per id."""
    settings = replace(r.SETTINGS, root=scratch_path(spark, "version-lake"), lookback_days=60)
    for edition, back in ((1, 1), (0, 0)):
        _landed_on(spark, sf_dir, settings, edition, r.AS_OF - dt.timedelta(back))
    stages.refine_stage(spark, settings, r.AS_OF)
    stored = spark.read.schema(schema.master_schema()).parquet(settings.master_path)
    return stored.drop("ingestion_timestamp")


@query
def enabled_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [s.name for s in r.SETTINGS.enabled_sources]
    return r.papers(spark, sf_dir).filter(F.col("source").isin(names)).select("doc_id", "id", "source")


@query
def field_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = {"doc_id": "id", "text": "full_text", "lang": "authors", "source": "journal"}
    return records.map_fields(r.table(spark, sf_dir, "documents"), mapping, "arxiv")


# --- Projections and filters -------------------------------------------------


@query
def paper_id_(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = r.table(spark, sf_dir, "documents")
    hashed = paper_id(F.col("text"), F.col("lang"), F.col("source"))
    return docs.select("doc_id", hashed.alias("id"))


@query
def clean_text_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.papers(spark, sf_dir).select(
        "doc_id", *[clean_text(F.col(c)).alias(c) for c in schema.CLEANED_FIELDS]
    )


@query
def title_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    papers = refine.keep_titled(r.papers(spark, sf_dir), r.SETTINGS.min_title_length)
    return papers.select("doc_id", "title")


@query
def truncate_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refine.truncate_long_text(r.papers(spark, sf_dir), 200, 1000).select("doc_id", "abstract", "full_text")


@query
def doi_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.papers(spark, sf_dir).select("doc_id", "doi", doi_is_valid(F.col("doi")).alias("doi_valid"))


@query
def partition_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = refine.add_partition_columns(r.papers(spark, sf_dir))
    return dated.select("doc_id", "publication_date", *schema.PARTITION_COLUMNS)


@query
def refine_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.refined(spark, sf_dir).drop("pdf_s3_path", "ingestion_timestamp")


@query
def refine_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same chain as a SQL user writes it, with the session's functions over a view."""
    register_functions(spark)
    r.papers(spark, sf_dir).createOrReplaceTempView("found_papers")
    limits = r.SETTINGS
    return spark.sql(
        f"""
        with cleaned as (
          select doc_id, id, doi, clean_text(title) as title, clean_text(authors) as authors,
            clean_text(abstract) as abstract, clean_text(full_text) as full_text, journal, publication_date,
            clean_text(keywords) as keywords, pdf_url, source
          from found_papers)
        select doc_id, id, doi, title, authors, truncated(abstract, {limits.max_abstract_length}) as abstract,
          truncated(full_text, {limits.max_full_text_length}) as full_text, journal, publication_date, keywords,
          pdf_url, source, doi_is_valid(doi) as doi_valid, year(publication_date) as year,
          month(publication_date) as month, day(publication_date) as day
        from cleaned where long_enough(title, {limits.min_title_length})"""
    )


@query
def malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines of which every third document's is cut off: what the report counts per source."""
    settings = replace(r.SETTINGS, root=scratch_path(spark, "malformed-lake"))
    source = settings.source("acm")
    raw = r.raw_papers(spark, sf_dir)
    line = F.to_json(F.struct(*schema.raw_schema().names))
    cut = F.when(F.col("doc_id") % 3 == 0, F.expr("substring(line, 1, 20)")).otherwise(F.col("line"))
    landed = raw.select("doc_id", line.alias("line")).select(cut.alias("value"))
    # Lines as they are, in files that are named as JSON.
    as_they_are = {"extension": "json", "quote": "", "sep": "\x01", "emptyValue": ""}
    landed.write.options(**as_they_are).csv(f"{settings.landing_path(source.name)}/cut")
    report = stages.refine_sources(spark, settings, F.lit(r.STAGING_STAMP).cast("timestamp"))
    return stages.status_checks(spark, report).filter("check_name = 'source_acm'").drop("detail")


@query
def lookback_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = refine.recent(r.refined(spark, sf_dir), r.AS_OF, r.SETTINGS.lookback_days)
    return recent.select("doc_id", "id", "publication_date")


@query
def pdf_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = pdf_object_path(r.BUCKET, F.col("source"), F.lit(r.AS_OF), F.col("id"), F.col("pdf_url"))
    return r.papers(spark, sf_dir).select("doc_id", path.alias("pdf_s3_path"))


# --- Union, dedup, upsert ----------------------------------------------------


# Which table stands for which source, and its columns' canonical names.
SOURCE_TABLES = {
    "arxiv": ("documents", {"doc_id": "id", "text": "full_text", "lang": "authors", "source": "journal"}),
    "pubmed": ("pages", {"page_id": "id", "url": "pdf_url", "html": "full_text"}),
    "ieee": ("benchmark", {"item_id": "id", "text": "full_text"}),
    "acm": ("conversations", {"conv_id": "id", "turn": "keywords", "role": "authors", "text": "full_text"}),
}


@query
def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources with different columns, united by name and brought to the raw columns."""
    frames = [
        r.table(spark, sf_dir, name).select(
            *[F.col(given).cast("string").alias(wanted) for given, wanted in mapping.items()],
            F.lit(source).alias("source"),
        )
        for source, (name, mapping) in SOURCE_TABLES.items()
    ]
    return records.conform(records.union_papers(frames))


@query
def dedup_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = best_per_key(r.refined(spark, sf_dir), r.SETTINGS.sources, ties=[F.col("doc_id")])
    return best.select("id", "doc_id", "source", "title", "publication_date")


@query
def merge_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamped(merge.merge(r.master(spark, sf_dir), r.staging(spark, sf_dir)))


@query
def merge_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamped(merge.matched_rows(r.master(spark, sf_dir), r.staging(spark, sf_dir)))


@query
def merge_inserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamped(merge.inserted_rows(r.master(spark, sf_dir), r.staging(spark, sf_dir)))


@query
def master_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "master")
    tables.upsert_by_date(spark, r.master(spark, sf_dir), path)
    tables.upsert_by_date(spark, r.staging(spark, sf_dir), path)
    return _stamped(spark.read.schema(schema.master_schema()).parquet(path))


@query
def touched_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = refine.recent(r.refined(spark, sf_dir), r.AS_OF, r.SETTINGS.lookback_days)
    kept = tables.only_touched(r.master(spark, sf_dir), recent)
    return kept.select("id", *schema.PARTITION_COLUMNS)


# --- Counts and checks -------------------------------------------------------


@query
def source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.source_counts(r.refined(spark, sf_dir))


@query
def master_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = merge.merge(r.master(spark, sf_dir), r.staging(spark, sf_dir))
    return merged.agg(F.count("*").alias("n_rows"))


@query
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(r.papers(spark, sf_dir), r.SETTINGS.min_title_length)


@query
def stale_doi_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.stale_doi_flags(merge.merge(r.master(spark, sf_dir), r.staging(spark, sf_dir)))


@query
def output_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks over a lake whose master was upserted after its points were stored, and in which one source failed."""
    path = scratch_path(spark, "points")
    tables.replace_all(embed.build_points(r.master(spark, sf_dir), embed.hashing_encoder(r.DIM)), path)
    points = spark.read.schema(schema.points_schema()).parquet(path)
    merged = materialize(merge.merge(r.master(spark, sf_dir), r.staging(spark, sf_dir)).select("id"), "master")
    counts = {c["source"]: c["n_rows"] for c in quality.source_counts(r.papers(spark, sf_dir)).collect()}
    report = [
        stages.SourceStatus(s.name, "failed" if s.name == "ieee" else "loaded", "", counts.get(s.name, 0))
        for s in r.SETTINGS.enabled_sources
    ]
    checks = [stages.status_checks(spark, report), stages.table_checks(r.papers(spark, sf_dir), merged, points)]
    return records.union_papers(checks).select("check_name", "passed", "rows_read")


@query
def full_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on two days into a new lake; the master table they leave.

    The second day brings another edition and reads only that.
    """
    settings = replace(r.SETTINGS, root=scratch_path(spark, "lake"), lookback_days=30)
    for edition, back in ((1, 1), (0, 0)):
        raw = r.raw_papers(spark, sf_dir, edition).drop("doc_id")
        landed = {s.name: raw.filter(F.col("source") == s.name) for s in settings.sources}
        checks = stages.run_all(spark, settings, landed, r.BUCKET, r.AS_OF - dt.timedelta(back), r.AS_OF)
        if checks.filter(~F.col("passed")).count():
            raise RuntimeError("an output check failed")
    stored = spark.read.schema(schema.master_schema()).parquet(settings.master_path)
    return stored.drop("ingestion_timestamp")


# --- Embedding and search ----------------------------------------------------


@query
def embed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = embedding_text(*map(F.col, ("title", "abstract", "full_text")))
    return r.refined(spark, sf_dir).select("doc_id", text.alias("text"))


@query
def embed_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed.embedding_input(r.staging(spark, sf_dir)).select("payload.*", "text")


def _document_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = r.table(spark, sf_dir, "documents").select("doc_id", "text")
    return embed.embed(docs, "text", embed.hashing_encoder(r.DIM))


@query
def hash_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _document_vectors(spark, sf_dir).select("doc_id", F.posexplode("vector").alias("bucket", "n"))
    return counts.filter("n > 0").select("doc_id", "bucket", F.col("n").cast("bigint").alias("n"))


@query
def embed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = _document_vectors(spark, sf_dir).select("doc_id", l2_normalize(F.col("vector")).alias("v"))
    weights = unit.select("doc_id", F.posexplode("v").alias("bucket", "weight"))
    return weights.filter("weight > 0").withColumn("weight", F.round("weight", 6))


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = r.table(spark, sf_dir, "embeddings")
    return stored.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")


@query
def l2_normalize_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit vectors of the stored ones scaled by 0 to 3; scale 0 gives zero vectors."""
    scaled = F.transform("vector", lambda x: x.cast("double") * (F.col("id") % 4))
    unit = _vectors(spark, sf_dir).select("id", l2_normalize(scaled).alias("v"))
    values = unit.select(F.col("id").alias("vec_id"), F.posexplode("v").alias("pos", "value"))
    return values.withColumn("value", F.round("value", 6) + F.lit(0.0))


def _label_centroids(vectors: DataFrame) -> DataFrame:
    """One query per label: the mean of its vectors, aggregated in the JVM before the shuffle."""
    mean = Summarizer.mean(array_to_vector("vector"))
    return vectors.groupBy(F.col("label").alias("query_id")).agg(vector_to_array(mean).alias("vector"))


@query
def vector_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity of each vector to the centroid of its own label."""
    vectors = _vectors(spark, sf_dir)
    centers = _label_centroids(vectors).toDF("label", "center")
    score = F.round(cosine(F.col("vector"), F.col("center")), 6) + F.lit(0.0)
    return vectors.join(centers, "label").select(F.col("id").alias("vec_id"), "label", score.alias("score"))


@query
def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _vectors(spark, sf_dir)
    return search.top_k(vectors, _label_centroids(vectors), r.K)


@query
def vector_topk_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The form for query sets of any size, on the same queries."""
    vectors = _vectors(spark, sf_dir)
    return search.top_k_blocks(vectors, _label_centroids(vectors), r.K, vector_blocks=8, query_blocks=2)


def _benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = r.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return embed.embed(items, "text", embed.hashing_encoder(r.DIM))


@query
def paper_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The papers nearest to each benchmark text."""
    points = embed.build_points(r.staging(spark, sf_dir), embed.hashing_encoder(r.DIM))
    return search.top_k(points, _benchmark_queries(spark, sf_dir), r.K)


@query
def vector_topk_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same search among recent papers of the enabled sources only."""
    enabled = [s.name for s in r.SETTINGS.enabled_sources]
    wanted = refine.recent(r.staging(spark, sf_dir), r.AS_OF, 30).filter(F.col("source").isin(enabled))
    points = embed.build_points(wanted, embed.hashing_encoder(r.DIM))
    return search.top_k(points, _benchmark_queries(spark, sf_dir), r.K)


def _point_cells(points: DataFrame) -> DataFrame:
    values = points.select("id", "payload.doi", "payload.source", F.posexplode("vector").alias("bucket", "n"))
    return values.filter("n > 0").withColumn("n", F.col("n").cast("bigint"))


@query
def vector_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of the master relation after the staged ones are written over them."""
    encoder = embed.hashing_encoder(r.DIM)
    existing = embed.build_points(r.master(spark, sf_dir), encoder)
    return _point_cells(embed.upsert_points(existing, r.staging(spark, sf_dir), encoder))


@query
def vector_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored vector table whose recent date partitions were encoded again."""
    path, encoder = scratch_path(spark, "vectors"), embed.hashing_encoder(r.DIM)
    tables.replace_all(embed.build_points(r.master(spark, sf_dir), encoder), path)
    again = refine.recent(r.staging(spark, sf_dir), r.AS_OF, 30)
    tables.replace_dates(embed.build_points(again, encoder), path)
    return _point_cells(spark.read.schema(schema.points_schema()).parquet(path))
