"""One registered query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperlake.llm import (
    decontaminate,
    language_id,
    lm,
    merkle,
    mixing,
    neighbours,
    ngram_join,
    packing,
    secrets,
    substrings,
    warc,
    whitening,
    wrappers,
)

Query = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    _REGISTRY[function.__name__] = function
    return function


def registered() -> dict[str, Query]:
    return dict(_REGISTRY)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"))


@query
def op5_block_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op8_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(_table(spark, sf_dir, "documents"))


@query
def op7_entropy_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*secrets.BASE_KINDS))
    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    found = secrets.find_secrets(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *map(count, secrets.BASE_KINDS),
        F.sha2(secrets.spans_as_text(base), 256).alias("base_sha256"),
        secrets.spans_as_text(spans).alias("spans"),
    )


@query
def op9_block_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return neighbours.nearest_neighbours(vectors, vectors.filter("vec_id % 100 = 0"), "vec_id", "embedding")


@query
def op10_byte_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return language_id.identify(documents, language_id.fit(documents))


@query
def op4_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.deduplicated_pages(_table(spark, sf_dir, "pages"))


@query
def op6_poisson_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


@query
def op3_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract_main_text(_table(spark, sf_dir, "pages"))


@query
def op2_latent_retrieval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@query
def op11_open_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


@query
def op12_secular_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


@query
def op13_interval_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = merkle.verified(merkle.manifest(_table(spark, sf_dir, "documents")))
    return checked.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
