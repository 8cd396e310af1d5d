"""The registered queries: against SQL where there is some, else against brute force on whole tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from paperlake.llm import oracle, queries
from tests.compare import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert differences(queries.registered()[name](spark, SF_DIR), con, oracle.oracle_sql()[name]) == []


def test_all_are_registered():
    numbers = {n.split("_")[0] for n in queries.registered()}
    assert numbers == {f"op{i}" for i in range(1, 14)}
    assert queries.registered().keys() | {"pipeline"} <= contract.queries().keys()


@pytest.mark.parametrize(
    "name,table,key",
    [
        ("op3_wrappers", "pages", "page_id"),
        ("op5_block_anchors", "documents", "doc_id"),
        ("op7_entropy_windows", "documents", "doc_id"),
        ("op8_backoff_automaton", "documents", "doc_id"),
        ("op10_byte_network", "documents", "doc_id"),
    ],
)
def test_a_row_per_row(spark, con, name, table, key):
    got = sorted(r[0] for r in queries.registered()[name](spark, SF_DIR).select(key).collect())
    assert got == [r[0] for r in con.sql(f"select {key} from {table} order by 1").fetchall()]


def test_every_contained_item_is_reported(spark, con):
    """Brute force: items that occur in a document letter by letter, but for case."""
    found = {(r["doc_id"], r["item_id"]) for r in queries.op2_latent_retrieval(spark, SF_DIR).collect()}
    exact = con.sql("select doc_id, item_id from documents d, benchmark b where contains(lower(d.text), lower(b.text))")
    assert set(exact.fetchall()) <= found


def test_pipeline_equals_its_stages_by_brute_force(spark, con):
    """Each stage's decisions, worked out on what the stage before kept."""
    from tests.llm.test_near_and_repeats import brute_groups
    from tests.llm.test_secrets import brute_base

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF_DIR), name)
        rows = docs.collect()
        now = {r["doc_id"]: r["text"] for r in rows}
        assert set(now) <= set(kept)
        if name == "language_id":
            assert all(any(c.isalpha() for c in t or "") for t in now.values())
            assert len(now) >= 0.99 * sum(any(c.isalpha() for c in t or "") for t in kept.values())
        elif name == "near_duplicates":
            assert set(now) == {c for _, _, c in brute_groups(list(kept.items()))}
        elif name == "decontamination":
            items = [t for (t,) in con.sql("select lower(text) from benchmark").fetchall()]
            assert set(now) == {i for i, t in kept.items() if not any(x in t.lower() for x in items)}
        elif name == "secret_scan":
            assert set(now) == set(kept) and not any(brute_base(t) for t in now.values())
            assert all(now[i] == t for i, t in kept.items() if not brute_base(t) and "[REDACTED]" not in now[i])
        if name != "mixture":
            assert docs.columns == columns and len(rows) == len(now)
        kept = now
    whole = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, rows))
