from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperlake.operators import search
from tests.plans import plan_of


def brute_force(ids, vectors, query_ids, queries, k):
    def unit(m):
        n = np.linalg.norm(m, axis=1, keepdims=True)
        return np.divide(m, n, out=np.zeros_like(m), where=n > 0)

    scores = np.round(unit(vectors.astype(float)) @ unit(queries.astype(float)).T, 6) + 0.0
    out = []
    for column, query in enumerate(query_ids):
        order = sorted(range(len(ids)), key=lambda i: (-scores[i, column], ids[i]))[:k]
        out += [(query, ids[i], scores[i, column], rank + 1) for rank, i in enumerate(order)]
    return sorted(out)


def data(spark, n=400, dim=6, n_queries=9, text_ids=False, copies=130, seed=3):
    """Vectors of which a third are copies of one, and some are zero."""
    rng = np.random.default_rng(seed)
    vectors = rng.normal(size=(n, dim)).astype(np.float32)
    vectors[:copies] = vectors[0]
    vectors[n - 5 :] = 0
    queries = np.vstack([rng.normal(size=(n_queries - 2, dim)), vectors[0], np.zeros(dim)]).astype(np.float32)
    ids = [f"p{i:04d}" if text_ids else i for i in range(n)]
    kind = "string" if text_ids else "bigint"
    v = spark.createDataFrame([(i, x.tolist()) for i, x in zip(ids, vectors)], f"id {kind}, vector array<float>")
    q = spark.createDataFrame(
        [(i, x.tolist()) for i, x in enumerate(queries)], "query_id bigint, vector array<float>"
    )
    return v.repartition(5), q, ids, vectors, list(range(n_queries)), queries


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("text_ids", [False, True])
@pytest.mark.parametrize("k", [1, 10, 1000])
def test_top_k_equals_brute_force(spark, text_ids, k):
    v, q, *plain = data(spark, text_ids=text_ids)
    assert rows(search.top_k(v, q, k)) == brute_force(*plain, k)


@pytest.mark.parametrize("text_ids", [False, True])
@pytest.mark.parametrize("blocks", [(1, 1), (7, 3)])
def test_blocks_equal_brute_force(spark, text_ids, blocks):
    v, q, *plain = data(spark, n_queries=150, text_ids=text_ids)
    assert rows(search.top_k_blocks(v, q, 7, *blocks)) == brute_force(*plain, 7)


def test_equal_points_spread_over_blocks(spark):
    same = spark.createDataFrame([(1, [1.0, 0.0])] * 200, "id bigint, vector array<float>").repartition(4)
    q = spark.createDataFrame([(0, [1.0, 0.0])], "query_id bigint, vector array<float>")
    plan = plan_of(search.top_k_blocks(same, q, 3, 4, 1))
    assert "monotonically_increasing_id" in plan
    assert [r["id"] for r in search.top_k_blocks(same, q, 3, 4, 1).collect()] == [1, 1, 1]


def test_too_many_queries_are_refused(spark, monkeypatch):
    v, q, *_ = data(spark)
    monkeypatch.setattr(search, "MAX_SHIPPED_BYTES", 9 * 6 * 8 - 1)
    with pytest.raises(ValueError, match="top_k_blocks"):
        search.top_k(v, q, 3)


def test_ids_of_any_type_and_null_ids(spark):
    vectors = [(dt.date(2024, 1, d), [1.0, float(d)]) for d in (3, 1, 2)] + [(None, [1.0, 1.0])]
    v = spark.createDataFrame(vectors, "id date, vector array<double>")
    q = spark.createDataFrame([("a", [0.0, 1.0]), (None, [1.0, 0.0])], "query_id string, vector array<double>")
    for found in (search.top_k(v, q, 2), search.top_k_blocks(v, q, 2, 2, 2)):
        got = found.orderBy("rank").collect()
        assert [(r["query_id"], r["id"].day, r["rank"]) for r in got] == [("a", 3, 1), ("a", 2, 2)]


def test_no_queries_and_no_vectors(spark):
    v, q, *_ = data(spark, n=50, copies=10)
    assert rows(search.top_k(v, q.filter("false"), 3)) == []
    assert rows(search.top_k(v.filter("false"), q, 3)) == []


def test_null_vectors_are_left_out(spark):
    v, q, *plain = data(spark)
    nulls = v.limit(1).select(F.lit(-1).cast("bigint").alias("id"), F.lit(None).cast("array<float>").alias("vector"))
    assert rows(search.top_k(v.union(nulls), q, 4)) == brute_force(*plain, 4)


def test_search_reads_two_columns_and_makes_no_pairs(spark, folder):
    v, q, *_ = data(spark)
    v.withColumn("payload", F.lit("x")).write.parquet(f"{folder}/v")
    plan = plan_of(search.top_k(spark.read.parquet(f"{folder}/v"), q, 4))
    assert "ReadSchema: struct<id:bigint,vector:array<float>>" in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert plan.count("WindowGroupLimit") == 4
