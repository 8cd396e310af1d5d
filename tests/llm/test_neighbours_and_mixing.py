from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperlake.llm import mixing, neighbours
from tests.llm.fixtures import DOCUMENT, documents, with_clashes


def brute_nearest(rows, k):
    usable = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v]
    usable = [(i, v) for i, v in usable if np.isfinite(v).all() and v.any()]
    out = []
    for q, x in usable:
        if q % 10 == 0:
            near = sorted((float(np.sqrt(((x - v) ** 2).sum())), i) for i, v in usable if i != q and len(v) == len(x))
            out += [(q, r + 1, i, round(d, 9)) for r, (d, i) in enumerate(near[:k])]
    return sorted(out)


def vectors(seed=0, n=120, dim=7):
    rng = np.random.default_rng(seed)
    points = rng.normal(size=(n, dim)).round(2)
    points[20:60] = points[0]  # a third are copies of one
    points[60:70] *= 1e6
    points[70:75] *= 1e-6
    rows = [(int(i), p.tolist()) for i, p in enumerate(points)]
    rows += [(200, None), (210, [0.0] * dim), (220, [float("nan")] * dim), (230, [float("inf")] + [1.0] * (dim - 1))]
    rows += [(240, [None] + [1.0] * (dim - 1)), (None, points[1].tolist()), (250, [1.0, 2.0]), (251, [1.0, 2.5]), (260, [])]
    return rows


def test_a_common_offset_does_not_loosen_the_bounds(spark):
    """A large share in one component, as many embeddings have, leaves as few pairs as without."""
    rng = np.random.default_rng(2)
    points = rng.normal(size=(900, 64))
    left = {}
    for shift in (0.0, 1000.0):
        moved = points.copy()
        moved[:, 0] += shift
        rows = [(i, v.tolist()) for i, v in enumerate(moved)]
        usable = neighbours.usable_vectors(spark.createDataFrame(rows, "i long, v array<double>"), "i", "v")
        left[shift] = neighbours.survivors(usable, usable.filter("id % 30 = 0"), 10).count()
    assert 300 <= left[1000.0] < 1.1 * left[0.0] < 2000


@pytest.mark.parametrize("k,block_rows", [(3, 1000), (10, 16), (500, 16)])
def test_nearest_equal_brute_force(spark, k, block_rows):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    df = df.withColumns({c: F.lit(-7) for c in ("id", "rank", "score", "dim", "block", "copy")})
    found = neighbours.nearest_neighbours(df, df.filter("vec_id % 10 = 0"), "vec_id", "embedding", k, block_rows)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in found.collect())
    assert got == brute_nearest(rows, k)


def test_bounds_hold_and_prune(spark):
    rng = np.random.default_rng(1)
    points = np.r_[rng.normal(size=(150, 16)), rng.normal(loc=30, size=(150, 16))]
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    usable = neighbours.usable_vectors(df, "vec_id", "embedding")
    left = neighbours.survivors(usable, usable.filter("id % 10 = 0"), 5, 64).groupBy("query_id").count().collect()
    assert all(5 <= r["count"] < 60 for r in left) and len(left) == 30


def test_repeated_and_empty_vectors(spark):
    kind = "vec_id long, embedding array<double>"
    df = spark.createDataFrame([(0, [1.0]), (0, [1.0]), (1, [2.0]), (1, [2.0]), (2, [2.0])], kind)
    got = neighbours.nearest_neighbours(df, df.filter("vec_id = 0"), "vec_id", "embedding", 10).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 1.0), (0, 2, 2, 1.0)]
    empty = spark.createDataFrame([], kind)
    assert neighbours.nearest_neighbours(empty, empty, "vec_id", "embedding").collect() == []


@pytest.mark.parametrize("times", [2, 3, 12])
def test_repeated_rows_take_no_places(spark, times):
    rows = [(i, v) for i, v in vectors(n=150) if i is not None]
    rows += [(300, [0.5] * 7), (300, [0.75] * 7), (301, rows[0][1])]
    df = spark.createDataFrame(rows * times, "vec_id long, embedding array<double>").repartition(4)
    asked = df.filter("vec_id % 10 = 0 and vec_id <> 300")
    found = neighbours.nearest_neighbours(df, asked, "vec_id", "embedding", 10, 64).collect()
    got = sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in found)
    assert got == [r for r in brute_nearest(rows, 10) if r[0] != 300]


def test_different_vectors_of_one_id_at_one_distance(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 2.0]), (1, [1.0, -2.0]), (2, [9.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest_neighbours(df, df.filter("vec_id = 0"), "vec_id", "embedding", 2).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 1, 2.0), (0, 2, 1, 2.0)]


def many(spark, n=6000):
    rows = spark.range(n).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"), F.lit("en").alias("lang"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 30 == 1, None).otherwise("cold").alias("source"),
        F.lit(1).cast("long").alias("n_chars"),
    )
    return rows.repartition(5)


def test_sources_reach_their_weights(spark):
    df = many(spark)
    out = mixing.mix_sources(df, {"hot": 1.0, "cold": 3.0}, total=8000)
    n = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
    assert set(n) == {"hot", "cold"}
    assert abs(n["hot"] - 2000) < 200 and abs(n["cold"] - 6000) < 400
    again = mixing.mix_sources(df.repartition(2), {"hot": 1.0, "cold": 3.0}, total=8000)
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, again.collect()), key=str)


def test_copies_follow_a_poisson_distribution(spark):
    df = many(spark).withColumn("source", F.lit("one"))
    copies = mixing.mix_sources(df, {"one": 1.0}, total=9000).groupBy("doc_id").agg(F.max("copy").alias("n"), F.count("*").alias("m"))
    assert copies.filter("n <> m").isEmpty()
    n = {r["n"]: r["count"] for r in copies.groupBy("n").count().collect()}
    n[0] = 6000 - sum(n.values())
    for k in range(4):
        wanted = 6000 * np.exp(-1.5) * 1.5**k / np.prod(range(1, k + 1), initial=1.0)
        assert abs(n[k] - wanted) < 6 * np.sqrt(wanted)


@pytest.mark.parametrize("rate", [0.0, 1e-9, 0.3, 1.0, 40.0, 2000.0])
def test_steps_are_the_distribution(spark, rate):
    (steps,) = spark.range(1).select(mixing._poisson_steps(F.lit(rate)).alias("s")).first()
    if rate == 0:
        assert steps == [2.0]
        return
    k = np.arange(len(steps))
    logs = np.r_[0.0, np.cumsum(np.log(np.arange(1, len(steps))))]
    wanted = np.cumsum(np.exp(k * np.log(rate) - rate - logs))
    assert np.allclose(steps, wanted, atol=1e-9) and steps[-1] == pytest.approx(1.0, abs=1e-9)


def test_the_order_is_global(spark):
    out = mixing.mix_sources(many(spark, 2000))
    parts = out.withColumn("p", F.spark_partition_id()).groupBy("p").agg(F.min("doc_id"), F.max("doc_id")).collect()
    assert len(parts) == 4 and all(low < 100 and high > 1900 for _, low, high in parts)


def test_awkward_mixtures(spark):
    df = documents(spark)
    out = mixing.mix_sources(with_clashes(df))
    wanted = [c for c in with_clashes(df).columns if c not in ("copy", "shuffle_key")] + ["copy", "shuffle_key"]
    assert out.columns == wanted and {r["_u"] for r in out.select("_u").collect()} == {-7}
    assert out.filter("source is null").count() > 0
    assert mixing.mix_sources(df, {"unknown": 1.0}).isEmpty() and mixing.mix_sources(df, {}).isEmpty()
    assert mixing.mix_sources(spark.createDataFrame([], DOCUMENT)).isEmpty()
