from __future__ import annotations

import numpy as np
import pytest

from paperlake.llm import whitening
from tests.llm.fixtures import with_clashes


def covariance(x: np.ndarray) -> np.ndarray:
    c = x - x.mean(0)
    return c.T @ c / len(x)


def check(rows, vectors: dict[int, list[float]], repeats: int = 1) -> None:
    """Against numpy's decomposition of the whole covariance; ids of ``vectors`` are the usable ones."""
    ids = sorted(vectors)
    x = np.floor(1024 * np.array([vectors[i] for i in ids])).astype(np.int64) + 100_000
    every = np.repeat(x, repeats, axis=0)
    n, sums = len(every), every.sum(0)
    values, found = np.linalg.eigh(covariance(every.astype(float)))
    values, found = values[::-1], found[:, ::-1]
    used = int((values[:8] > 1e-10 * values.sum()).sum())
    got: dict[tuple[int, int], list] = {}
    for r in rows:
        got.setdefault((r["vec_id"], r["component"]), []).append(r)
    assert set(got) == {(i, k) for i in ids for k in range(1, used + 1)}
    assert all(len(v) == repeats for v in got.values())
    for k in range(used):
        expected = (every[::repeats] - sums / n) @ found[:, k] / np.sqrt(values[k])
        ours = np.array([got[i, k + 1][0]["whitened"] for i in ids])
        assert min(np.abs(ours - expected).max(), np.abs(ours + expected).max()) < 1e-8
    for at, i in enumerate(ids):
        exact = sum((n * int(v) - int(s)) ** 2 for v, s in zip(x[at], sums))
        for k in range(used):
            for r in got[i, k + 1]:
                assert (r["n"], r["deviation"]) == (n, exact)
                assert abs(r["explained"] / (values[k] / values.sum()) - 1) < 1e-9
                assert r["identity_error"] < 1e-9


def table(spark, rows, parts: int = 3):
    return with_clashes(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).repartition(parts)


def test_whitening_is_numpys(spark):
    rng = np.random.default_rng(3)
    base = (rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12)) + 50).astype(np.float32)
    vectors = {i: v.tolist() for i, v in enumerate(base)}
    odd = [[np.nan] * 12, [float("inf")] * 12, [1.0, None] + [0.0] * 10, None, [], [1.0, 2.0], [1e20] * 12]
    rows = [*vectors.items(), *((1000 + i, v) for i, v in enumerate(odd))]
    check(whitening.whiten(table(spark, rows, 20), "vec_id", "embedding").collect(), vectors)


def test_repeats_and_low_rank(spark):
    rng = np.random.default_rng(4)
    vectors = {i: [float(a), float(b), float(a + b), 7.0] for i, (a, b) in enumerate(rng.integers(-5, 5, (40, 2)))}
    rows = [r for r in vectors.items() for _ in range(3)]
    check(whitening.whiten(table(spark, rows), "vec_id", "embedding").collect(), vectors, repeats=3)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(None, None)]])
def test_nothing_varies(spark, rows):
    assert whitening.whiten(table(spark, rows), "vec_id", "embedding").collect() == []


def test_large_deviations_are_exact_or_null():
    sums = (10**15 + 3, -(10**14))
    centre = whitening.Centre(10**6, sums)
    x = np.array([[10**9, -(10**8)], [10**9 + 2**31, -(10**8)], [2**42, 5]])
    exact = [sum((10**6 * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    assert centre.deviations(x) == [v if v < 2**63 else None for v in exact]


@pytest.mark.parametrize("kind", ["random", "tied", "repeated", "spread"])
def test_rank_one_changes_keep_an_exact_spectrum(kind):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(60, 9))
    if kind == "tied":
        x = np.round(x)
    elif kind == "repeated":
        x[:, 4:], x[20:] = 0, x[0]
    elif kind == "spread":
        x *= 10.0 ** np.arange(9)
    spectrum = whitening.Spectrum(9)
    for row in x:
        spectrum.add(row)
    whole = x.T @ x
    largest = spectrum.vals[-1]
    assert np.abs(spectrum.vals - np.linalg.eigvalsh(whole)).max() < 1e-13 * largest
    assert np.abs(spectrum.vecs.T @ spectrum.vecs - np.eye(9)).max() < 1e-12
    assert np.abs(spectrum.vecs * spectrum.vals @ spectrum.vecs.T - whole).max() < 1e-13 * largest


def test_secular_roots_lie_between_the_poles():
    rng = np.random.default_rng(8)
    d = np.sort(rng.uniform(0, 9, 30))
    z = rng.normal(size=30) * 10.0 ** rng.integers(-5, 3, 30)
    roots, between = whitening.secular_roots(d, z)
    below = np.tri(30, dtype=bool).T
    assert (between[below] < 0).all() and (between[~below] > 0).all() and roots[-1] <= d[-1] + z @ z
    terms = (z * z)[:, None] / between
    assert (np.abs(1 + terms.sum(0)) <= 1e-12 * (1 + np.abs(terms).sum(0))).all()


def test_registered_query_has_all_components(spark):
    from paperlake.llm import queries

    rows = queries.op12_secular_whitening(spark, "/root/testdata/sf0.001").collect()
    table_ = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    check(rows, {r["vec_id"]: r["embedding"] for r in table_})
