"""Exact nearest neighbours by Euclidean distance, as a join of blocks of a matrix.

Vectors are taken from their mean, which changes no distance but keeps what all have in
common out of the codes, and rounded to 8 bits with a scale of their own; the length of
what the rounding lost is kept. A task multiplies one block of queries with one block of
candidates as whole numbers; the distance of the rounded vectors differs from the
true one by at most both lengths lost. Per query and block a heap of the k smallest
upper bounds says how near the k-th neighbour must be, and only candidates whose
lower bound reaches that survive. After the same test over all blocks, the survivors
are computed from the original vectors in double precision and merged by heaps.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 10
# Vectors of one block side: with 1,000 components 8 MB as bytes, and the scores of a
# pair of blocks are worked out for a few queries at a time.
BLOCK_ROWS = 8192
_SCORE_CELLS = 1 << 22

_CODED = "id long, dim int, block int, code binary, scale double, norm double, lost double"
_BOUNDED = "query_id long, vec_id long, low double, high double"


def usable_vectors(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Different ``id, vector, dim`` in double; null, zero and non-finite vectors and null ids are left out.

    Rows are made different before anything ranks them, so that copies take no places.
    """
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    limit = float("inf")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    some = F.exists("vector", lambda x: x != 0)
    rows = rows.filter("id is not null and vector is not null").filter(finite & some).distinct()
    return rows.withColumn("dim", F.size("vector"))


def _means(vectors: DataFrame) -> dict[int, np.ndarray]:
    """The mean vector per dimension; it need not be exact, only the same for all."""
    mean = vector_to_array(Summarizer.mean(array_to_vector("vector")))
    return {r["dim"]: np.nan_to_num(np.array(r["mean"]), posinf=0.0, neginf=0.0) for r in vectors.groupBy("dim").agg(mean.alias("mean")).collect()}


def _coded(vectors: DataFrame, blocks: int, means: dict[int, np.ndarray]) -> DataFrame:
    """8-bit codes, the rounded vector's squared length, and the length of the rounding error."""
    rows = vectors.select("id", "dim", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), "vector")

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, scales, norms, losts = [], [], [], []
            for value in batch.column("vector"):
                given = value.values.to_numpy(zero_copy_only=False)
                mean = means.get(len(given), 0.0)
                x = given - mean
                scale = np.abs(x).max() / 127
                rounded = np.rint(x / scale) if scale > 0 else np.zeros_like(x)
                codes.append(rounded.astype(np.int8).tobytes())
                scales.append(scale)
                norms.append(scale * scale * float(rounded @ rounded))
                # The subtraction rounds too, by half a unit in the last place of its result at most.
                lost = np.sqrt(((x - scale * rounded) ** 2).sum()) + 1e-15 * np.sqrt((x * x).sum())
                losts.append(float(lost))
            columns = [*(batch.column(c) for c in ("id", "dim", "block")), pa.array(codes, pa.binary())]
            columns += [pa.array(c, pa.float64()) for c in (scales, norms, losts)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "dim", "block", "code", "scale", "norm", "lost"])

    return rows.mapInArrow(code, _CODED)


def _matrix(table: pa.Table, dim: int) -> np.ndarray:
    """Codes as floats; sums of their products stay whole numbers that double holds exactly."""
    kind = np.float32 if dim * 127 * 127 < 2**24 else np.float64
    return np.frombuffer(b"".join(table.column("code").to_pylist()), np.int8).reshape(-1, dim).astype(kind)


def _tile(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """The candidates of one block pair that may be among a query's k nearest, with distance bounds."""
    found: list[tuple[np.ndarray, ...]] = []
    if queries.num_rows and candidates.num_rows:
        dim = queries.column("dim")[0].as_py()
        left, right = _matrix(queries, dim), _matrix(candidates, dim)
        ids, asked = candidates.column("id").to_numpy(), queries.column("id").to_numpy()
        scale, norm, lost = (candidates.column(c).to_numpy() for c in ("scale", "norm", "lost"))
        own = {c: queries.column(c).to_numpy() for c in ("scale", "norm", "lost")}
        step = max(1, _SCORE_CELLS // len(ids))
        for start in range(0, len(asked), step):
            part = slice(start, start + step)
            dots = (left[part] @ right.T).astype(np.float64) * own["scale"][part, None] * scale
            squares = own["norm"][part, None] + norm - 2 * dots
            # Rounding of these few operations, relative to the lengths involved.
            slack = 1e-12 * (own["norm"][part, None] + norm)
            error = own["lost"][part, None] + lost
            low = np.maximum(np.sqrt(np.maximum(squares - slack, 0)) - error, 0) * (1 - 1e-12)
            high = (np.sqrt(np.maximum(squares + slack, 0)) + error) * (1 + 1e-12)
            own_row = ids == asked[part, None]
            high[own_row] = low[own_row] = np.inf
            reach = np.full(len(high), np.inf)
            if len(ids) > k:
                reach = np.partition(high, k - 1, axis=1)[:, k - 1]
            query, candidate = np.nonzero((low <= reach[:, None]) & ~own_row)
            found.append((asked[part][query], ids[candidate], low[query, candidate], high[query, candidate]))
    columns = [np.concatenate(c) for c in zip(*found)] if found else [np.empty(0, t) for t in "qqdd"]
    return pa.table(dict(zip(("query_id", "vec_id", "low", "high"), map(pa.array, columns))))


def survivors(vectors: DataFrame, queries: DataFrame, k: int = K, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Different ``query_id, vec_id`` of everything that the bounds leave possible.

    Rows of ``vectors`` are different, as ``usable_vectors`` gives them.
    """
    # Of equal vectors only the k + 1 smallest ids can be among k neighbours: one may be the query itself.
    same = Window.partitionBy("vector").orderBy("id")
    few = vectors.withColumn("copy", F.row_number().over(same)).filter(F.col("copy") <= k + 1).drop("copy")
    n_candidates, n_queries = (max(1, -(-df.count() // block_rows)) for df in (vectors, queries))

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    means = _means(few)
    right = _coded(few, n_candidates, means).withColumnRenamed("block", "candidate_block")
    right = right.withColumn("query_block", every(n_queries))
    left = _coded(queries, n_queries, means).withColumnRenamed("block", "query_block")
    left = left.withColumn("candidate_block", every(n_candidates))
    keys = ["dim", "query_block", "candidate_block"]

    def tile(a: pa.Table, b: pa.Table) -> pa.Table:
        return _tile(a, b, k)

    bounded = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(tile, _BOUNDED)
    nearest = Window.partitionBy("query_id").orderBy("high", "vec_id")
    highest = bounded.withColumn("place", F.row_number().over(nearest)).filter(F.col("place") <= k)
    reach = highest.groupBy("query_id").agg(F.max("high").alias("reach"), F.count("*").alias("n"))
    possible = (F.col("low") <= F.col("reach")) | (F.col("n") < k)
    return bounded.join(reach, "query_id").filter(possible).select("query_id", "vec_id").distinct()


def _distances(pairs: DataFrame, vectors: DataFrame, queries: DataFrame) -> DataFrame:
    """The exact distance of each pair, components summed in order."""
    with_vector = pairs.join(vectors.select(F.col("id").alias("vec_id"), F.col("vector").alias("v")), "vec_id")
    both = with_vector.join(queries.select(F.col("id").alias("query_id"), F.col("vector").alias("q")), "query_id")
    gaps = F.zip_with("q", "v", lambda x, y: (x - y) * (x - y))
    return both.select("query_id", "vec_id", F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x)).alias("score"))


def nearest_neighbours(
    vectors: DataFrame, queries: DataFrame, key: str, vector: str, k: int = K, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows of ``vectors`` for each row of ``queries``.

    Both have a ``key`` and a ``vector`` column. Score is the Euclidean distance in
    double precision of the original vectors, nearest first, ties to the smaller id;
    all candidates if there are fewer than ``k``. A candidate with the query's id is
    its own row and is left out. Null, zero and non-finite vectors, and null ids, take
    no part; vectors of different length are not compared. Rows that repeat an id are
    one candidate for each different vector, and as queries the smallest vector counts.
    """
    usable = usable_vectors(vectors, key, vector)
    asked = usable_vectors(queries, key, vector).groupBy("id").agg(F.min("vector").alias("vector"))
    asked = asked.withColumn("dim", F.size("vector"))
    scored = _distances(survivors(usable, asked, k, block_rows), usable, asked)

    def merged(table: pa.Table) -> pa.Table:
        rows = zip(table.column("score").to_pylist(), table.column("vec_id").to_pylist())
        best = heapq.nsmallest(k, rows)
        query = table.column("query_id")[0].as_py()
        return pa.table(
            {
                "query_id": pa.array([query] * len(best), pa.int64()),
                "rank": pa.array(range(1, len(best) + 1), pa.int32()),
                "vec_id": pa.array([v for _, v in best], pa.int64()),
                "score": pa.array([s for s, _ in best], pa.float64()),
            }
        )

    return scored.groupBy("query_id").applyInArrow(merged, "query_id long, rank int, vec_id long, score double")
