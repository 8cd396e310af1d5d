"""Exact cosine top-k search.

No pair of query and vector becomes a row. Each task scores its vectors against
the queries with a matrix product, keeps its k best per query, and only those
reach the final ranking. The final order is score descending, then id ascending.

``top_k`` ships the queries to every task and refuses sets above a size;
``top_k_blocks`` scores blocks against blocks, for query sets of any size. The
caller chooses.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperlake.settings import TOP_K

# Bytes of query vectors, in double, that ``top_k`` ships.
MAX_SHIPPED_BYTES = 64 * 1024 * 1024
# Score cells a task holds at once.
_SCORE_CELLS = 4_000_000
SCORE_DECIMALS = 6
# Per-task winners of a query are first ranked in this many parts.
MERGE_PARTS = 64


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double; zero rows stay zero."""
    wide = matrix.astype(np.float64)
    norms = np.sqrt((wide * wide).sum(axis=1, keepdims=True))
    return np.divide(wide, norms, out=np.zeros_like(wide), where=norms > 0)


def list_matrix(lists: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column without nulls as a matrix."""
    flat = pa.concat_arrays([c.flatten() for c in getattr(lists, "chunks", [lists])] or [pa.array([], pa.float64())])
    return flat.to_numpy(zero_copy_only=False).reshape(len(lists), -1 if len(lists) else 0)


def scores_of(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Rounded cosine scores, one row per vector and one column per query."""
    return np.round(vectors @ queries.T, SCORE_DECIMALS) + 0.0


def best_positions(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best entries; ties at the edge are settled by id."""
    keep = np.arange(len(scores))
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= edge)
    return keep[np.lexsort((ids[keep], -scores[keep]))[:k]]


def id_values(ids: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Ids as objects that compare as their type does."""
    out = np.empty(len(ids), dtype=object)
    out[:] = ids.to_pylist()
    return out


class RunningTopK:
    """The k best (id, score) pairs seen so far for each query of a task."""

    def __init__(self, k: int, n_queries: int):
        self._k = k
        # Score below which a row cannot enter a query's best k.
        self._floors = np.full(n_queries, -np.inf)
        self._best: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def add(self, ids: pa.Array, scores: np.ndarray, first_query: int = 0) -> None:
        """Take in a block of scores: one row per id, one column per query from ``first_query``.

        One comparison over the block finds the few rows that can still matter, and
        only their ids are taken out of the column.
        """
        floors = self._floors[first_query : first_query + scores.shape[1]]
        column, row = np.nonzero((scores >= floors).T)
        if not len(column):
            return
        rows, place = np.unique(row, return_inverse=True)
        values = id_values(ids.take(pa.array(rows)))
        edges = np.flatnonzero(np.diff(column)) + 1
        for part, at in zip(np.split(np.arange(len(row)), edges), column[np.r_[0, edges]]):
            self._keep(first_query + int(at), values[place[part]], scores[row[part], at])

    def _keep(self, query: int, ids: np.ndarray, scores: np.ndarray) -> None:
        if query in self._best:
            old_ids, old_scores = self._best[query]
            ids, scores = np.concatenate([old_ids, ids]), np.concatenate([old_scores, scores])
        order = best_positions(scores, ids, self._k)
        self._best[query] = (ids[order], scores[order])
        if len(order) == self._k:
            self._floors[query] = scores[order[-1]]

    def table(self, query_ids: pa.Array | pa.ChunkedArray, id_type: pa.DataType) -> pa.Table:
        queries = [q for q, (ids, _) in self._best.items() for _ in ids]
        ids = [i for found, _ in self._best.values() for i in found]
        scores = np.concatenate([np.empty(0), *(s for _, s in self._best.values())])
        return pa.table(
            {"query_id": query_ids.take(pa.array(queries, pa.int64())), "id": pa.array(ids, id_type), "score": scores}
        )


def rank(candidates: DataFrame, k: int) -> DataFrame:
    """Final ranking of per-task winners, in parts first, so that no task ranks all of a query's.

    Spark trims to k rows per group before each shuffle.
    """
    part = candidates.withColumn("_part", F.pmod(F.xxhash64("id"), F.lit(MERGE_PARTS)))
    for keys in (["query_id", "_part"], ["query_id"]):
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc("id"))
        part = part.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return part.select("query_id", "id", "score", "rank")


def _usable(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, "vector").filter(F.col(key).isNotNull() & F.col("vector").isNotNull())


def _candidate_schema(vectors: DataFrame, queries: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("id", vectors.schema["id"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )


def top_k(vectors: DataFrame, queries: DataFrame, k: int = TOP_K) -> DataFrame:
    """``query_id, id, score, rank`` of the k nearest vectors of each query, exactly.

    ``vectors`` has ``id`` and ``vector``; ``queries`` has ``query_id`` and ``vector``;
    ids may be of any type that orders, and rows with a null id or vector are left out.
    The queries are written to every task; their size is checked first, and a set above
    ``MAX_SHIPPED_BYTES`` is refused: use ``top_k_blocks``. Filter ``vectors`` beforehand
    to search within a payload condition.
    """
    asked = _usable(queries, "query_id")
    held = asked.agg(F.coalesce(F.sum(8 * F.size("vector")), F.lit(0))).first()[0]
    if held > MAX_SHIPPED_BYTES:
        raise ValueError(f"{held} bytes of query vectors are too many to ship; use top_k_blocks")
    shipped = asked.toArrow()
    keys, matrix = shipped.column("query_id").combine_chunks(), unit_rows(list_matrix(shipped.column("vector")))
    step = max(1, _SCORE_CELLS // max(1, len(keys)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, kind = RunningTopK(k, len(keys)), None
        for batch in batches:
            kind = batch.schema.field("id").type
            for start in range(0, batch.num_rows if len(keys) else 0, step):
                part = batch.slice(start, step)
                best.add(part.column("id"), scores_of(unit_rows(list_matrix(part.column("vector"))), matrix))
        if kind is not None:
            yield from best.table(keys, kind).to_batches()

    return rank(_usable(vectors, "id").mapInArrow(search, _candidate_schema(vectors, queries)), k)


def top_k_blocks(
    vectors: DataFrame, queries: DataFrame, k: int, vector_blocks: int, query_blocks: int
) -> DataFrame:
    """The same result for query sets of any size.

    Vectors and queries are dealt into blocks and every pair of blocks is scored by
    one task, which holds one block of each side and emits k rows per query. Work is
    the product of both sides, as in any exact search of this kind; a vector travels
    ``query_blocks`` times, a query ``vector_blocks`` times. Choose the numbers so that a
    block has some 100 MB: rows x dimension x 8 bytes / blocks. The row's place in its
    partition takes part in the dealing, so equal points spread over all blocks.
    """

    def blocked(df: DataFrame, key: str, own: str, own_n: int, other: str, other_n: int) -> DataFrame:
        block = F.pmod(F.xxhash64(key, "vector", F.monotonically_increasing_id()), F.lit(own_n))
        # The block is settled before the row is copied to the other side's blocks.
        dealt = _usable(df, key).withColumn(own, block.cast("int"))
        return dealt.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(other_n - 1))))

    v = blocked(vectors, "id", "vector_block", vector_blocks, "query_block", query_blocks)
    q = blocked(queries, "query_id", "query_block", query_blocks, "vector_block", vector_blocks)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        best, ids = RunningTopK(k, right.num_rows), left.column("id").combine_chunks()
        if left.num_rows and right.num_rows:
            units = unit_rows(list_matrix(left.column("vector")))
            step = max(1, _SCORE_CELLS // left.num_rows)
            for start in range(0, right.num_rows, step):
                part = right.column("vector").slice(start, step)
                best.add(ids, scores_of(units, unit_rows(list_matrix(part))), start)
        return best.table(right.column("query_id").combine_chunks(), left.schema.field("id").type)

    keys = ["vector_block", "query_block"]
    schema = _candidate_schema(vectors, queries)
    return rank(v.groupBy(*keys).cogroup(q.groupBy(*keys)).applyInArrow(score, schema), k)
