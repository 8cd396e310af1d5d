"""Turning paper text into vectors with a batch encoder that runs inside the tasks."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperlake import schema
from paperlake.functions.text import embedding_text
from paperlake.settings import ENCODER_BATCH_SIZE

# Bytes of text an encoder call sees at most, unless a single text is longer.
MAX_PIECE_BYTES = 2 * 1024 * 1024
# Bytes of counts a hashing encoder holds at once, and texts it takes at most.
COUNT_BYTES = 64 * 1024 * 1024
MAX_ROWS = 8192

# Texts of one batch in, one float32 row per text out. An encoder may name the
# ``batch_size`` it wants.
Encoder = Callable[[pa.Array], np.ndarray]


class HashingEncoder:
    """Term counts over hashed buckets; deterministic and without a model file.

    A token goes to the bucket of the first 32 bits of its MD5. Each distinct
    token of a batch is hashed once and counting is one bincount over the batch,
    so this encoder likes large batches: as many texts as ``COUNT_BYTES`` of counts
    allow.
    """

    def __init__(self, dim: int):
        self.dim = dim
        self.batch_size = max(1, min(MAX_ROWS, COUNT_BYTES // (8 * dim)))

    def __call__(self, texts: pa.Array) -> np.ndarray:
        tokens = pc.split_pattern(pc.utf8_lower(texts), " ")
        rows = pc.list_parent_indices(tokens).to_numpy()
        words = pc.list_flatten(tokens).dictionary_encode()
        distinct = words.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)
        digests = b"".join([hashlib.md5(w, usedforsecurity=False).digest() for w in distinct])
        bucket_of = np.frombuffer(digests, dtype=">u4")[::4].astype(np.int64) % self.dim
        cells = rows * self.dim + bucket_of[words.indices.to_numpy()]
        counts = np.bincount(cells, minlength=len(texts) * self.dim)
        return counts.reshape(len(texts), self.dim).astype(np.float32)


def hashing_encoder(dim: int) -> Callable[[], Encoder]:
    return partial(HashingEncoder, dim)


def _float_lists(matrix: np.ndarray) -> pa.Array:
    rows, dim = matrix.shape
    offsets = np.arange(0, (rows + 1) * dim, dim, dtype=np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(matrix.ravel()))


def _pieces(texts: pa.Array, max_rows: int) -> Iterator[tuple[int, int]]:
    """``(start, length)`` of slices of at most ``max_rows`` texts and about ``MAX_PIECE_BYTES``.

    A slice always holds at least one whole text, however long.
    """
    sums = np.r_[0, np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)]
    start = 0
    while start < len(texts):
        fits = int(np.searchsorted(sums, sums[start] + MAX_PIECE_BYTES, "right")) - 1
        end = min(max(fits, start + 1), start + max_rows, len(texts))
        yield start, end - start
        start = end


def embed(df: DataFrame, text: str, make_encoder: Callable[[], Encoder]) -> DataFrame:
    """Replace the ``text`` column by a ``vector`` column.

    The encoder is built once per task and sees at most its ``batch_size`` whole
    texts at a time, fewer when they are long; rows stream through, so memory
    does not grow with the table.
    """
    kept = [f for f in df.schema if f.name != text]
    names = [f.name for f in kept]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = make_encoder()
        batch_size = getattr(encoder, "batch_size", ENCODER_BATCH_SIZE)
        for batch in batches:
            for start, length in _pieces(batch.column(text), batch_size):
                piece = batch.slice(start, length)
                vectors = _float_lists(encoder(piece.column(text)))
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(n) for n in names), vectors], names=[*names, "vector"]
                )

    out = T.StructType([*kept, T.StructField("vector", T.ArrayType(T.FloatType()))])
    return df.mapInArrow(encode, out)


def embedding_input(papers: DataFrame) -> DataFrame:
    """The columns a point needs: id, text to encode and its fingerprint, payload and date partition."""
    text = embedding_text(*map(F.col, ("title", "abstract", "full_text")))
    return papers.select(
        "id",
        text.alias("text"),
        F.struct(*schema.PAYLOAD_FIELDS).alias("payload"),
        F.md5(text).alias("text_hash"),
        *schema.PARTITION_COLUMNS,
    )


def build_points(
    papers: DataFrame, make_encoder: Callable[[], Encoder], partitions: int | None = None
) -> DataFrame:
    """Vector points of all given papers: ``id, vector, payload`` and the partition columns.

    ``partitions`` spreads the texts over that many tasks first, for inputs of few files.
    """
    rows = embedding_input(papers)
    if partitions is not None:
        rows = rows.repartition(partitions, "id")
    points = embed(rows, "text", make_encoder)
    return points.select(*schema.points_schema().names)


def upsert_points(
    existing: DataFrame, papers: DataFrame, make_encoder: Callable[[], Encoder]
) -> DataFrame:
    """The collection after the papers are encoded into it: one point per id, the new one wins.

    Which points to replace is read off the papers' ids, so encoding runs once.
    """
    untouched = existing.join(papers.select("id"), "id", "left_anti")
    return untouched.unionByName(build_points(papers, make_encoder))


def refreshed_points(
    existing: DataFrame, papers: DataFrame, make_encoder: Callable[[], Encoder]
) -> DataFrame:
    """The points of ``papers``, one row per id on both sides, encoding only those whose text is new or changed.

    A point is taken over when one of ``existing`` has its id and the fingerprint of its
    text; the payload and the date are always the paper's.
    """
    rows = embedding_input(papers)
    known = existing.select("id", "text_hash", "vector").filter("vector is not null")
    kept = rows.drop("text").join(known, ["id", "text_hash"])
    changed = rows.join(known.drop("vector"), ["id", "text_hash"], "left_anti")
    names = schema.points_schema().names
    return kept.select(*names).unionByName(embed(changed, "text", make_encoder).select(*names))
