from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paperlake import schema
from paperlake.operators import embed
from paperlake.operators.refine import add_partition_columns, flag_doi

TEXTS = ["a b a", "", "Ä ä  b", "one\ntwo three", "x" * 5000 + " y"]


def naive(text, dim):
    vector = np.zeros(dim, dtype=np.float32)
    for token in text.lower().split(" "):
        vector[int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % dim] += 1
    return vector


@pytest.mark.parametrize("dim", [7, 64])
def test_hashing_encoder_counts_every_token(dim):
    got = embed.HashingEncoder(dim)(pa.array(TEXTS))
    assert np.array_equal(got, np.stack([naive(t, dim) for t in TEXTS]))


@pytest.mark.parametrize("batch_size", [1, 2, 128])
def test_batches_do_not_change_vectors(spark, batch_size):
    def make_encoder():
        encoder = embed.HashingEncoder(16)
        encoder.batch_size = batch_size
        return encoder

    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string").repartition(2)
    out = embed.embed(df, "text", make_encoder)
    assert out.columns == ["i", "vector"]
    got = {r["i"]: r["vector"] for r in out.collect()}
    assert got == {i: naive(t, 16).tolist() for i, t in enumerate(TEXTS)}


class Lengths:
    """An encoder of one dimension; counts how often it is built."""

    def __call__(self, texts):
        return np.array([[len(t)] for t in texts.to_pylist()], dtype=np.float32)


def papers_of(spark, rows):
    names = [n for n, _ in schema.PAPER_FIELDS]
    full = [tuple({**dict.fromkeys(names), **r}[n] for n in names) for r in rows]
    return add_partition_columns(flag_doi(spark.createDataFrame(full, schema.paper_schema())))


def points_of(spark, rows):
    return embed.build_points(papers_of(spark, rows), Lengths)


def test_points_carry_payload_and_skip_null_text(spark):
    (p,) = points_of(spark, [{"id": "a", "title": "tt", "full_text": "fff", "source": "acm"}]).collect()
    assert p["vector"] == [6.0]
    assert p["payload"].asDict() == {
        "id": "a", "title": "tt", "authors": None, "publication_date": None, "doi": None, "source": "acm",
    }


def test_upsert_points_last_write_wins(spark):
    old = points_of(spark, [{"id": "a", "title": "1"}, {"id": "b", "title": "1"}])
    new = papers_of(spark, [{"id": "b", "title": "22"}, {"id": "c", "title": "22"}])
    points = embed.upsert_points(old, new, Lengths)
    got = points.select("id", F.col("vector")[0].alias("v")).collect()
    assert sorted(tuple(r) for r in got) == [("a", 1.0), ("b", 2.0), ("c", 2.0)]


def test_long_texts_go_in_smaller_pieces(monkeypatch):
    monkeypatch.setattr(embed, "MAX_PIECE_BYTES", 10)
    texts = pa.array(["aaaa", "bbbb", "cccc", "d" * 50, "e", None, "f"])
    assert list(embed._pieces(texts, 128)) == [(0, 2), (2, 1), (3, 1), (4, 3)]
    assert list(embed._pieces(texts, 1)) == [(i, 1) for i in range(7)]
    assert list(embed._pieces(pa.array([], pa.string()), 5)) == []


def test_an_encoder_call_sees_little_text():
    texts = pa.array(["x" * 100_000] * 100)
    pieces = list(embed._pieces(texts, embed.MAX_ROWS))
    assert sum(n for _, n in pieces) == 100 and max(n for _, n in pieces) * 100_000 <= 2 * 1024 * 1024


def test_points_schema_is_the_declared_one(spark):
    got = points_of(spark, [{"id": "a"}]).schema
    assert [(f.name, f.dataType.simpleString()) for f in got] == [
        (f.name, f.dataType.simpleString()) for f in schema.points_schema()
    ]


@pytest.mark.parametrize("dim", [64, 2**18, 2**22])
def test_batches_shrink_with_the_dimension(dim):
    encoder = embed.HashingEncoder(dim)
    assert 1 <= encoder.batch_size <= embed.MAX_ROWS
    assert encoder.batch_size * dim * 8 <= max(embed.COUNT_BYTES, 8 * dim)


def test_a_large_dimension_counts_the_same(spark):
    dim = 2**20
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string")
    out = embed.embed(df, "text", embed.hashing_encoder(dim)).select("i", F.aggregate("vector", F.lit(0.0), lambda a, x: a + x))
    assert {r[0]: r[1] for r in out.collect()} == {i: float(len(t.split(" "))) for i, t in enumerate(TEXTS)}


def test_points_can_be_spread(spark):
    papers = papers_of(spark, [{"id": str(i), "title": "t"} for i in range(20)]).coalesce(1)
    assert embed.build_points(papers, Lengths, partitions=3).rdd.getNumPartitions() == 3
