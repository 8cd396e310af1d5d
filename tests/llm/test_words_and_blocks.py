from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paperlake.llm import blocks, words
from paperlake.llm.components import connected_components
from tests.llm.fixtures import WORD, lower

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbé \t\n\x0b 😀.", max_size=30)), max_size=20)


@settings(max_examples=60, deadline=None)
@given(texts=TEXTS)
def test_words_are_those_of_the_pattern(texts):
    found = words.Words(pa.array(texts, pa.string()), lower=True)
    wanted = [WORD.findall(lower(t or "")) for t in texts]
    assert np.diff(found.first).tolist() == [len(w) for w in wanted]
    flat = [w for row in wanted for w in row]
    assert [lower(found.text(i).decode()) for i in range(len(flat))] == flat
    numbers = dict(zip(flat, found.hashes.tolist()))
    assert [numbers[w] for w in flat] == found.hashes.tolist() and len(set(numbers.values())) == len(numbers)


def test_chunks_do_not_change_words(monkeypatch):
    texts = pa.array(["aa bb  cc" * 50, "x" * 500, "", " y ", "zz"] * 3)
    whole = words.Words(texts, lower=False)
    monkeypatch.setattr(words, "CHUNK_BYTES", 16)
    parts = words.Words(texts, lower=False)
    assert np.array_equal(whole.hashes, parts.hashes) and np.array_equal(whole.first, parts.first)


def test_trimmed_words():
    found = words.Words(pa.array(["(then), the### !!! then"]), lower=True, trim=True)
    plain = words.Words(pa.array(["then the then"]), lower=True)
    assert found.hashes[[0, 1, 3]].tolist() == plain.hashes.tolist()


def test_sequences_are_equal_where_their_words_are():
    found = words.Words(pa.array(["a b c a b c", "b c a"]), lower=False)
    starts, offsets = words.window_starts(found.first, 3)
    keys = words.sequence_hashes(found.hashes, starts, 3)
    assert offsets.tolist() == [0, 4, 5]
    assert keys[0] == keys[3] and keys[1] == keys[4] and len(set(keys.tolist())) == 3


@settings(max_examples=50, deadline=None)
@given(values=st.lists(st.integers(0, 2**64 - 1), max_size=50))
def test_packing_round_trip(values):
    numbers = np.array(values, np.uint64)
    assert np.array_equal(blocks.unpack(blocks.pack(numbers)), numbers)
    ordered = np.sort(numbers)
    assert np.array_equal(blocks.unpack_sorted(blocks.pack_sorted(ordered)), ordered)


def test_blocks_learn_corpus_totals(spark):
    rows = [(i % 5, f"w{i % 7} w{i % 3}") for i in range(60)]
    df = spark.createDataFrame(rows, "block int, text string")

    def keys_of(table):
        return np.unique(words.Words(table.column("text"), lower=False).hashes, return_counts=True)

    def told(table, answered):
        keys, _ = keys_of(table)
        return pa.table({"key": keys.astype(np.int64), "n": blocks.block_totals(answered).astype(np.int64)})

    asked = blocks.requests(df, keys_of, 64)
    got = blocks.with_answers(df, blocks.answers(asked), told, "key long, n long").collect()
    keys, counts = keys_of(pa.table({"text": [t for _, t in rows]}))
    wanted = dict(zip(keys.astype(np.int64).tolist(), counts.tolist()))
    assert {r["key"] for r in got} == wanted.keys() and all(wanted[r["key"]] == r["n"] for r in got)
    stats = blocks.key_statistics(asked, lambda k: k == k).collect()
    assert sum(r["distinct_keys"] for r in stats) == len(keys) and sum(r["sum_totals"] for r in stats) == 120


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(i, i + 1) for i in range(100, 130)]
    parent = {n: n for e in edges for n in e}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    df = spark.createDataFrame([*edges, (5, None), (7, 7)], "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: root(n) for n in linked}


def test_no_edges_no_components(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
