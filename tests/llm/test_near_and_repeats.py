from __future__ import annotations

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from paperlake.llm import ngram_join, substrings
from tests.llm.fixtures import DOCUMENT, documents, lower, with_clashes, words


def shingles(text):
    w = words(lower(text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_groups(rows):
    """Per row its shingle count and component, every pair compared."""
    texts = {}
    for doc, text in rows:
        if doc is not None:
            texts.setdefault(doc, set()).add(shingles(text))
    parent = {d: d for d in texts}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    held = [(d, s) for d, sets in texts.items() for s in sets if s]
    for i, (a, x) in enumerate(held):
        for b, y in held[:i]:
            if 100 * len(x & y) >= 80 * len(x | y):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return sorted((d, len(shingles(t)), root(d) if d is not None else None) for d, t in rows if d is not None)


def test_groups_equal_all_pairs(spark):
    df = documents(spark)
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    got = ngram_join.near_duplicates(with_clashes(df)).collect()
    assert sorted(tuple(r) for r in got if r["doc_id"] is not None) == brute_groups(rows)
    unnamed = [r for r in got if r["doc_id"] is None]
    assert sorted(r["n_shingles"] for r in unnamed)[0] == 0 and {r["component_id"] for r in unnamed} == {None}


def test_hubs_do_not_decide_what_is_found(spark, monkeypatch):
    df = documents(spark, seed=5)
    rows = [tuple(r) for r in df.select("doc_id", "text").filter("doc_id is not null").collect()]
    monkeypatch.setattr(ngram_join, "HUBS", 1)
    got = sorted(tuple(r) for r in ngram_join.near_duplicates(df.filter("doc_id is not null")).collect())
    assert got == brute_groups(rows)


def test_one_of_each_group_stays(spark):
    df = with_clashes(documents(spark))
    groups = brute_groups([tuple(r) for r in df.select("doc_id", "text").collect()])
    kept = ngram_join.one_per_group(df)
    assert kept.columns == df.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == sorted({c for _, _, c in groups})
    assert ids.count(None) == 2


def brute_repeats(rows, window):
    starts = Counter()
    for _, text in rows:
        w = words(text)
        starts.update(tuple(w[i : i + window]) for i in range(len(w) - window + 1))
    out = []
    for doc, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if starts[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((str(doc), len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("window", [35, 4, 1])
def test_repeats_equal_brute_force(spark, window):
    df = documents(spark)
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    found = substrings.remove_repeats(with_clashes(df), window)
    digest = found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()
    assert sorted((str(r[0]), *tuple(r)[1:]) for r in digest) == brute_repeats(rows, window)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], DOCUMENT)
    assert ngram_join.near_duplicates(empty).collect() == []
    assert ngram_join.one_per_group(empty).collect() == []
    assert substrings.remove_repeats(empty).collect() == []


def test_texts_are_shuffled_once(spark, folder):
    documents(spark).write.parquet(f"{folder}/d")
    found = substrings.remove_repeats(spark.read.parquet(f"{folder}/d"))
    found.collect()
    final = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("ReusedExchange") == 2 and final.count("FileScan") == 1
