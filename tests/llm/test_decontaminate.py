from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paperlake.llm import decontaminate as d
from tests.llm.fixtures import DOCUMENT, documents, edited, prose, with_clashes

ITEM = "item_id long, text string"


def planted(spark, seed=2):
    """Documents with exact, upper-case and edited items inside, and clean ones."""
    rng = random.Random(seed)
    items = [(i, prose(rng, rng.randrange(15, 60)) + ".") for i in range(30)]
    rows, truth = [], set()
    for i in range(120):
        text = prose(rng, rng.randrange(5, 400))
        if i % 2:
            item, words = items[i // 2 % 30]
            place = text.split(" ")
            at = rng.randrange(len(place) + 1)
            shown = {1: words, 3: words.upper(), 5: edited(rng, words, len(words.split()) // 8)}[i % 6]
            text = " ".join([*place[:at], shown, *place[at:]])
            truth.add((i, item))
        rows.append((i, text, "en", "s", len(text)))
    return spark.createDataFrame(rows, DOCUMENT).repartition(3), spark.createDataFrame(items, ITEM), truth


def test_planted_items_are_found_and_clean_documents_left_alone(spark):
    docs, items, truth = planted(spark)
    found = d.find_leaks(with_clashes(docs), items).collect()
    got = {(r["doc_id"], r["item_id"]) for r in found}
    assert got <= truth and len(got) >= 0.98 * len(truth)
    assert all(0.6 * r["item_words"] <= r["lcs_words"] <= r["item_words"] for r in found)
    kept = d.without_leaks(with_clashes(docs), items)
    assert kept.columns == with_clashes(docs).columns
    assert {r["doc_id"] for r in kept.collect()} == set(range(120)) - {doc for doc, _ in got}


def test_blocks_of_items_do_not_change_the_result(spark, monkeypatch):
    docs, items, _ = planted(spark)
    whole = sorted(map(tuple, d.find_leaks(docs, items).collect()))
    monkeypatch.setattr(d, "ITEMS_PER_BLOCK", 7)
    assert sorted(map(tuple, d.find_leaks(docs, items).collect())) == whole


def test_awkward_tables(spark):
    docs, _, _ = planted(spark)
    odd = spark.createDataFrame([(1, None), (None, "a b c d e f g h i"), (2, ""), (3, "two words"), (4, "z " * 500)], ITEM)
    assert {r["item_id"] for r in d.find_leaks(documents(spark), odd).collect()} <= {4}
    empty = spark.createDataFrame([], ITEM)
    assert d.find_leaks(docs, empty).columns[:2] == ["doc_id", "item_id"] and d.find_leaks(docs, empty).isEmpty()
    assert d.without_leaks(docs, empty).count() == docs.count()
    assert d.find_leaks(spark.createDataFrame([], DOCUMENT), odd).isEmpty()


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


@settings(max_examples=100, deadline=None)
@given(a=st.lists(st.integers(0, 4), min_size=1, max_size=70), b=st.lists(st.integers(0, 4), max_size=70))
def test_bit_parallel_lcs(a, b):
    assert d.lcs_length(d._masks(a), len(a), b) == plain_lcs(a, b)


def test_directions_are_the_leading_ones():
    import numpy as np

    rng = np.random.default_rng(0)
    basis, _ = np.linalg.qr(rng.normal(size=(60, 60)))
    values = np.r_[np.linspace(50, 30, 5), np.full(55, 0.01)]
    gram = basis * values @ basis.T
    test = rng.normal(size=(60, 12))
    found = d._directions(gram @ test, test, 5)
    lengths = np.linalg.norm(found, axis=0)
    assert np.allclose(1 / lengths**2, values[:5], rtol=0.01)
    assert np.allclose(np.abs((found / lengths).T @ basis[:, :5]), np.eye(5), atol=0.05)


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 48, 49, 200])
def test_passages_cover_every_word(n):
    import numpy as np

    _, starts, ends = d._passages(np.array([0, n]), d.STRIDE)
    covered = {w for s, e in zip(starts, ends) for w in range(s, min(s + d.PASSAGE, e))}
    assert covered == set(range(n))


def hidden(rng, text, before=150, after=150):
    return f"{prose(rng, before)} {text} {prose(rng, after)}"


def found_pairs(spark, texts, items):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], DOCUMENT).repartition(2)
    rows = d.find_leaks(docs, spark.createDataFrame(items, ITEM)).collect()
    return {(r["doc_id"], r["item_id"]) for r in rows}


def test_long_items_are_found_exact_and_edited(spark):
    rng = random.Random(4)
    sizes = [70, 110, 150, 300, 1000]
    items = [(i, prose(rng, n)) for i, n in enumerate(sizes)]
    texts = [hidden(rng, t) for _, t in items] + [hidden(rng, edited(rng, t, n // 8)) for (_, t), n in zip(items, sizes)]
    texts += [prose(rng, 1500) for _ in range(10)]
    assert found_pairs(spark, texts, items) == {(i, i % 5) for i in range(10)}


def test_insertions_deletions_and_repeated_words_are_found(spark):
    rng = random.Random(6)
    sizes = [16, 40, 40, 59, 59, 300]
    items = [(i, prose(rng, n)) for i, n in enumerate(sizes)]
    items.append((6, " ".join(prose(rng, 4).split() * 6)))
    texts, truth = [], set()
    for item, text in items:
        words = text.split()
        shown = [text]
        if item < 6:
            for every in (5, 6, 7):
                more = [w if (i + 1) % every else f"{w} {prose(rng, 1)}" for i, w in enumerate(words)]
                shown += [" ".join(more), " ".join(w for i, w in enumerate(words) if (i + 1) % every)]
        for one in shown:
            truth.add((len(texts), item))
            texts.append(hidden(rng, one, rng.randrange(100, 150)))
    texts += [prose(rng, 400) for _ in range(20)]
    assert found_pairs(spark, texts, items) == truth


def test_short_items_and_scripts_without_blanks_are_found(spark):
    rng = random.Random(8)
    signs = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(60))
    thai = "".join(chr(0x0E01 + rng.randrange(40)) for _ in range(40))
    short = "Who wrote - Faust?"
    items = [(0, short), (1, "Weimar"), (2, signs), (3, "谁写了《浮士德》？"), (4, thai), (5, "who wrote faust"), (6, " - ?")]
    changed = signs[:20] + "们" + signs[21:40] + signs[42:]
    texts = [
        hidden(rng, 'who WROTE\n"Faust"'), hidden(rng, "in Weimar."), "前文" * 40 + signs + "后文" * 40, "前文" * 40 + changed + "后文" * 40,
        "后文谁写了浮士德前文", hidden(rng, thai), "who wrote of faust", prose(rng, 300), "后文谁写浮士德前文",
    ]
    assert found_pairs(spark, texts, items) == {(0, 0), (0, 5), (1, 1), (2, 2), (3, 2), (4, 3), (5, 4)}


@pytest.mark.parametrize("copies", [1, 50])
@pytest.mark.parametrize("size", [10, 30, 60, 200])
def test_tables_of_copies_of_one_item(spark, copies, size):
    text = prose(random.Random(9), size)
    items = [(0, text), (1, " ".join(text.split()[: size * 9 // 10])), (2, prose(random.Random(10), 30))]
    assert found_pairs(spark, [text] * copies, items) == {(i, j) for i in range(copies) for j in (0, 1)}
