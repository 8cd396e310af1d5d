from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paperlake.llm import language_id, lm
from tests.llm.fixtures import DOCUMENT, documents, lower, with_clashes, words

SF = "/root/testdata/sf0.01"


def brute_scores(rows, order, prior):
    def fold(doc):
        return doc is not None and zlib.crc32(str(doc).encode()) % 5 == 1

    counts, n = Counter(), 0
    token_rows = [["<s>", *words(lower(t or "")), "</s>"] for _, t in rows]
    for (doc, _), w in zip(rows, token_rows):
        if not fold(doc):
            n += len(w) - 1
            counts[("<s>",)] += 1
            counts.update((x,) for x in w[1:])
            for k in range(2, order + 1):
                counts.update(tuple(w[i - k + 1 : i + 1]) for i in range(k - 1, len(w)))
    v = sum(len(k) == 1 for k in counts) - (("<s>",) in counts)

    def probability(context, word):
        if not context:
            return (counts[(word,)] + 0.5) / (n + 0.5 * (v + 1))
        shorter = probability(context[1:], word)
        if not counts[context]:
            return shorter
        return (counts[(*context, word)] + prior * shorter) / (counts[context] + prior)

    out = []
    for (doc, _), w in zip(rows, token_rows):
        base = sum(math.log10(probability((), x)) for x in w[1:])
        score = sum(math.log10(probability(tuple(w[max(0, i - order + 1) : i]), w[i])) for i in range(1, len(w)))
        known = sum(counts[(x,)] > 0 for x in w[1:])
        out.append((str(doc), fold(doc), len(w) - 1, known, n, round(base, 6), round(score, 6)))
    return sorted(out)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_scores_equal_brute_force(spark, order):
    df = documents(spark)
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    got = lm.score_documents(with_clashes(df), order, 3.0).collect()
    rounded = sorted((str(r[0]), *tuple(r)[1:5], round(r[5], 6), round(r[6], 6)) for r in got)
    for mine, wanted in zip(rounded, brute_scores(rows, order, 3.0), strict=True):
        assert mine[:5] == wanted[:5] and mine[5:] == pytest.approx(wanted[5:], abs=2e-5)


@pytest.mark.parametrize("block_bytes", [60, 1 << 30])
def test_blocks_of_any_size_give_the_same_scores(spark, block_bytes):
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(list("abcdefgh"), 12)) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate([*texts, *texts[:10], "", None, "only here twice only here"])]
    got = lm.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), 4, 3.0, block_bytes)
    mine = sorted((str(r[0]), *tuple(r)[1:5], r[5], r[6]) for r in got.collect())
    for one, wanted in zip(mine, brute_scores(rows, 4, 3.0), strict=True):
        assert one[:5] == wanted[:5] and one[5:] == pytest.approx(wanted[5:], abs=2e-5)


def small_automaton(order, prior=2.0):
    rows = lm.TokenRows(pa.array(["a b a c", "a b", "c a b a"]))
    grams = [rows.grams(k, np.ones(3, bool)) for k in range(1, order + 1)]
    automaton = lm.BackoffAutomaton(grams, [g.counts for g in grams], 13, 4, prior)
    return automaton, rows, grams


@pytest.mark.parametrize("order", [2, 3])
def test_every_state_has_probability_one(order):
    automaton, rows, grams = small_automaton(order)
    start = grams[0].at[0]
    vocabulary = np.setdiff1d(np.arange(automaton.n_words), [start])
    unknown = 0.5 / (13 + 0.5 * 5)
    assert len(automaton.failure) > 5
    for state in range(len(automaton.failure)):
        weights, _ = automaton.step(np.full(len(vocabulary), state), vocabulary)
        missed, at = 1.0, state
        while at:
            missed, at = missed * 10 ** automaton.failure_weight[at], automaton.failure[at]
        ends_a_text = state in (automaton.word_target[grams[0].at[rows.first[1:] - 1]])
        if not ends_a_text and not any(state == 1 + len(grams[0].keys) + g for g in grams[1].at[rows.first[1:] - 1]):
            assert (10**weights).sum() + missed * unknown == pytest.approx(1.0)


def test_failure_arcs_lead_to_the_context_without_its_first_token():
    automaton, _, grams = small_automaton(3)
    first_pair = 1 + len(grams[0].keys)
    for pair, end in enumerate(grams[1].ends):
        assert automaton.failure[first_pair + pair] == 1 + grams[0].at[end]
    assert not automaton.failure[:first_pair].any()


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_a_text_of_many_lanes_is_scored_like_one(order, monkeypatch):
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(list("abcd"), n)) for n in (0, 1, 7, 300)]
    rows = lm.TokenRows(pa.array(texts))
    grams = [rows.grams(k, np.array([True, True, True, False])) for k in range(1, order + 1)]
    automaton = lm.BackoffAutomaton(grams, [g.counts for g in grams], 11, 5, 2.0)
    monkeypatch.setattr(lm, "LANE", 1000)
    whole = automaton.traverse(rows, grams[0].at)
    monkeypatch.setattr(lm, "LANE", 5)
    assert automaton.traverse(rows, grams[0].at) == pytest.approx(whole)


def test_the_model_beats_single_tokens_on_held_out_texts(spark):
    got = lm.score_documents(spark.read.parquet(f"{SF}/documents.parquet")).filter("held_out")
    base, score = got.agg(F.sum("base_score"), F.sum("score")).first()
    assert score > base


def test_held_out_accuracy(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    found = language_id.identify(df, language_id.fit(df, 100))
    both = found.filter("held_out").join(df.select("doc_id", "lang"), "doc_id")
    right, n = both.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 200 and right >= 0.98
    assert found.filter("score < 0 or score > 1").isEmpty()


def small_network():
    rng = np.random.default_rng(0)
    texts = [" ".join(rng.choice(ws, 60)) for ws in (["the", "and", "with"], ["der", "und", "mit"]) for _ in range(20)]
    cells, row, _ = language_id.windows_of(*language_id.text_bytes(pa.array(texts)))
    network = language_id.ByteNetwork.untrained(["de", "en"])
    network.train(cells, np.array([1] * 20 + [0] * 20)[row])
    return network


def test_awkward_texts_and_columns(spark):
    df = documents(spark)
    network = small_network()
    got = language_id.identify(with_clashes(df), network).collect()
    assert len(got) == df.count()
    texts = {r["doc_id"]: r["text"] for r in df.filter("doc_id is not null").collect()}
    for r in got:
        blank = r["doc_id"] is not None and not any(c.isalpha() for c in texts[r["doc_id"]] or "")
        assert not blank or (r["lang_pred"], r["score"]) == ("und", 0.0)
        assert r["lang_pred"] in ("de", "en", "und") and 0 <= r["score"] <= 1
    kept = language_id.accepted(with_clashes(df), network)
    assert kept.columns == with_clashes(df).columns
    assert kept.count() == sum(r["lang_pred"] != "und" and r["score"] >= language_id.LEAST_SCORE for r in got)


def test_long_texts_are_read_to_the_end(spark, monkeypatch):
    network = small_network()
    text = "the and with " * 300 + "der und mit " * 3000
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    whole = language_id.identify(df, network).first()
    monkeypatch.setattr(language_id, "_PIECE_BYTES", 512)
    data, offsets = language_id.text_bytes(pa.array([text, "", "ab"]))
    pieces = list(language_id.window_pieces(data, offsets))
    assert sum(f.sum() for _, f, _ in pieces) == len(text) + 2 and len(pieces) > 50
    assert whole["lang_pred"] == "de"


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(3)
    network = language_id.ByteNetwork.untrained(["x", "y", "z"])
    network.embedding = network.embedding.astype(np.float64)
    network.banks = [b.astype(np.float64) for b in network.banks]
    cells, labels = rng.integers(1, 255, (6, 40)).astype(np.uint8), np.array([0, 1, 2, 0, 1, 2])

    def loss():
        p = network.probabilities(cells, network.pair_tables())
        return -np.log(p[np.arange(6), labels]).mean()

    grads = network._gradients(cells, labels)
    for weights, grad in zip([network.embedding, *network.banks, network.bias, network.out, network.out_bias], grads):
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        before, step = weights[at], 1e-3
        weights[at] = before + step
        up = loss()
        weights[at] = before - step
        down = loss()
        weights[at] = before
        assert (up - down) / (2 * step) == pytest.approx(grad[at], rel=0.05, abs=1e-4)


def test_the_sample_is_bounded_and_leaves_held_out_documents_alone(spark):
    df = documents(spark)
    sample = language_id.training_sample(df, 5).collect()
    assert max(Counter(r["lang"] for r in sample).values()) <= 10
    held = df.filter("crc32(cast(doc_id as string)) % 4 = 2")
    assert language_id.training_sample(held, 5).isEmpty()


def test_empty_and_unlabelled_tables(spark):
    empty = spark.createDataFrame([], DOCUMENT)
    assert language_id.fit(empty) is None and lm.score_documents(empty).collect() == []
    assert language_id.identify(empty, None).collect() == []
    one = spark.createDataFrame([(1, "text", None, None, None)], DOCUMENT)
    assert [r["lang_pred"] for r in language_id.identify(one, language_id.fit(one)).collect()] == ["und"]


def test_random_seed_is_fixed():
    random.seed(1)
    a, b = small_network(), small_network()
    assert np.array_equal(a.out, b.out)
