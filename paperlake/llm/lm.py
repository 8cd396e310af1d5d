"""Scoring texts with an n-gram model, as a weighted backoff automaton.

A state is a context: the empty one, or up to ``order - 1`` words (or the start of
a text) that training has. An arc of a state for a word that followed its context
carries the word's log-probability and leads to the longest context that now ends
there; every other word takes the failure arc to the context without its first word,
at that arc's weight. Probabilities are smoothed towards the shorter context with a
Dirichlet prior of weight ``prior``:

    p(w | h) = (c(h w) + prior * p(w | h')) / (c(h) + prior)

so the failure arc of h weighs ``log10(prior / (c(h) + prior))`` and everything sums
to one. The empty context has an arc for every word, ``(c + 0.5) / (N + 0.5 * (V + 1))``,
also for a word training lacks, which leads back to it.

The automaton is never gathered in one place. Documents lie in blocks; a block asks
for the counts of the n-grams it holds, which make up the part of the automaton that
its texts can reach, and traverses that. Of three words and more it asks only for
n-grams whose first words and whose last words other blocks hold as well: nobody else
can hold the rest, so their counts are known at home.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperlake.llm.blocks import (
    answers,
    block_totals,
    blocks_by_size,
    classes_of,
    further_requests,
    key_statistics,
    requests,
    sized_block_column,
    with_answers,
)
from paperlake.llm.words import Words, sequence_hashes

ORDER = 3
# Weight of the shorter context, in observations.
PRIOR = 20.0
FOLDS = 5
HELD_OUT_FOLD = 1
# Tokens that one lane of a traversal takes; longer texts are several lanes.
LANE = 128
# Text of a block, which a task holds with its n-grams while it scores it. Larger blocks
# share more of what they ask for, so raise this with the executors' memory.
BLOCK_BYTES = 8 << 20

_START, _END = np.uint64(0x5354415254), np.uint64(0x454E44)
_SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)
# A block's number for a key is its count and, above these bits, one for the block itself.
# Four trillion of one n-gram fit, and twice the blocks there may be; more text makes them larger.
_COUNT_BITS = np.uint64(42)
_MOST_BLOCKS = 1 << 21
_COUNT_MASK = (np.uint64(1) << _COUNT_BITS) - np.uint64(1)
_ONE = np.uint64(1)


@dataclass
class Grams:
    """The distinct k-grams of a block.

    ``keys`` ascend; ``counts`` are occurrences in the block's training rows, ``ends`` a
    position where each one ends, ``at`` the k-gram that ends at each position, or -1.
    """

    keys: np.ndarray
    counts: np.ndarray
    ends: np.ndarray
    at: np.ndarray


class TokenRows:
    """Texts as one sequence of start mark, words and end mark per row.

    Row r's start mark is at ``first[r]``, its tokens follow.
    """

    def __init__(self, texts: pa.Array | pa.ChunkedArray):
        words = Words(texts, lower=True)
        self.n_tokens = np.diff(words.first) + 1
        self.first = np.r_[0, np.cumsum(self.n_tokens + 1)]
        self.hashes = np.empty(self.first[-1], np.uint64)
        inside = np.ones(len(self.hashes), bool)
        inside[self.first[:-1]] = inside[self.first[1:] - 1] = False
        self.hashes[self.first[:-1]] = _START
        self.hashes[self.first[1:] - 1] = _END
        self.hashes[inside] = words.hashes

    def grams(self, k: int, train: np.ndarray) -> Grams:
        """The k-grams within rows. Keys of single tokens are even, all others odd.

        The start mark is no token of the vocabulary; it only counts as a context, and
        its key is odd.
        """
        place = np.arange(len(self.hashes)) - np.repeat(self.first[:-1], self.n_tokens + 1)
        ends = np.flatnonzero(place >= k - 1)
        keys = sequence_hashes(self.hashes, ends - k + 1, k) | _ONE
        if k == 1:
            keys -= (place[ends] > 0).astype(np.uint64)
        order = np.argsort(keys)
        ordered = keys[order]
        new = np.r_[True, ordered[1:] != ordered[:-1]]
        gram = np.empty(len(keys), np.int64)
        gram[order] = np.cumsum(new) - 1
        at = np.full(len(self.hashes), -1)
        at[ends] = gram
        learns = np.repeat(train, self.n_tokens + 1)[ends]
        counts = np.bincount(gram[learns], minlength=np.count_nonzero(new))
        return Grams(ordered[new], counts, ends[order[new]], at)


def _block_grams(table: pa.Table, order: int) -> tuple[TokenRows, list[Grams]]:
    rows = TokenRows(table.column("text"))
    train = ~table.column("held_out").to_numpy()
    return rows, [rows.grams(k, train) for k in range(1, order + 1)]


def _numbers(counts: np.ndarray) -> np.ndarray:
    return counts.astype(np.uint64) + (_ONE << _COUNT_BITS)


def _totals(sums: np.ndarray) -> np.ndarray:
    return sums & _COUNT_MASK


def _answer(sums: np.ndarray) -> np.ndarray:
    """Total, and in the lowest bit whether several blocks hold the key."""
    return _totals(sums) << _ONE | (sums >> _COUNT_BITS > 1).astype(np.uint64)


def _short_keys(grams: list[Grams]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of one and two tokens together, and the order in which they ascend."""
    keys = np.concatenate([g.keys for g in grams[:2]])
    return keys, np.argsort(keys, kind="stable")


def _open(longer: Grams, shorter: Grams, shared: np.ndarray) -> np.ndarray:
    """Which n-grams other blocks may hold: all but their last token, and all but their first, must be shared."""
    return shared[shorter.at[longer.ends - 1]] & shared[shorter.at[longer.ends]]


def _known_totals(grams: list[Grams], told: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Counts over the corpus of a block's n-grams, and whether other blocks hold them.

    ``told`` are the answers to all that the block has asked for so far.
    """
    keys, order = _short_keys(grams)
    short = np.empty(len(keys), np.uint64)
    short[order] = told[: len(keys)]
    cuts = np.cumsum([len(g.keys) for g in grams[:2]])[:-1]
    totals = [(t >> _ONE).astype(np.int64) for t in np.split(short, cuts)]
    shared = [(t & _ONE).astype(bool) for t in np.split(short, cuts)]
    start = len(keys)
    for shorter, longer in zip(grams[1:], grams[2:]):
        asks = _open(longer, shorter, shared[-1])
        answer = told[start : start + np.count_nonzero(asks)]
        start += len(answer)
        totals.append(longer.counts.copy())
        totals[-1][asks] = (answer >> _ONE).astype(np.int64)
        shared.append(asks)
        shared[-1][asks] = (answer & _ONE).astype(bool)
    return totals, shared


class BackoffAutomaton:
    """The states and arcs that a block's n-grams reach.

    ``grams`` and ``totals`` are the block's n-grams of 1 to ``order`` tokens and their
    counts in training. State 0 is the empty context. ``arcs`` ascend by state and word.
    """

    def __init__(self, grams: list[Grams], totals: list[np.ndarray], n: int, v: int, prior: float):
        words = grams[0]
        self.order, self.n_words = len(grams), len(words.keys)
        contexts = grams[:-1]
        offsets = np.cumsum([1, *[len(g.keys) for g in contexts]])
        self.failure = np.zeros(offsets[-1], np.int64)
        self.failure_weight = np.zeros(offsets[-1])
        probability = (totals[0] + 0.5) / (n + 0.5 * (v + 1))
        self.word_weight = np.log10(probability)
        self.word_target = np.zeros(self.n_words, np.int64)
        if contexts:
            self.word_target = np.where(totals[0] > 0, offsets[0] + np.arange(self.n_words), 0)
        arcs, weights, targets = [np.empty(0, np.int64)], [np.empty(0)], [np.empty(0, np.int64)]
        for k, g in enumerate(contexts):
            states = slice(offsets[k], offsets[k + 1])
            self.failure_weight[states] = np.log10(prior / (totals[k] + prior))
            if k:
                self.failure[states] = offsets[k - 1] + contexts[k - 1].at[g.ends]
            longer = grams[k + 1]
            before, after = g.at[longer.ends - 1], g.at[longer.ends]
            count = totals[k + 1]
            probability = (count + prior * probability[after]) / (totals[k][before] + prior)
            # A context of full length drops its first token as it takes a word.
            full = k + 2 == self.order
            target = offsets[k] + after if full else offsets[k + 1] + np.arange(len(longer.keys))
            seen = np.flatnonzero(count > 0)
            arcs.append((offsets[k] + before[seen]) * self.n_words + words.at[longer.ends[seen]])
            weights.append(np.log10(probability[seen]))
            targets.append(target[seen])
        arcs = np.concatenate(arcs)
        ascending = np.argsort(arcs)
        # A last arc that no word takes, so that every search ends at one.
        self.arcs = np.r_[arcs[ascending], np.iinfo(np.int64).max]
        self.weights = np.r_[np.concatenate(weights)[ascending], 0.0]
        self.targets = np.r_[np.concatenate(targets)[ascending], 0]

    def step(self, states: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each state takes a word: its weight, failure arcs included, and the next state."""
        states = states.copy()
        weight, target = np.zeros(len(states)), np.zeros(len(states), np.int64)
        without_arc = states == 0
        moving = np.flatnonzero(~without_arc)
        while len(moving):
            wanted = states[moving] * self.n_words + words[moving]
            arc = np.searchsorted(self.arcs, wanted)
            has_arc = self.arcs[arc] == wanted
            taken, arc = moving[has_arc], arc[has_arc]
            weight[taken] += self.weights[arc]
            target[taken] = self.targets[arc]
            failed = moving[~has_arc]
            weight[failed] += self.failure_weight[states[failed]]
            states[failed] = self.failure[states[failed]]
            at_root = states[failed] == 0
            without_arc[failed[at_root]] = True
            moving = failed[~at_root]
        weight[without_arc] += self.word_weight[words[without_arc]]
        target[without_arc] = self.word_target[words[without_arc]]
        return weight, target

    def traverse(self, rows: TokenRows, words: np.ndarray) -> np.ndarray:
        """Log-probability of each row, whose tokens are ``words`` by position.

        Every lane carries a state from left to right and adds up the weights of its
        arcs. A lane that continues a text first takes the ``order - 1`` tokens before
        it from the empty context, without their weights, which leads to the very state
        that its text was in: a state is the longest context of at most that many tokens.
        """
        n_lanes = -(-rows.n_tokens // LANE)
        row = np.repeat(np.arange(len(rows.n_tokens)), n_lanes)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(n_lanes) - n_lanes, n_lanes)
        start = rows.first[:-1][row] + 1 + nth * LANE
        length = np.minimum(rows.n_tokens[row] - nth * LANE, LANE)
        longest = np.argsort(-length, kind="stable")
        row, nth, start, length = row[longest], nth[longest], start[longest], length[longest]
        states = np.zeros(len(row), np.int64)
        states[nth == 0] = self.word_target[words[start[nth == 0] - 1]]
        continues = np.flatnonzero(nth > 0)
        for t in range(1 - self.order, 0):
            _, states[continues] = self.step(states[continues], words[start[continues] + t])
        total = np.zeros(len(row))
        going = np.searchsorted(-length, -np.arange(LANE), "left")
        for t, n in enumerate(going[: length[0]] if len(length) else []):
            weight, states[:n] = self.step(states[:n], words[start[:n] + t])
            total[:n] += weight
        return np.bincount(row, weights=total, minlength=len(rows.n_tokens))


def fold_of(doc_id: Column, folds: int) -> Column:
    """Fold of a document: CRC-32 of its id as text."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def score_documents(
    documents: DataFrame, order: int = ORDER, prior: float = PRIOR, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Log-probabilities of every row of ``documents`` (doc_id, text), learned from those not held out.

    ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``: tokens are
    the words (runs of anything but U+0020 and U+0009-U+000D, A-Z lower-cased) and one
    end mark, so a null, empty or blank text has one token. A document is held out if
    the CRC-32 of its id modulo 5 is 1. ``base_score`` uses single tokens only, ``score``
    is the automaton's, both in base 10. A row without doc_id learns and is not held
    out; repeated rows each count. Other columns are ignored. Documents are worked on in
    blocks of about ``block_bytes`` of text, which does not change the result.
    """
    spark = documents.sparkSession
    held_out = F.coalesce(fold_of(F.col("doc_id"), FOLDS) == HELD_OUT_FOLD, F.lit(False))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    block = sized_block_column(blocks_by_size(rows, "text", block_bytes, _MOST_BLOCKS), "doc_id", "text")
    blocks = rows.select(block.alias("block"), "doc_id", "held_out", "text")

    def short_keys(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        _, grams = _block_grams(table, min(order, 2))
        keys, ascending = _short_keys(grams)
        counts = np.concatenate([g.counts for g in grams])
        return keys[ascending], _numbers(counts[ascending])

    def long_keys(k: int):
        def keys_of(table: pa.Table, told: pa.Table) -> tuple[np.ndarray, np.ndarray]:
            _, grams = _block_grams(table, k)
            _, shared = _known_totals(grams[:-1], block_totals(told))
            asks = _open(grams[-1], grams[-2], shared[-1])
            return grams[-1].keys[asks], _numbers(grams[-1].counts[asks])

        return keys_of

    def score(table: pa.Table, told: pa.Table) -> pa.Table:
        tokens, grams = _block_grams(table, order)
        totals, _ = _known_totals(grams, block_totals(told))
        n, v = told.column("n")[0].as_py(), told.column("v")[0].as_py()
        automaton = BackoffAutomaton(grams, totals, n, v, prior)
        words = grams[0].at
        starts = tokens.first[:-1]
        known, weight = totals[0] > 0, automaton.word_weight.copy()
        of_start = words[starts]
        known[of_start], weight[of_start] = False, 0.0
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "held_out": table.column("held_out"),
                "n_tokens": pa.array(tokens.n_tokens, pa.int64()),
                "n_known": pa.array(np.add.reduceat(known[words].astype(np.int64), starts), pa.int64()),
                "train_tokens": pa.array([n] * len(starts), pa.int64()),
                "base_score": pa.array(np.add.reduceat(weight[words], starts), pa.float64()),
                "score": pa.array(automaton.traverse(tokens, words), pa.float64()),
            }
        )

    asked = requests(blocks, short_keys, 64)
    tokens = key_statistics(asked, lambda keys: keys & _ONE == 0, _totals)
    tokens = tokens.agg(F.sum("sum_totals").alias("n"), F.sum("distinct_keys").alias("v"))
    sums = {c: tokens.select(c).scalar() for c in ("n", "v")}
    told = answers(asked, _answer)
    for k in range(3, order + 1):
        more = answers(further_requests(blocks, told, long_keys(k), 64), _answer)
        # Behind the classes of the shorter n-grams, so that a block reads its answers in the order it asked.
        told = told.union(more.withColumn("class", F.col("class") + (k - 2) * classes_of(spark)))
    return with_answers(blocks, told.withColumns(sums), score, _SCORED)
