"""Removal of word sequences that also occur elsewhere, by fixed-block anchors.

Reference blocks are the non-overlapping runs of ``(window + 1) // 2`` words of
every document; any window contains a whole one. Every rolling run of that many
words is looked up among them. A window around a hit is then extended to its full
length and counted over the corpus; consecutive windows that occur elsewhere make
up a maximal exact repeat. Blocks only choose which windows are worth counting, so
the result does not depend on where they start.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperlake.llm.blocks import (
    answers,
    block_column,
    block_keys,
    block_totals,
    chosen_keys,
    further_requests,
    requests,
    with_answers,
)
from paperlake.llm.words import Words, sequence_hashes, window_starts

WINDOW = 35
# A chance match of two 48-bit anchors only makes a window a candidate.
ANCHOR_BITS = 48

_KEPT = "doc_id long, n_words long, n_removed long, kept string"
# Occurrences in the low half of a number, reference blocks in the high half.
_HALF = np.uint64(32)


def _anchors(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all rolling runs of anchor length, where each starts, and whether it is a reference block.

    Rows too short for a window have none.
    """
    size = (window + 1) // 2
    starts, offsets = window_starts(words.first, size)
    row = np.repeat(np.arange(len(words)), np.diff(offsets))
    long_enough = np.diff(words.first)[row] >= window
    starts, row = starts[long_enough], row[long_enough]
    keys = sequence_hashes(words.hashes, starts, size) >> np.uint64(64 - ANCHOR_BITS)
    return keys, starts, (starts - words.first[row]) % size == 0


def _anchor_keys(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    keys, _, reference = _anchors(words, window)
    distinct, at, counts = np.unique(keys, return_inverse=True, return_counts=True)
    referenced = np.bincount(at, weights=reference, minlength=len(distinct)) > 0
    return distinct, np.minimum(counts, 2).astype(np.uint64) + (referenced.astype(np.uint64) << _HALF)


def _is_hit(totals: np.ndarray) -> np.ndarray:
    """A run that is a reference block somewhere and occurs more than once."""
    return ((totals & np.uint64(0xFFFFFFFF)) >= 2) & ((totals >> _HALF) > 0)


def _candidate_keys(words: Words, hits: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of the windows that contain a hit, and how often each occurs here (2: more than once)."""
    keys, anchor_starts, _ = _anchors(words, window)
    known = np.unique(keys)
    hit_at = np.zeros(len(words.hashes) + 1, np.int64)
    hit_at[anchor_starts + 1] = hits[np.searchsorted(known, keys)]
    hit_sums = np.cumsum(hit_at)
    starts, _ = window_starts(words.first, window)
    last = starts + window - (window + 1) // 2
    starts = starts[hit_sums[last + 1] > hit_sums[starts]]
    distinct, counts = np.unique(sequence_hashes(words.hashes, starts, window), return_counts=True)
    return distinct, np.minimum(counts, 2).astype(np.uint64)


def _kept_texts(words: Words, repeated: np.ndarray, window: int) -> tuple[np.ndarray, pa.Array]:
    """Words left per row, and the words left, joined by one space."""
    starts, _ = window_starts(words.first, window)
    keys = sequence_hashes(words.hashes, starts, window)
    found = np.zeros(len(keys), bool)
    if len(repeated):
        at = np.minimum(np.searchsorted(repeated, keys), len(repeated) - 1)
        found = repeated[at] == keys
    steps = np.zeros(len(words.hashes) + 1, np.int64)
    np.add.at(steps, starts[found], 1)
    np.add.at(steps, starts[found] + window, -1)
    kept = np.flatnonzero(np.cumsum(steps)[:-1] == 0)

    # A kept word takes the blank behind it along, unless it is its row's last.
    row = np.searchsorted(words.first, kept, "right") - 1
    last = np.r_[row[1:] != row[:-1], True] if len(kept) else np.empty(0, bool)
    data = np.append(words.data, np.uint8(0x20))
    data[words.ends[kept[~last]]] = 0x20
    edges = np.zeros(len(data) + 1, np.int8)
    np.add.at(edges, words.starts[kept], 1)
    np.add.at(edges, words.ends[kept] + ~last, -1)
    mask = np.cumsum(edges[:-1], dtype=np.int8).astype(bool)
    offsets = np.r_[0, np.cumsum(mask)][words.offsets]
    texts = pa.LargeStringArray.from_buffers(
        len(words), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[mask])
    )
    return np.bincount(row, minlength=len(words)), texts


def remove_repeats(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` for every row of ``documents`` (doc_id, text).

    Words are runs of anything but U+0020 and U+0009-U+000D, unchanged. Every word
    covered by ``window`` consecutive words that also start anywhere else, in the
    same document or another, is removed; windows are judged on the input. ``kept``
    has the other words joined by one space. Null, empty and blank texts have no
    words and keep an empty string. A row counts as a place of its own, whatever its
    doc_id: repeated rows remove each other's windows, and a null doc_id is carried
    through. Other columns are ignored. Documents are dealt by hash of id and text,
    texts are shuffled once and used three times, and a window that a third of the
    corpus shares reaches its counter once per block.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks = rows.select(block_column(spark, "doc_id", "text").alias("block"), "doc_id", "text")

    def anchor_keys(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        return _anchor_keys(Words(table.column("text"), lower=False), window)

    def candidate_keys(table: pa.Table, told: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        return _candidate_keys(Words(table.column("text"), lower=False), block_totals(told), window)

    def kept(table: pa.Table, told: pa.Table) -> pa.Table:
        words = Words(table.column("text"), lower=False)
        n_kept, texts = _kept_texts(words, block_keys(told), window)
        n_words = np.diff(words.first)
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "n_words": pa.array(n_words, pa.int64()),
                "n_removed": pa.array(n_words - n_kept, pa.int64()),
                "kept": texts.cast(pa.string()),
            }
        )

    hits = answers(requests(blocks, anchor_keys, ANCHOR_BITS), _is_hit)
    repeated = chosen_keys(further_requests(blocks, hits, candidate_keys, 64), lambda totals: totals >= 2)
    return with_answers(blocks, repeated, kept, _KEPT)
