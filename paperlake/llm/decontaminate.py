"""Finding benchmark passages in documents by latent semantic retrieval.

Documents are cut into overlapping passages of words. Their TF-IDF vectors over
hashed words span a space whose main directions come from a randomised SVD: every
passage adds its share to the product of the Gram matrix with a random matrix, the
tables of all tasks are summed, and a small factorisation gives the singular vectors
(the Nystroem form, which needs one pass). Passages and benchmark items are compared
by cosine in that space; what comes near shares enough idf weight, and is then
decided by the longest common subsequence of the words around the match and by
whether the item's answer, its last words, is there too. Paraphrases keep most words in
order, chance does not.

Items longer than two passages are cut into parts of a passage's length, and each part
is searched: a passage cannot hold much of a long item. Items of few words say too
little for that and are looked up as they are. In scripts without blanks every
character counts as a word.

Statistics and singular vectors cover all passages. Their tables have a fixed size,
whatever the corpus. Items are shipped in blocks of limited number and text, one pass
over the documents each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperlake.llm.slices import text_slices
from paperlake.llm.words import Words, sequence_hashes, text_bytes, window_starts
from paperlake.session import materialize

PASSAGE, STRIDE = 32, 16
FEATURE_BITS = 13
RANK, OVERSAMPLING = 96, 64
# Cosines of unrelated passages spread by about 1 / sqrt(RANK); a passage that holds a
# whole item of half its length has 0.7.
MIN_COSINE = 0.22
# Longer items are searched by parts of ``PASSAGE`` words.
MAX_WHOLE = 2 * PASSAGE
# Share of the idf weight of an item (or part) that the passage must have too. A passage
# inside an item twice its length has half of it.
MIN_SHARED = 0.3
# Longest common subsequence as a share of the item: alone, or if the answer is found as well.
MIN_LCS, MIN_LCS_WITH_ANSWER = 0.7, 0.6
ANSWER_WORDS = 5
# Shorter items cannot be told from chance by a part of their words; they are found whole only.
MIN_ITEM_WORDS = 8
# With fewer different words (as many as the sum of weights over their mean) in a table, what its
# passages have in common is all they have.
MIN_COMMON_WORDS = 256
ITEMS_PER_BLOCK = 1000
# Characters after which a block ends too; it has a row of features for each part of an item.
BLOCK_CHARS = 1 << 19

_FEATURES = 1 << FEATURE_BITS
_PIECE_BYTES = 1 << 20
# Cuts of a table of sums, and parts of the tasks whose tables are added up apart first.
_SLICES, _PARTS = 32, 64
_PASSAGES_AT_ONCE = 1024
_LEAK = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("lcs_words", T.IntegerType()),
        T.StructField("item_words", T.IntegerType()),
        T.StructField("answer_found", T.BooleanType()),
        T.StructField("word", T.IntegerType()),
    ]
)


# First bytes of characters that may be of a script without blanks; those of Latin, Greek, Cyrillic,
# Hebrew and Arabic letters and of common signs are others.
_MAYBE_UNSPACED = np.zeros(256, dtype=bool)
_MAYBE_UNSPACED[[0xE0, 0xE1, *range(0xE3, 0xEA), 0xEF, 0xF0]] = True
_WIDE_PUNCTUATION = r"[\x{3000}-\x{3004}\x{3008}-\x{3020}\x{3030}\x{FF01}-\x{FF0F}\x{FF1A}-\x{FF20}\x{FF3B}-\x{FF40}\x{FF5B}-\x{FF65}]"
_UNSPACED = r"([\p{Han}\p{Hiragana}\p{Katakana}\x{30FC}\x{FF70}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])"


def _apart(texts: pa.Array) -> pa.Array:
    """The texts with blanks around each character of a script without blanks."""
    data, offsets = text_bytes(texts)
    hits = np.flatnonzero(_MAYBE_UNSPACED[data])
    if not len(hits):
        return texts
    mask = np.zeros(len(texts), dtype=bool)
    mask[np.searchsorted(offsets, hits, "right") - 1] = True
    some = pc.replace_substring_regex(texts.filter(pa.array(mask)), _WIDE_PUNCTUATION, " ")
    return pc.replace_with_mask(texts, pa.array(mask), pc.replace_substring_regex(some, _UNSPACED, r" \1 "))


def _words(texts: pa.Array) -> Words:
    """Words in lower case of any script, without punctuation around them."""
    return Words(pc.utf8_lower(_apart(texts)), lower=True, trim=True)


def _said(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, hashes and first word per row of the words that are more than punctuation."""
    places = np.flatnonzero(words.ends > words.starts)
    return places, words.hashes[places], np.searchsorted(places, words.first)


def _features(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


def _pieces(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Slices of about ``_PIECE_BYTES`` of text, with the row each starts at."""
    _, offsets = text_bytes(texts)
    cells = offsets[:-1] // _PIECE_BYTES
    edges = [*np.flatnonzero(np.diff(cells, prepend=-1)), len(texts)] if len(texts) else []
    for start, end in zip(edges, edges[1:]):
        yield start, texts.slice(start, end - start)


def _passages(first: np.ndarray, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word and end of the row's words for each passage; a passage may be cut by its row's end."""
    lengths = np.diff(first)
    counts = np.where(lengths > 0, 1 + -(-np.maximum(lengths - PASSAGE, 0) // stride), 0)
    row = np.repeat(np.arange(len(lengths)), counts)
    number = np.arange(len(row)) - np.repeat(np.r_[0, np.cumsum(counts)[:-1]], counts)
    return row, first[row] + number * stride, first[row + 1]


def _cells(features: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """Features of ``width`` words from each start; places beyond the end have the feature after the last."""
    at = starts[:, None] + np.arange(width)
    inside = at < ends[:, None]
    return np.where(inside, features[np.minimum(at, max(len(features) - 1, 0))], _FEATURES)


def _stored_features(documents: DataFrame) -> DataFrame:
    """``features`` of each text's words in order, two bytes each, written to the shared folder.

    The statistics read these, so texts are cut into words once for all of them.
    """

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in _pieces(batch.column("text")):
                words = _words(texts)
                data = _features(words.hashes).astype("<u2").tobytes()
                offsets = (2 * words.first).astype(np.int32).tobytes()
                column = pa.Array.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays([column], ["features"])

    return materialize(documents.select("text").mapInArrow(number, "features binary"), "word-features")


def _feature_lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All features, and the first of each row."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = np.frombuffer(data, "<u2") if data is not None else np.empty(0, "<u2")
    return held[at[0] // 2 : at[-1] // 2].astype(np.int64), (at - at[0]) // 2


def _summed(stored: DataFrame, add, width: int) -> np.ndarray:
    """The sum over all tasks of the table of ``_FEATURES + 1`` rows that ``add(features, first, table)`` fills.

    Tables are cut into slices and added up in parts of the tasks first, then over the
    parts, so no task adds up what all others made.
    """
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((_FEATURES + 1, width))
        for batch in batches:
            for part in text_slices(batch, "features", _PIECE_BYTES // 2):
                add(*_feature_lists(part.column("features")), table)
        cells = [p.tobytes() for p in np.array_split(table.astype(np.float32) if width > 1 else table, _SLICES)]
        yield pa.RecordBatch.from_pydict({"slice": pa.array(range(_SLICES), pa.int32()), "cells": pa.array(cells, pa.binary())})

    def total(group: pa.Table) -> pa.Table:
        cells = sum(np.frombuffer(c.as_buffer(), np.float32).astype(np.float64) for c in group.column("cells"))
        return _one_slice(group, cells.astype(np.float32))

    def total_counts(group: pa.Table) -> pa.Table:
        return _one_slice(group, sum(np.frombuffer(c.as_buffer(), np.float64) for c in group.column("cells")))

    add_up = total if width > 1 else total_counts
    schema = "slice int, cells binary"
    made = stored.mapInArrow(fill, schema).withColumn("part", F.spark_partition_id() % _PARTS)
    some = made.groupBy("slice", "part").applyInArrow(add_up, schema)
    rows = some.groupBy("slice").applyInArrow(add_up, schema).collect()
    kind = np.float32 if width > 1 else np.float64
    parts = [np.frombuffer(r["cells"], kind) for r in sorted(rows)]
    return np.concatenate(parts).astype(np.float64).reshape(-1, width) if parts else np.zeros((_FEATURES + 1, width))


def _one_slice(group: pa.Table, cells: np.ndarray) -> pa.Table:
    return pa.table({"slice": group.column("slice").slice(0, 1), "cells": pa.array([cells.tobytes()], pa.binary())})


def _count_passages(features: np.ndarray, first: np.ndarray, table: np.ndarray) -> None:
    """Adds to each feature the passages that have it; the extra row counts passages."""
    _, starts, ends = _passages(first, PASSAGE)
    cells = np.sort(_cells(features, starts, ends, PASSAGE), axis=1)
    new = np.ones_like(cells, dtype=bool)
    new[:, 1:] = cells[:, 1:] != cells[:, :-1]
    found = cells[new & (cells < _FEATURES)]
    table[:, 0] += np.bincount(found, minlength=_FEATURES + 1)
    table[_FEATURES, 0] += len(starts)


def _sparse_test(columns: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """A random test matrix with one entry per feature: its column and its sign."""
    rng = np.random.default_rng(seed)
    column = rng.integers(0, columns, _FEATURES + 1)
    sign = rng.choice([-1.0, 1.0], _FEATURES + 1)
    sign[_FEATURES] = 0.0
    return column, sign


def _gram_step(
    features: np.ndarray, first: np.ndarray, table: np.ndarray, idf: np.ndarray, column: np.ndarray, sign: np.ndarray
) -> None:
    """Adds ``a (a' test)`` for the TF-IDF vector ``a``, of unit length, of each passage.

    The test matrix has one entry per feature, so the product is a sum over the pairs
    of words of a passage.
    """
    _, all_starts, all_ends = _passages(first, PASSAGE)
    width = table.shape[1]
    for at in range(0, len(all_starts), _PASSAGES_AT_ONCE):
        part = slice(at, at + _PASSAGES_AT_ONCE)
        cells = _cells(features, all_starts[part], all_ends[part], PASSAGE)
        weights = idf[cells]
        unit = weights / np.maximum((weights**2).sum(axis=1, keepdims=True), 1e-9)
        pairs = (cells * width)[:, :, None] + column[cells][:, None, :]
        products = unit[:, :, None] * (weights * sign[cells])[:, None, :]
        table += np.bincount(pairs.ravel(), products.ravel(), minlength=table.size).reshape(table.shape)


def _directions(sketch: np.ndarray, test: np.ndarray, rank: int) -> np.ndarray:
    """Main right singular vectors, each over its singular value, from ``sketch = G test`` with the Gram matrix G.

    Without the division the few directions that tell languages and common words
    apart would decide every cosine.
    """
    shift = 1e-7 * max(np.linalg.norm(sketch), 1e-30)
    moved = sketch + shift * test
    core = test.T @ moved
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    inverse_root = vectors / np.sqrt(np.maximum(values, shift))
    left, roots, _ = np.linalg.svd(moved @ inverse_root, full_matrices=False)
    return left[:, :rank] / np.maximum(roots[:rank], 1e-12)


@dataclass
class LatentSpace:
    """idf of every feature, and its place in the latent space times that; the extra feature has none."""

    idf: np.ndarray
    places: np.ndarray

    @classmethod
    def fit(cls, documents: DataFrame, rank: int = RANK, seed: int = 5) -> LatentSpace:
        """From all passages of all documents, in two passes over the features of their words."""
        stored = _stored_features(documents)
        counts = _summed(stored, _count_passages, 1)[:, 0]
        # Above 0 also for a word that all passages have.
        idf = np.log((2 + counts[_FEATURES]) / (1 + counts))
        idf[_FEATURES] = 0.0
        columns = rank + OVERSAMPLING
        column, sign = _sparse_test(columns, seed)
        test = np.zeros((_FEATURES, columns))
        test[np.arange(_FEATURES), column[:-1]] = sign[:-1]

        def add(features: np.ndarray, first: np.ndarray, table: np.ndarray) -> None:
            _gram_step(features, first, table, idf, column, sign)

        sketch = _summed(stored, add, columns)[:_FEATURES]
        vectors = _directions(sketch, test, rank)
        # Direction from the singular vectors, length from the idf: no word outweighs a passage.
        # What all passages have in common is taken off, unless that is nearly all there is.
        weights = (counts * idf)[:_FEATURES, None]
        units = _unit(vectors)
        if weights.sum() ** 2 >= MIN_COMMON_WORDS * (weights**2).sum():
            units = units - (weights * units).sum(axis=0) / max(weights.sum(), 1e-12)
        places = np.vstack([units, np.zeros((1, rank))]) * idf[:, None]
        return cls(idf, places.astype(np.float32))


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def lcs_length(masks: dict[int, int], size: int, words: Sequence[int]) -> int:
    """Longest common subsequence of an item, given as bit masks of its words' places, and a word list."""
    full = (1 << size) - 1
    left = full
    for word in words:
        mask = masks.get(word)
        if mask:
            met = left & mask
            left = ((left + met) | (left - met)) & full
    return size - left.bit_count()


def _masks(words: Sequence[int]) -> dict[int, int]:
    masks: dict[int, int] = {}
    for place, word in enumerate(words):
        masks[word] = masks.get(word, 0) | (1 << place)
    return masks


def _parts(size: int) -> list[slice]:
    """The parts of an item that are searched; together they have all its words."""
    if size <= MAX_WHOLE:
        return [slice(0, size)]
    return [slice(s, s + PASSAGE) for s in [*range(0, size - PASSAGE, PASSAGE), size - PASSAGE]]


class Items:
    """A block of benchmark items, ready to be compared with passages.

    ``units``, ``present`` and ``totals`` have a row per part, ``owner`` is the part's item.
    """

    def __init__(self, rows: Sequence[tuple[int, str]], space: LatentSpace):
        words = _words(pa.array([t for _, t in rows], pa.string()))
        keep = [r for r in range(len(rows)) if words.first[r + 1] - words.first[r] >= MIN_ITEM_WORDS]
        _, hashes, first = _said(words)
        # By number of words: the sequences' numbers in order, and the item of each.
        self.short: dict[int, tuple[np.ndarray, list[int]]] = {}
        rest = np.array(sorted(set(range(len(rows))) - set(keep)), np.int64)
        for size in range(1, MIN_ITEM_WORDS):
            few = rest[first[rest + 1] - first[rest] == size]
            if len(few):
                whole = sequence_hashes(hashes, first[few], size)
                order = np.argsort(whole, kind="stable")
                self.short[size] = whole[order], [rows[r][0] for r in few[order]]
        self.ids = [rows[r][0] for r in keep]
        self.words = [words.hashes[words.row(r)].tolist() for r in keep]
        features, owner = [], []
        for i, r in enumerate(keep):
            whole = _features(words.hashes[words.row(r)])
            features += [whole[part] for part in _parts(len(whole))]
            owner += [i] * (len(features) - len(owner))
        self.owner = np.array(owner, np.int64)
        places = [space.places[f].sum(axis=0) for f in features]
        self.units = _unit(np.array(places).reshape(len(owner), space.places.shape[1])).astype(np.float32)
        self.present = np.zeros((len(owner), _FEATURES + 1), bool)
        for i, f in enumerate(features):
            self.present[i, f] = True
        self.masks = [_masks(w) for w in self.words]
        self.counts = [Counter(w) for w in self.words]
        self.totals = np.array([space.idf[np.unique(f)].sum() for f in features])
        self.answers = [(_masks(w[-ANSWER_WORDS:]), len(w[-ANSWER_WORDS:])) for w in self.words]

    def decide(self, item: int, words: np.ndarray, near: int) -> tuple[int, bool] | None:
        """Common words and whether the answer is found, if the item occurs around place ``near``.

        Every window of the item's length and a little more that meets the passage is
        compared, in steps that leave room around each occurrence. What the windows lie
        in bounds them from above, by its different words and then by its own subsequence.
        """
        size, masks = len(self.words[item]), self.masks[item]
        slack = 2 + size // 8
        width, step = size + 2 * slack, max(1, slack // 2)
        around = words[max(0, near - width) : near + PASSAGE + width].tolist()
        least = MIN_LCS_WITH_ANSWER * size
        counts = self.counts[item]
        if sum([counts[word] for word in counts.keys() & set(around)]) < least or lcs_length(masks, size, around) < least:
            return None
        best = None
        answer_masks, answer_size = self.answers[item]
        for start in range(0, max(0, len(around) - width) + step, step):
            region = around[start : start + width]
            common = lcs_length(masks, size, region)
            if common >= least:
                tail = region[-(answer_size + 2 * slack) :]
                found = lcs_length(answer_masks, answer_size, tail) >= answer_size - 1
                if common >= MIN_LCS * size or found:
                    best = max(best or (0, False), (common, found))
        return best


def _leak(item_id: int, common: int, size: int, answer: bool, place: int) -> dict:
    return {"item_id": item_id, "lcs_words": common, "item_words": size, "answer_found": answer, "word": place}


def _short_leaks(words: Words, items: Items) -> list[list[dict]]:
    """Per text the short items found in it, at their first place: all windows are looked up."""
    out: list[list[dict]] = [[] for _ in range(len(words))]
    places, hashes, first = _said(words) if items.short else (None, None, None)
    for size, (wholes, ids) in items.short.items():
        starts, offsets = window_starts(first, size)
        seen = sequence_hashes(hashes, starts, size)
        left = np.searchsorted(wholes, seen, "left")
        hits = np.flatnonzero(wholes[np.minimum(left, len(wholes) - 1)] == seen)
        rows = np.searchsorted(offsets, hits, "right") - 1
        _, new = np.unique(rows * len(wholes) + left[hits], return_index=True)
        for hit, row in zip(hits[new].tolist(), rows[new].tolist()):
            at = int(places[starts[hit]] - words.first[row])
            for i in range(left[hit], np.searchsorted(wholes, seen[hit], "right")):
                out[row].append(_leak(ids[i], size, size, True, at))
    return out


def _leaks(texts: pa.Array, items: Items, space: LatentSpace) -> list[list[dict]]:
    """Per text the items found in it."""
    words = _words(texts)
    features = _features(words.hashes)
    found: list[dict[int, tuple]] = [{} for _ in range(len(words))]
    rows, starts, ends = _passages(words.first, STRIDE)
    for at in range(0, len(starts) if items.ids else 0, _PASSAGES_AT_ONCE):
        part = slice(at, at + _PASSAGES_AT_ONCE)
        cells = _cells(features, starts[part], ends[part], PASSAGE)
        # Passages overlap by half, so the sums of half passages are used twice.
        halves, index = np.unique(np.r_[starts[part], starts[part] + STRIDE], return_inverse=True)
        sums = np.empty((len(halves), space.places.shape[1]), np.float32)
        n = len(cells)
        sums[index[:n]] = np.take(space.places, cells[:, :STRIDE], axis=0, mode="clip").sum(axis=1)
        last = np.r_[starts[part][1:] != starts[part][:-1] + STRIDE, True]
        sums[index[n:][last]] = np.take(space.places, cells[last, STRIDE:], axis=0, mode="clip").sum(axis=1)
        units = _unit(sums[index[:n]] + sums[index[n:]])
        passage, probe = np.nonzero(units @ items.units.T >= MIN_COSINE)
        once = np.sort(cells, axis=1)
        once[:, 1:][once[:, 1:] == once[:, :-1]] = _FEATURES
        present = np.take(items.present, probe[:, None] * (_FEATURES + 1) + once[passage], mode="clip")
        shared = (present * space.idf[once][passage]).sum(axis=1)
        passed = shared >= MIN_SHARED * items.totals[probe]
        # Several parts of an item may be near one passage.
        pairs = np.unique(passage[passed] * len(items.ids) + items.owner[probe[passed]])
        for p, i in zip((pairs // len(items.ids)).tolist(), (pairs % len(items.ids)).tolist()):
            row = rows[at + p]
            begin = words.first[row]
            if found[row].get(i, ((0, False), 0))[0] == (len(items.words[i]), True):
                continue
            decided = items.decide(i, words.hashes[begin : words.first[row + 1]], int(starts[at + p] - begin))
            if decided and decided > found[row].get(i, ((0, False), 0))[0]:
                found[row][i] = (decided, int(starts[at + p] - begin))
    short = _short_leaks(words, items)
    return [
        [_leak(items.ids[i], common, len(items.words[i]), answer, place) for i, ((common, answer), place) in sorted(row.items())]
        + short[r]
        for r, row in enumerate(found)
    ]


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items with a text, in blocks of ``ITEMS_PER_BLOCK`` or ``BLOCK_CHARS``; only one block is held at a time."""
    rows = benchmark.filter("item_id is not null and text is not null")
    block: list[tuple[int, str]] = []
    chars = 0
    for row in rows.select(F.col("item_id").cast("long"), "text").distinct().toLocalIterator():
        block.append((row[0], row[1]))
        chars += len(row[1])
        if len(block) == ITEMS_PER_BLOCK or chars >= BLOCK_CHARS:
            yield sorted(block)
            block, chars = [], 0
    if block:
        yield sorted(block)


def with_leaks(documents: DataFrame, block: Sequence[tuple[int, str]], space: LatentSpace) -> DataFrame:
    """``_row`` (all columns of ``documents`` as a struct) and ``_leaks``: the block's items found in its text. No shuffle."""
    rows = documents.select(F.struct("*").alias("_row"))
    items = Items(block, space)
    kinds = {"item_id": pa.int64(), "answer_found": pa.bool_()}
    kind = pa.list_(pa.struct([(f.name, kinds.get(f.name, pa.int32())) for f in _LEAK]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaks: list[list[dict]] = []
            for _, texts in _pieces(batch.column("_row").field("text")):
                leaks += _leaks(texts, items, space)
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(leaks, kind)], ["_row", "_leaks"])

    return rows.mapInArrow(search, T.StructType([rows.schema["_row"], T.StructField("_leaks", T.ArrayType(_LEAK))]))


def find_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, lcs_words, item_words, answer_found, word``: the items that documents contain.

    Words are runs without blanks, in lower case, without punctuation around them, and
    single characters of scripts without blanks.
    ``lcs_words`` of the item's ``item_words`` occur in order near ``word`` (the first
    word of the passage found). A pair is reported if they reach ``MIN_LCS``, or
    ``MIN_LCS_WITH_ANSWER`` with all but one of the item's last words. Null and empty
    texts contain nothing; items without id or text are not searched; items of fewer
    than ``MIN_ITEM_WORDS`` words are found where all their words follow each other, words
    of punctuation only left out; items with one id and different texts are searched each. Repeated documents are reported each; extra columns are ignored.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    space = LatentSpace.fit(rows)
    found = None
    for block in item_blocks(benchmark):
        part = with_leaks(rows, block, space).select("_row.doc_id", F.explode("_leaks").alias("leak"))
        found = part if found is None else found.unionByName(part)
    if found is None:
        return documents.sparkSession.createDataFrame([], T.StructType([rows.schema["doc_id"], *_LEAK]))
    return found.select("doc_id", "leak.*")


def without_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` whose text contains no item, all columns kept."""
    space = LatentSpace.fit(documents)
    rows = documents
    for block in item_blocks(benchmark):
        rows = with_leaks(rows, block, space).filter(F.size("_leaks") == 0).select("_row.*")
    return rows
