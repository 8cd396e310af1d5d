"""Self-join of documents on the Jaccard similarity of their word n-grams.

Rare-first prefix filtering: n-grams are ordered by document frequency, then by
hash, and two documents whose similarity reaches the threshold share an n-gram
within the first few of each. Only n-grams that some other document also has are
kept, so a document without a near copy disappears as soon as frequencies are
known. Prefix entries are joined under a length, a positional and an index-prefix
filter; each remaining pair passes a suffix filter and is verified once.

Documents are first reduced to one per distinct text. Frequent prefix n-grams do
not make all pairs: every document is first paired with a few hubs of each
n-gram, the links found give components, and the second pass only pairs documents
of different components, which no other way could have linked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperlake.llm.blocks import answers, block_column, block_totals, requests, with_answers
from paperlake.llm.components import connected_components
from paperlake.llm.words import Words, sequence_hashes, window_starts
from paperlake.session import materialize

SIZE = 5
PERCENT = 80
# Documents of each prefix n-gram that every other one is paired with first.
HUBS = 4
# N-grams are told apart by 48 bits: a chance match makes a document a candidate, and
# two n-grams of one pair of documents meet by chance once in some 10**9 pairs.
KEY_BITS = 48

_NODE = "h1 long, h2 long, node long, n int, tokens binary"
_TEXTS = "block int, h1 long, h2 long, node long, text string"


def _text_keys() -> list[Column]:
    """128 bits that stand for a text."""
    return [F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), F.col("text")).alias("h2")]


def distinct_texts(documents: DataFrame) -> DataFrame:
    """Each text once per map task, with the smallest doc_id seen, and its block.

    Copies are dropped before the shuffle; what several tasks still send of one
    text meets in the block that the text's hash names.
    """
    spark = documents.sparkSession

    def first_seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int], int] = {}
        for batch in batches:
            keys = zip(batch.column("h1").to_pylist(), batch.column("h2").to_pylist())
            kept = []
            for row, (key, node) in enumerate(zip(keys, batch.column("node").to_pylist())):
                if key not in seen or (node is not None and (seen[key] is None or node < seen[key])):
                    seen[key] = node
                    kept.append(row)
            yield batch.take(pa.array(kept, pa.int64()))

    rows = documents.filter("text <> ''").select(*_text_keys(), F.col("doc_id").cast("long").alias("node"), "text")
    rows = rows.select(block_column(spark, "h1", "h2").alias("block"), "h1", "h2", "node", "text")
    return rows.mapInArrow(first_seen, _TEXTS)


def _one_per_text(table: pa.Table) -> pa.Table:
    """The row with the smallest node of each text."""
    ordered = table.sort_by([("h1", "ascending"), ("h2", "ascending"), ("node", "ascending")])
    h1, h2 = (ordered.column(c).to_numpy() for c in ("h1", "h2"))
    new = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])] if len(h1) else []
    return ordered.filter(pa.array(new, pa.bool_()))


def _shingles(texts: pa.ChunkedArray, size: int) -> list[np.ndarray]:
    """Per text its distinct shingles, ascending."""
    words = Words(texts, lower=True)
    first = words.first
    starts, offsets = window_starts(first, size)
    keys = sequence_hashes(words.hashes, starts, size) >> np.uint64(64 - KEY_BITS)
    whole = sequence_hashes(words.hashes, first[:-1], np.diff(first)) >> np.uint64(64 - KEY_BITS)
    short = np.diff(first) < size
    sets = []
    for row in range(len(words)):
        if short[row]:
            sets.append(whole[row : row + 1] if first[row + 1] > first[row] else whole[:0])
        else:
            sets.append(np.unique(keys[offsets[row] : offsets[row + 1]]))
    return sets


def _needed(n: int, percent: int) -> int:
    """Shared n-grams any partner of a set of ``n`` must have: ``ceil(percent * n / 100)``."""
    return -(-percent * n // 100)


def _pack_tokens(tokens: np.ndarray) -> bytes:
    return np.ascontiguousarray(tokens).view(np.uint8).reshape(-1, 8)[:, : KEY_BITS // 8].tobytes()


def _unpack_tokens(packed: bytes) -> np.ndarray:
    cells = np.zeros((len(packed) * 8 // KEY_BITS, 8), np.uint8)
    cells[:, : KEY_BITS // 8] = np.frombuffer(packed, np.uint8).reshape(-1, KEY_BITS // 8)
    return cells.view(np.uint64).ravel()


def shared_shingles(documents: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """``h1, h2, node, n, tokens`` per distinct text: its set size and its shared n-grams, rarest first.

    ``tokens`` is null where too few n-grams occur in another text for any partner to exist.
    """
    blocks = distinct_texts(documents)

    def keys_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        sets = _shingles(_one_per_text(table).column("text"), size)
        return np.unique(np.concatenate(sets), return_counts=True) if sets else (np.empty(0, np.uint64),) * 2

    def nodes(table: pa.Table, answered: pa.Table) -> pa.Table:
        table = _one_per_text(table)
        sets = _shingles(table.column("text"), size)
        known = np.unique(np.concatenate(sets)) if sets else np.empty(0, np.uint64)
        frequency = block_totals(answered)
        tokens: list[bytes | None] = []
        for keys in sets:
            df = frequency[np.searchsorted(known, keys)]
            keys, df, n = keys[df > 1], df[df > 1], len(keys)
            enough = n > 0 and len(keys) >= _needed(n, percent)
            tokens.append(_pack_tokens(keys[np.lexsort((keys, df))]) if enough else None)
        return pa.table(
            {
                **{c: table.column(c) for c in ("h1", "h2", "node")},
                "n": pa.array([len(s) for s in sets], pa.int32()),
                "tokens": pa.array(tokens, pa.binary()),
            }
        )

    answered = answers(requests(blocks, keys_of, KEY_BITS))
    return with_answers(blocks, answered, nodes, _NODE)


def prefix_entries(nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``token, node, n, pos`` for the shared n-grams among the first ``n - needed + 1`` of each set."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            token, node, size, pos = [], [], [], []
            for i, n, packed in zip(*(batch.column(c).to_pylist() for c in ("node", "n", "tokens"))):
                tokens = _unpack_tokens(packed)
                unique = n - len(tokens)
                kept = max(0, n - _needed(n, percent) + 1 - unique)
                token.append(tokens[:kept].astype(np.int64))
                node.append(np.full(kept, i))
                size.append(np.full(kept, n, np.int32))
                pos.append(np.arange(unique, unique + kept, dtype=np.int32))
            if token:
                columns = [np.concatenate(c) for c in (token, node, size, pos)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "node", "n", "pos"])

    return nodes.select("node", "n", "tokens").mapInArrow(entries, "token long, node long, n int, pos int")


def _may_link(x: str, y: str, percent: int) -> Column:
    """Length, index-prefix and positional filter for two entries of one n-gram.

    ``overlap`` is what the pair must share. The smaller set is indexed by its
    first ``n - overlap with an equal partner + 1`` n-grams only. A pair passes at
    the first n-gram both prefixes share if it can link at all.
    """

    def small(c: str) -> str:
        return f"if({x}.n < {y}.n or ({x}.n = {y}.n and {x}.node < {y}.node), {x}.{c}, {y}.{c})"

    overlap = f"ceil({percent} * ({x}.n + {y}.n) / {100 + percent})"
    return F.expr(
        f"""{x}.node <> {y}.node
        and 100 * least({x}.n, {y}.n) >= {percent} * greatest({x}.n, {y}.n)
        and {small('pos')} <= {small('n')} - ceil(2 * {percent} * {small('n')} / {100 + percent})
        and least({x}.n - {x}.pos, {y}.n - {y}.pos) >= {overlap}"""
    )


def _pairs(x: DataFrame, y: DataFrame, percent: int, extra: str = "true") -> DataFrame:
    met = x.alias("x").join(y.alias("y"), F.expr("x.token = y.token") & _may_link("x", "y", percent) & F.expr(extra))
    return met.select(F.expr("least(x.node, y.node) as a"), F.expr("greatest(x.node, y.node) as b")).distinct()


def verify(pairs: DataFrame, nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs ``a, b`` that reach the threshold.

    N-grams that only one text has cannot be shared, so the shared ones decide
    exactly. The suffix filter counts both sides' n-grams in 16 ranges of the hash;
    the differences bound the overlap from above before any set is intersected.
    """
    held = nodes.select("node", "n", "tokens").filter("tokens is not null")
    met = pairs.join(held.toDF("a", "n_a", "tokens_a"), "a").join(held.toDF("b", "n_b", "tokens_b"), "b")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            columns = (batch.column(c).to_pylist() for c in ("n_a", "tokens_a", "n_b", "tokens_b"))
            for n_a, packed_a, n_b, packed_b in zip(*columns):
                a, b = _unpack_tokens(packed_a), _unpack_tokens(packed_b)
                needed = -(-percent * (n_a + n_b) // (100 + percent))
                ranges = [np.bincount((t >> np.uint64(KEY_BITS - 4)).astype(int), minlength=16) for t in (a, b)]
                shared = 0
                if np.minimum(*ranges).sum() >= needed:
                    shared = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * shared >= percent * (n_a + n_b - shared))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return met.mapInArrow(linked, "a long, b long")


def linked_components(nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``node, component`` of every node that links with another."""
    eligible = nodes.filter("tokens is not null and node is not null")
    entries = materialize(prefix_entries(eligible, percent), "prefix-entries")
    central = Window.partitionBy("token").orderBy(F.col("pos") / F.col("n"), "node")
    hubs = entries.withColumn("rank", F.row_number().over(central)).filter(F.col("rank") <= HUBS).drop("rank")
    tested = materialize(_pairs(hubs, entries, percent), "hub-pairs")
    links = materialize(verify(tested, nodes, percent), "hub-links")
    found = materialize(connected_components(links), "hub-components")

    # What is left: pairs across components. One of the two is outside the n-gram's largest component.
    placed = entries.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    sizes = placed.groupBy("token", "component").agg(F.count("*").alias("members"))
    largest = sizes.groupBy("token").agg(
        F.max_by("component", F.struct("members", "component")).alias("largest"), F.count("*").alias("parts")
    )
    mixed = placed.join(largest.filter("parts > 1"), "token")
    outside = mixed.filter("component <> largest")
    more = _pairs(outside, mixed, percent, "x.component <> y.component")
    more = verify(more.join(tested, ["a", "b"], "left_anti"), nodes, percent)
    return connected_components(links.unionByName(more))


def near_duplicates(documents: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``documents`` (doc_id, text).

    Words are runs of anything but U+0020 and U+0009-U+000D, after lower-casing A-Z;
    a set holds the distinct ``size``-word n-grams of the whole text, or the whole
    sequence if it is shorter. Null, empty and blank texts have no n-grams and link
    with nothing. Texts link when ``100 * shared >= percent * union``; equal texts
    always do. ``component_id`` is the smallest doc_id reachable by links. Rows with
    one doc_id are one document with several texts; a row without doc_id gets its
    ``n_shingles`` and a null component. Other columns are ignored.
    """
    nodes = materialize(shared_shingles(documents, size, percent), "shingle-sets")
    found = linked_components(nodes, percent)
    texts = nodes.select("h1", "h2", "node", "n").join(found, "node", "left")
    texts = texts.select("h1", "h2", "n", F.coalesce("component", "node").alias("component"))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), *_text_keys())
    return rows.join(texts, ["h1", "h2"], "left").select(
        "doc_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_shingles"),
        # Without n-grams a text links with nothing, its own copies included.
        F.when(F.col("doc_id").isNull(), None)
        .when(F.col("n") > 0, F.col("component"))
        .otherwise(F.col("doc_id"))
        .alias("component_id"),
    )


def one_per_group(documents: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``documents`` that stay: of each linked group the document with the smallest doc_id.

    All columns are kept. Of rows that share that doc_id one stays, by hash of the text. Rows without doc_id all
    stay, as nothing could name them.
    """
    found = near_duplicates(documents, size, percent).filter("doc_id = component_id").select("doc_id").distinct()
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct("*").alias("_row"))
    kept = rows.filter("doc_id is not null").join(found, "doc_id", "left_semi")
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("_row.text"))
    kept = kept.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1")
    return kept.select("_row.*").unionByName(documents.filter("doc_id is null"))
