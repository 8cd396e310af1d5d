"""Language identification with a byte convolutional network.

Bytes are embedded, filters of several widths slide over them, each filter's
largest response in a window is kept, and a softmax over those says the language.
The network is trained in numpy on the driver, on a bounded sample of labelled
documents (``PER_LANGUAGE`` documents per language, two slices each), and applied in
the tasks to all fixed-length windows of every whole text. A document's probabilities
are the means of its windows', weighted by their bytes.

Applying a filter is a sum of table rows, because a byte has only 256 values:
responses of neighbouring byte pairs are worked out once per pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperlake.llm.lm import fold_of
from paperlake.llm.words import text_bytes

FOLDS = 4
HELD_OUT_FOLD = 2
# Sample bound: labelled documents per language. Each gives two slices of SLICE_CHARS.
PER_LANGUAGE = 400
SLICE_CHARS = 256
SAMPLE_GROUPS = 64
WINDOW = 256
WIDTHS = (2, 4)
UNDETERMINED = "und"
# Below this mean probability a document is rejected: no more than a guess among a few languages.
LEAST_SCORE = 0.3

_EMBEDDING, _FILTERS, _EPOCHS, _BATCH, _RATE = 8, 16, 25, 64, 0.006
# Bytes of text whose windows are worked on at once; responses take 64 times as much.
_PIECE_BYTES = 1 << 19


def windows_of(data: np.ndarray, offsets: np.ndarray, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes as zero-padded rows of ``size``, with the text and the byte count of each row."""
    lengths = np.diff(offsets)
    counts = -(-lengths // size)
    first = np.r_[0, np.cumsum(counts)]
    cells = np.zeros(first[-1] * size, np.uint8)
    cells[np.arange(offsets[-1]) + np.repeat(first[:-1] * size - offsets[:-1], lengths)] = data
    row = np.repeat(np.arange(len(lengths)), counts)
    filled = np.minimum(size, lengths[row] - (np.arange(first[-1]) - first[row]) * size)
    return cells.reshape(-1, size), row, filled


def window_pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Text, byte count and bytes of the windows of all texts, some at a time; a long text spans several pieces."""
    counts = -(-np.diff(offsets) // WINDOW)
    row = np.repeat(np.arange(len(counts)), counts)
    starts = offsets[row] + (np.arange(len(row)) - np.repeat(np.r_[0, np.cumsum(counts)[:-1]], counts)) * WINDOW
    ends = np.minimum(starts + WINDOW, offsets[row + 1])
    step = _PIECE_BYTES // WINDOW
    for at in range(0, len(row), step):
        start, end = starts[at : at + step], ends[at : at + step]
        cells, _, filled = windows_of(data[start[0] : end[-1]], np.r_[start, end[-1]] - start[0])
        yield row[at : at + step], filled, cells


@dataclass
class ByteNetwork:
    """Weights: byte embedding, one filter bank per width, output layer."""

    languages: list[str]
    embedding: np.ndarray
    banks: list[np.ndarray]  # (width, embedding, filters) each
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def untrained(cls, languages: list[str], seed: int = 7) -> ByteNetwork:
        rng = np.random.default_rng(seed)
        return cls(
            languages,
            rng.normal(0, 0.5, (256, _EMBEDDING)).astype(np.float32),
            [rng.normal(0, 0.3, (w, _EMBEDDING, _FILTERS)).astype(np.float32) for w in WIDTHS],
            np.zeros(len(WIDTHS) * _FILTERS, np.float32),
            rng.normal(0, 0.1, (len(WIDTHS) * _FILTERS, len(languages))).astype(np.float32),
            np.zeros(len(languages), np.float32),
        )

    def pair_tables(self) -> list[list[np.ndarray]]:
        """Per width one table per byte pair of the filter: its response to each of 65,536 pairs."""
        tables = []
        for bank in self.banks:
            single = [self.embedding @ layer for layer in bank]
            tables.append(
                [(single[j][:, None, :] + single[j + 1][None, :, :]).reshape(65536, -1) for j in range(0, len(bank), 2)]
            )
        return tables

    def responses(self, cells: np.ndarray, tables: list[list[np.ndarray]] | None = None) -> Iterator[np.ndarray]:
        """Per width the filters' responses at every place of every window."""
        pairs = cells[:, :-1].astype(np.int32) * 256 + cells[:, 1:]
        for parts in tables or self.pair_tables():
            places = pairs.shape[1] - 2 * (len(parts) - 1)
            total = np.take(parts[0], pairs[:, :places], axis=0)
            for j, part in enumerate(parts[1:], 1):
                total += np.take(part, pairs[:, 2 * j : 2 * j + places], axis=0)
            yield total

    def output(self, pooled: np.ndarray) -> np.ndarray:
        scores = np.maximum(pooled + self.bias, 0) @ self.out + self.out_bias
        powers = np.exp(scores - scores.max(axis=1, keepdims=True))
        return powers / powers.sum(axis=1, keepdims=True)

    def probabilities(self, cells: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        return self.output(np.concatenate([r.max(axis=1) for r in self.responses(cells, tables)], axis=1))

    def _gradients(self, cells: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross-entropy. Pooling passes each filter's gradient to the place it came from."""
        pooled, places = [], []
        for response in self.responses(cells):
            at = response.argmax(axis=1)
            places.append(at)
            pooled.append(np.take_along_axis(response, at[:, None, :], axis=1)[:, 0])
        before = np.concatenate(pooled, axis=1) + self.bias
        hidden = np.maximum(before, 0)
        error = self.output(before - self.bias)
        error[np.arange(len(labels)), labels] -= 1
        error /= len(labels)
        back = (error @ self.out.T) * (before > 0)
        embedding, banks = np.zeros_like(self.embedding), []
        for i, (bank, at) in enumerate(zip(self.banks, places)):
            part = back[:, i * _FILTERS : (i + 1) * _FILTERS]
            grad = np.empty_like(bank)
            for j in range(len(bank)):
                byte = np.take_along_axis(cells, at + j, axis=1)
                grad[j] = np.einsum("nfe,nf->ef", self.embedding[byte], part)
                np.add.at(embedding, byte, part[:, :, None] * bank[j].T[None])
            banks.append(grad)
        return [embedding, *banks, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]

    def train(self, cells: np.ndarray, labels: np.ndarray, seed: int = 11) -> None:
        """Adam over shuffled batches, at a falling rate; some windows are shortened, so that short texts are learned too."""
        rng = np.random.default_rng(seed)
        weights = [self.embedding, *self.banks, self.bias, self.out, self.out_bias]
        first, second = ([np.zeros_like(w) for w in weights] for _ in range(2))
        step = 0
        for epoch in range(_EPOCHS):
            rate = _RATE * (1 - epoch / _EPOCHS)
            order = rng.permutation(len(cells))
            for start in range(0, len(order), _BATCH):
                chosen = order[start : start + _BATCH]
                length = rng.integers(16, WINDOW + 1, (len(chosen), 1))
                length[rng.random(len(chosen)) < 0.5] = WINDOW
                batch = np.where(np.arange(WINDOW) < length, cells[chosen], 0).astype(np.uint8)
                step += 1
                for w, g, m, v in zip(weights, self._gradients(batch, labels[chosen]), first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= (rate * m / (1 - 0.9**step) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)


def _has_letter(text: str) -> Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def training_sample(documents: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """``lang, rank, slice`` from at most ``per_language`` labelled documents of each language, chosen by hash.

    Slices start at a hashed place anywhere in the text. Held-out documents are left
    out. Tasks keep their first ``per_language`` slices of a language, groups of tasks
    theirs, so the last choice is made among a fixed number of rows.
    """
    held_out = F.coalesce(fold_of(F.col("doc_id"), FOLDS) == HELD_OUT_FOLD, F.lit(False))
    usable = documents.filter(F.col("lang").isNotNull() & ~held_out & _has_letter("text"))
    last = F.greatest(F.char_length("text") - SLICE_CHARS, F.lit(0)) + 1
    starts = [F.pmod(F.xxhash64("text", F.lit(i)), last).cast("int") + 1 for i in range(2)]
    slices = F.array(*[F.substring(F.col("text"), s, F.lit(SLICE_CHARS)) for s in starts])
    chosen = usable.select(
        "lang",
        F.xxhash64("doc_id", "text").alias("place"),
        slices.alias("slices"),
        (F.spark_partition_id() % SAMPLE_GROUPS).alias("group"),
    )
    for keys in (["lang", "group"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy("place", "slices"))
        chosen = chosen.withColumn("rank", rank).filter(F.col("rank") <= per_language)
    return chosen.select("lang", "rank", F.explode("slices").alias("slice"))


def fit(documents: DataFrame, per_language: int = PER_LANGUAGE) -> ByteNetwork | None:
    """The trained network, or None where nothing is labelled."""
    rows = sorted(training_sample(documents, per_language).collect())
    languages = sorted({r["lang"] for r in rows})
    if not rows:
        return None
    network = ByteNetwork.untrained(languages)
    cells, row, filled = windows_of(*text_bytes(pa.array([r["slice"] for r in rows], pa.string())))
    labels = np.array([languages.index(r["lang"]) for r in rows])[row]
    # The tail of a slice beyond one window is short; half a window and more is worth learning.
    keep = (filled >= WINDOW // 2) | np.r_[True, row[1:] != row[:-1]]
    network.train(cells[keep], labels[keep])
    return network


def with_language(documents: DataFrame, network: ByteNetwork | None) -> DataFrame:
    """``_row`` (all columns of ``documents`` as a struct), ``_lang_pred`` and ``_score``. Nothing is shuffled."""
    rows = documents.select(F.struct("*").alias("_row"), _has_letter("text").alias("_known"))
    if network is None:
        return rows.select("_row", F.lit(UNDETERMINED).alias("_lang_pred"), F.lit(0.0).alias("_score"))
    languages = np.array([*network.languages, UNDETERMINED], dtype=object)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = network.pair_tables()
        for batch in batches:
            data, offsets = text_bytes(batch.column("_row").field("text"))
            sums = np.zeros((batch.num_rows, len(network.languages)))
            for row, filled, cells in window_pieces(data, offsets):
                np.add.at(sums, row, network.probabilities(cells, tables) * filled[:, None])
            means = sums / np.maximum(np.diff(offsets), 1)[:, None]
            known = batch.column("_known").to_numpy(zero_copy_only=False)
            best = np.where(known, means.argmax(axis=1), len(network.languages))
            score = np.where(known, np.minimum(means.max(axis=1), 1.0), 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(languages[best], pa.string()), pa.array(score)],
                ["_row", "_lang_pred", "_score"],
            )

    added = [T.StructField("_lang_pred", T.StringType()), T.StructField("_score", T.DoubleType())]
    return rows.mapInArrow(predict, T.StructType([rows.schema["_row"], *added]))


def identify(documents: DataFrame, network: ByteNetwork | None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``documents`` (doc_id, text).

    ``lang_pred`` is a language the network learned, ``und`` (score 0) if the text is
    null or has no letter, or if the network learned none. ``score`` is the mean
    probability of that language. A row without doc_id is not held out. Whole texts
    are read, in pieces of bounded size; other columns are ignored.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    held_out = F.coalesce(fold_of(F.col("_row.doc_id"), FOLDS) == HELD_OUT_FOLD, F.lit(False))
    return with_language(rows, network).select(
        "_row.doc_id", held_out.alias("held_out"), F.col("_lang_pred").alias("lang_pred"), F.col("_score").alias("score")
    )


def accepted(documents: DataFrame, network: ByteNetwork | None, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``documents`` whose language is found with probability ``least`` or more, all columns kept."""
    found = with_language(documents, network)
    return found.filter((F.col("_lang_pred") != UNDETERMINED) & (F.col("_score") >= least)).select("_row.*")
