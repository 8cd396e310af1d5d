"""Packing tokenised documents into sequences of bounded length by online best fit.

A task tokenises its documents and packs their pieces as they come. It holds a fixed
number of open bins; a bitset has a bit for every amount of free space that some open
bin has, so the best fit for a piece is the lowest set bit from its length on. When
nothing fits and all places are taken, the fullest bin closes. What is open when a
task ends is packed again, as pieces of their own, in rounds of bounded groups.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from paperlake.llm.slices import text_slices
from paperlake.session import materialize

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
CAPACITY = 4096
END_ID = 1
# Bins a task holds open.
OPEN_BINS = 512
# Open bins that one task packs again, and how many it leaves open: the emptiest.
GROUP_BINS = 1024
LEFT_OPEN = 64
# Words whose ids a Python worker remembers; all are forgotten when there are more.
KNOWN_WORDS = 500_000
# Bytes of text tokenised at a time, unless one text is longer.
SLICE_BYTES = 8 << 20

# Blanks for the tokenizer; every other one is left to it.
_BLANKS = "\n\t\r"
# Of ASCII punctuation after a word, what is no part of a contraction or of a special token.
_TAIL = '.,;:!?)]"'

# How a byte-level vocabulary writes bytes: those without a sign of their own as U+0100 and up.
_SIGNED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_SIGNS = {b: 0x100 + i for i, b in enumerate(sorted(set(range(256)) - set(_SIGNED)))}


class WordIds:
    """Token ids of texts, each distinct word tokenised once.

    The vocabulary drops blanks and joins nothing across them, so a text's ids are those
    of its words. A word of letters with punctuation behind it has the ids of both parts.
    A part that is still all letters when normalized is one word to the vocabulary and goes
    straight to its merges, all other parts go through the whole tokenizer.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.parts: dict[str, bytes] = {"": b""}
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {"": 0}
        self.flat, self.ends = bytearray(), array("q", [0, 0])

    def _learn_parts(self, parts: set[str]) -> None:
        if len(self.parts) > KNOWN_WORDS:
            self.parts = {"": b""}
        letters = [p for p in parts if p.isalpha()]
        others = [p for p in parts if not p.isalpha()]
        # No word has a blank, and neither rule of the normalizer joins anything across one.
        plain = self.tokenizer.normalizer.normalize_str(" ".join(letters)).split(" ")
        tokenize = self.tokenizer.model.tokenize
        for part, word in zip(letters, plain):
            if word.isalpha():
                found = tokenize(word if word.isascii() else word.encode().decode("latin-1").translate(_BYTE_SIGNS))
                self.parts[part] = array("I", [t.id for t in found]).tobytes()
            else:
                others.append(part)
        for part, found in zip(others, self.tokenizer.encode_batch_fast(others, add_special_tokens=False)):
            self.parts[part] = array("I", found.ids).tobytes()

    def _learn(self, words: list[str]) -> None:
        split = []
        for word in words:
            core = word.rstrip(_TAIL)
            if not core.isalpha():
                split.append((word, ""))
            else:
                split.append((core.lower() if core.isascii() else core, word[len(core) :]))
        # What forgetting may drop is asked for again, so that all parts are there below.
        wanted = {p for pair in split for p in pair}
        self._learn_parts(wanted if len(self.parts) > KNOWN_WORDS else wanted - self.parts.keys())
        for word, (core, tail) in zip(words, split):
            self.known[word] = len(self.known)
            self.flat += self.parts[core]
            if tail:
                self.flat += self.parts[tail]
            self.ends.append(len(self.flat) // 4)

    def of_words(self, words: list[str]) -> np.ndarray:
        """Numbers of distinct words in ``flat`` and ``ends``."""
        if len(self.known) > KNOWN_WORDS:
            self._forget()
        self._learn([w for w in words if w not in self.known])
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def of_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and ``len(texts) + 1`` offsets."""
        for blank in _BLANKS:
            texts = pc.replace_substring(texts, blank, " ")
        words = pc.split_pattern(texts, " ")
        offsets = words.offsets.to_numpy()
        coded = words.flatten().dictionary_encode()
        numbers = self.of_words(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        flat = np.frombuffer(self.flat, np.uint32)
        ids, word_ends = _picked(flat, np.frombuffer(self.ends, np.int64), numbers[coded.indices.to_numpy()])
        return ids, word_ends[offsets - offsets[0]]


def _picked(flat: np.ndarray, ends: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``flat[ends[i]:ends[i + 1]]`` of the chosen ones in order, and their offsets."""
    starts, lengths = ends[chosen], ends[chosen + 1] - ends[chosen]
    offsets = np.zeros(len(chosen) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    return flat[np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)], offsets


_WORD_IDS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One per Python worker and vocabulary, kept for the worker's next task."""
    if path not in _WORD_IDS:
        _WORD_IDS[path] = WordIds(path)
    return _WORD_IDS[path]


class OpenBins:
    """Best fit into at most ``limit`` open bins of ``capacity``."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.rooms = 0  # bit r: some open bin has r free
        self.bins: dict[int, list[int]] = {}
        self.started = self.open = 0

    def _take(self, room: int) -> int:
        bins = self.bins[room]
        taken = bins.pop()
        if not bins:
            self.rooms ^= 1 << room
        self.open -= 1
        return taken

    def place(self, size: int) -> tuple[int, int]:
        """The bin a piece goes to and its offset there."""
        fitting = self.rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = self._take(room)
        else:
            if self.open == self.limit:
                self._take((self.rooms & -self.rooms).bit_length() - 1)
            chosen, room = self.started, self.capacity
            self.started += 1
        left = room - size
        if left:
            self.bins.setdefault(left, []).append(chosen)
            self.rooms |= 1 << left
            self.open += 1
        return chosen, self.capacity - room

    def still_open(self) -> Iterator[tuple[int, int]]:
        """Bin and filled length of each."""
        for room, bins in self.bins.items():
            for chosen in bins:
                yield chosen, self.capacity - room


_PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, offset long"
_MOVED = "bin long, length long, into long, offset long"


def _pieces(documents: DataFrame, path: str, capacity: int, limit: int, with_ids: bool) -> DataFrame:
    """A row per piece with its bin; a row of piece -1 per bin that is still open in the end."""
    schema = T.StructType.fromDDL(_PLACED + (", ids array<int>" if with_ids else ""))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, bins = word_ids(path), OpenBins(capacity, limit)
        base = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in text_slices(batch, "text", SLICE_BYTES):
                ids, offsets = ids_of.of_texts(pc.fill_null(part.column("text"), ""))
                keys, rows, kept = part.column("doc_id").to_pylist(), [], []
                for key, lo, hi in zip(keys, offsets[:-1].tolist(), offsets[1:].tolist()):
                    own = np.append(ids[lo:hi], np.uint32(END_ID))
                    for piece, start in enumerate(range(0, len(own), capacity)):
                        cut = own[start : start + capacity]
                        rows.append((key, piece, start, len(cut), zlib.crc32(cut.astype("<u4").tobytes())))
                        kept.append(cut)
                # The longest of a slice first: what comes later fills their gaps.
                places: list[tuple[int, int]] = [(0, 0)] * len(rows)
                for at in sorted(range(len(rows)), key=lambda i: -rows[i][3]):
                    chosen, offset = bins.place(rows[at][3])
                    places[at] = (base + chosen, offset)
                yield _batch(schema, [r + p for r, p in zip(rows, places)], kept if with_ids else None)
        rest = [(None, -1, None, filled, None, base + chosen, None) for chosen, filled in bins.still_open()]
        yield _batch(schema, rest, [None] * len(rest) if with_ids else None)

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(pack, schema)


def _batch(schema: T.StructType, rows: list[tuple], ids: list | None) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "integer": pa.int32()}
    columns = [pa.array([r[i] for r in rows], kinds[f.dataType.typeName()]) for i, f in enumerate(schema) if f.name != "ids"]
    if ids is not None:
        columns.append(pa.array(ids, pa.list_(pa.int32())))
    return pa.RecordBatch.from_arrays(columns, schema.names)


def _packed_again(bins: DataFrame, groups: int, turn: int, capacity: int) -> DataFrame:
    """Where open bins (bin, length) go as wholes: ``bin, length, into, offset``, and rows of null bin for what stays open."""

    schema = T.StructType.fromDDL(_MOVED)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("length", "bin", "group")))]
        rows.sort(reverse=True)
        held = OpenBins(capacity, len(rows))
        base = (turn << 56) + (rows[0][2] << 32)
        moved = []
        for length, own, _ in rows:
            chosen, offset = held.place(length)
            moved.append((own, length, base + chosen, offset))
        rest = sorted(held.still_open(), key=lambda b: b[1])[:LEFT_OPEN]
        moved += [(None, filled, base + chosen, None) for chosen, filled in rest]
        yield _batch(schema, moved, None)

    grouped = bins.withColumn("group", F.pmod(F.xxhash64("bin"), F.lit(groups)))
    return grouped.groupBy("group").applyInArrow(pack, schema)


def pack(
    documents: DataFrame,
    path: str = VOCABULARY,
    capacity: int = CAPACITY,
    open_bins: int = OPEN_BINS,
    with_ids: bool = False,
) -> DataFrame:
    """Every piece of every row of ``documents`` (doc_id, text), placed in a sequence.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset and, with
    ``with_ids``, the piece's token ids. A null or empty text is its end id alone, so it
    has a piece too. Only documents longer than ``capacity`` are cut. Whole texts are
    tokenised; repeated rows and null doc_ids are packed like any others; other columns
    are ignored. An empty table has no rows.
    """
    placed = materialize(_pieces(documents, path, capacity, open_bins, with_ids), "packed-pieces")
    waiting = placed.filter("piece = -1").select("bin", "length")
    placed = placed.filter("piece >= 0").withColumnRenamed("bin", "sequence_id")
    turn = 0
    while (count := waiting.count()) > 1:
        turn += 1
        groups = -(-count // GROUP_BINS)
        moved = materialize(_packed_again(waiting, groups, turn, capacity), "packed-again")
        moves = moved.filter("bin is not null").select(
            F.col("bin").alias("sequence_id"), "into", F.col("offset").alias("shift")
        )
        placed = placed.join(moves, "sequence_id", "left").select(
            *[c for c in placed.columns if c not in ("sequence_id", "offset", "ids")],
            F.coalesce("into", "sequence_id").alias("sequence_id"),
            (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
            *(["ids"] if with_ids else []),
        )
        if groups == 1:
            break
        waiting = moved.filter("bin is null").select(F.col("into").alias("bin"), "length")
    return placed


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves, ``sequence_id, ids``, from pieces packed ``with_ids``.

    A sequence holds at most ``capacity`` tokens, so no group is large.
    """
    pieces = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = packed.groupBy("sequence_id").agg(pieces.alias("pieces"))
    return joined.select("sequence_id", F.flatten(F.col("pieces.ids")).alias("ids"))
