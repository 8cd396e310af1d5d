"""Words of whole texts as 64-bit numbers, computed on Arrow buffers without a loop over characters.

A word is a run of bytes other than U+0020 and U+0009 to U+000D. Its number is a
polynomial of random byte values, modulo 2**64, then mixed; equal words have
equal numbers and different words have different ones up to 64-bit chance.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes hashed at a time; a chunk ends between words, so only one word can make it longer.
CHUNK_BYTES = 1 << 21

_U64 = np.uint64
_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD1342543DE82EF95
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_PUNCTUATION = np.zeros(256, dtype=bool)
_PUNCTUATION[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = True
_BYTE_VALUES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64)
_LOWER_VALUES = _BYTE_VALUES.copy()
_LOWER_VALUES[ord("A") : ord("Z") + 1] = _BYTE_VALUES[ord("a") : ord("z") + 1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over all output bits."""
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2**64, kept for the next call."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, CHUNK_BYTES // 8), base, dtype=np.uint64)
        steps[0] = 1
        known = _POWERS[base] = np.cumprod(steps)
    return known[:n]


@cache
def _inverse(base: int) -> int:
    return pow(base, -1, 2**64)


def text_bytes(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array, and the offset of each row; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays([c.cast(pa.large_string()) for c in texts.chunks] or [pa.array([], pa.large_string())])
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    if not len(texts) or data is None:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def _chunks(data: np.ndarray, row_starts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about ``CHUNK_BYTES`` that split no word."""
    start, size = 0, len(data)
    while start < size:
        end, look = min(start + CHUNK_BYTES, size), 4096
        while end < size:
            spaces = np.flatnonzero(_SPACE[data[end : end + look]])
            row = np.searchsorted(row_starts, end)
            next_row = row_starts[row] if row < len(row_starts) else size
            next_space = end + spaces[0] if len(spaces) else size
            if len(spaces) or next_row <= end + look or end + look >= size:
                end = min(next_row, next_space)
                break
            look *= 8
        yield start, end
        start = end


def word_spans(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per chunk its byte range and the starts and ends of its words, relative to the chunk."""
    rows = np.unique(offsets[:-1])
    for lo, hi in _chunks(data, rows):
        word = ~_SPACE[data[lo:hi]]
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1]
        last[:-1] &= ~word[1:]
        inner = rows[np.searchsorted(rows, lo, "right") : np.searchsorted(rows, hi)] - lo
        first[inner] = word[inner]
        last[inner - 1] = word[inner - 1]
        yield lo, hi, np.flatnonzero(first), np.flatnonzero(last) + 1


def _trimmed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word spans without the punctuation around them; a word that has nothing else becomes empty."""
    while True:
        drop = (ends > starts) & _PUNCTUATION[data[np.maximum(ends - 1, 0)]]
        if not drop.any():
            break
        ends = ends - drop
    while True:
        drop = (ends > starts) & _PUNCTUATION[data[np.minimum(starts, len(data) - 1)]]
        if not drop.any():
            return starts, ends
        starts = starts + drop


class Words:
    """The words of a column of texts.

    ``hashes`` has one number per word, row after row; row r's words are
    ``first[r]:first[r + 1]``. ``starts`` and ``ends`` are byte positions in ``data``.
    With ``trim``, ASCII punctuation around a word does not count.
    """

    def __init__(self, texts: pa.Array | pa.ChunkedArray, lower: bool, trim: bool = False):
        self.data, self.offsets = text_bytes(texts)
        values = _LOWER_VALUES if lower else _BYTE_VALUES
        hashes, starts, ends = [], [], []
        for lo, hi, start, end in word_spans(self.data, self.offsets):
            sums = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(values[self.data[lo:hi]] * _powers(_BYTE_BASE, hi - lo), out=sums[1:])
            back = _powers(_inverse(_BYTE_BASE), hi - lo + 1)
            if trim:
                start, end = _trimmed(self.data[lo:hi], start, end)
            hashes.append(mix((sums[end] - sums[start]) * back[start]))
            starts.append(start + lo)
            ends.append(end + lo)
        self.hashes = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        self.starts = np.concatenate(starts) if starts else np.empty(0, np.int64)
        self.ends = np.concatenate(ends) if ends else np.empty(0, np.int64)
        self.first = np.searchsorted(self.starts, self.offsets)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def row(self, r: int) -> slice:
        return slice(self.first[r], self.first[r + 1])

    def text(self, word: int) -> bytes:
        return self.data[self.starts[word] : self.ends[word]].tobytes()


def sequence_hashes(hashes: np.ndarray, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
    """One number per word sequence ``starts .. starts + lengths``; equal for equal sequences."""
    if not len(starts):
        return np.empty(0, np.uint64)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * _powers(_WORD_BASE, len(hashes)), out=sums[1:])
    back = _powers(_inverse(_WORD_BASE), len(hashes))
    return mix((sums[starts + lengths] - sums[starts]) * back[starts])


def window_starts(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where windows of ``size`` words start, and per row the offset of its windows."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    offsets = np.r_[0, np.cumsum(counts)]
    starts = np.arange(offsets[-1]) + np.repeat(first[:-1] - offsets[:-1], counts)
    return starts, offsets
