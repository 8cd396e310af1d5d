from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from paperlake.llm import packing
from tests.llm.fixtures import documents, with_clashes

TOKENIZER = Tokenizer.from_file(packing.VOCABULARY)
ODD = [
    "", "İstanbul ΣΑΣ ΑΣ. ß ﬁ Å éa ́b Å's", "don't I'LL we've 's 't", "a\x1cb \x85 c\xa0d e　f",
    "<|endoftext|> x<|startoftext|>y <|END", "漢字テスト 한국어 ไทย ٣٤ ²³ ①", "...?!.. a..b a.). 1.2.3 x1y2",
    "\r\n\t\v\f a\vb", "𝔘𝔫𝔦 😀👍🏽 ﷺ Ǆ ŉ ΐ", "é. e̸= ≠ a.́ b,̸", "Ａｂｃ １２３ ª º ʰ",
]


def ids_of(text: str | None) -> list[int]:
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def odd_text(rng: random.Random) -> str:
    kinds = [(32, 127), (160, 0x500), (0x300, 0x370), (0x1E00, 0x3100), (0x10000, 0x1F900), (32, 33), (46, 47)]
    return "".join(chr(rng.randrange(*rng.choice(kinds))) for _ in range(rng.randrange(1, 60)))


def test_word_ids_are_the_tokenizers():
    rng = random.Random(5)
    texts = ODD + [odd_text(rng) for _ in range(400)]
    known = packing.WordIds(packing.VOCABULARY)
    ids, offsets = known.of_texts(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == ids_of(text), repr(text)


def test_forgotten_words_are_learned_again(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_WORDS", 5)
    known = packing.WordIds(packing.VOCABULARY)
    for text in ("one two, three four. five six", "six seven eight, one two", "two. nine six"):
        ids, _ = known.of_texts(pa.array([text]))
        assert ids.tolist() == ids_of(text)


@pytest.mark.parametrize("limit", [1, 3, 50])
def test_open_bins_are_best_fit_and_bounded(limit):
    rng = random.Random(limit)
    bins, fill, closed = packing.OpenBins(100, limit), {}, set()
    for _ in range(500):
        size = rng.randrange(1, 101)
        open_ = {b: 100 - f for b, f in fill.items() if f < 100 and b not in closed}
        fitting = [room for room in open_.values() if room >= size]
        chosen, offset = bins.place(size)
        if fitting:
            assert 100 - fill[chosen] == min(fitting)
        else:
            assert chosen not in fill
            if len(open_) == limit:
                still = {b for b, _ in bins.still_open()}
                (gone,) = {b for b in open_ if b not in still}
                assert open_[gone] == min(open_.values())
                closed.add(gone)
        assert offset == fill.get(chosen, 0)
        fill[chosen] = offset + size
        assert fill[chosen] <= 100 and len(list(bins.still_open())) <= limit


@pytest.mark.parametrize("capacity,open_bins", [(4096, 512), (64, 4)])
def test_pieces_are_whole_and_sequences_gapless(spark, monkeypatch, capacity, open_bins):
    monkeypatch.setattr(packing, "GROUP_BINS", 130)
    docs = with_clashes(documents(spark))
    packed = packing.pack(docs, capacity=capacity, open_bins=open_bins, with_ids=True)
    rows = packed.collect()
    given = sorted((str(r["doc_id"]), tuple([*ids_of(r["text"]), packing.END_ID])) for r in docs.collect())
    pieces = sorted((str(r["doc_id"]), r["piece"], r["start"], tuple(r["ids"])) for r in rows)
    expected = sorted(
        (key, piece, start, ids[start : start + capacity])
        for key, ids in given
        for piece, start in enumerate(range(0, len(ids), capacity))
    )
    assert pieces == expected
    for r in rows:
        assert r["length"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
    by_sequence: dict[int, list] = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for members in by_sequence.values():
        at = 0
        for r in sorted(members, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    total = sum(r["length"] for r in rows)
    assert len(by_sequence) <= -(-total // capacity) * 1.06 + 1
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    assert whole == {
        k: [i for r in sorted(v, key=lambda r: r["offset"]) for i in r["ids"]] for k, v in by_sequence.items()
    }


def test_many_equal_rows_fill_sequences(spark):
    docs = spark.range(9000).selectExpr("cast(null as long) as doc_id", "cast(null as string) as text")
    rows = packing.pack(docs.repartition(7)).groupBy("sequence_id").count().collect()
    assert sum(r["count"] for r in rows) == 9000 and len(rows) == 3


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(docs).isEmpty()
    assert packing.sequences(packing.pack(docs, with_ids=True)).isEmpty()
