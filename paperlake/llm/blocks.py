"""Counting over the whole corpus by blocks of documents, without shuffling one row per item.

Documents are dealt to blocks by hash. Each block sends every distinct key it
holds once, with a number, to the class of the key (``requests``); the class adds
the numbers of all blocks and sends each block its totals back, in the order in
which the block listed its keys (``answers``). The block then meets its answers
(``with_answers``), recomputes the same key list and so knows the totals without
having been sent any key. A key occurs at most once per block in its class,
however frequent it is. Key lists travel as sorted, delta-coded, compressed byte
planes.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCKS_PER_PARTITION = 4

_REQUEST = "class int, block int, keys binary, numbers binary"
_ANSWER = "block int, class int, totals binary"


def classes_of(spark: SparkSession) -> int:
    """Key classes: as many as the session has shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def block_column(spark: SparkSession, *keys: Column | str) -> Column:
    """Block of a row by hash of the given columns, several blocks per shuffle partition."""
    return sized_block_column(BLOCKS_PER_PARTITION * classes_of(spark), *keys)


def blocks_by_size(rows: DataFrame, text: str, block_bytes: int, most: int) -> int:
    """How many blocks give each about ``block_bytes`` of text: one per core at least, ``most`` at most.

    Reads the column's lengths once. Unlike the session's partitions, this grows with the input.
    """
    size = rows.agg(F.sum(F.octet_length(text))).first()[0] or 0
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return min(max(-(-size // block_bytes), cores), most)


def sized_block_column(blocks: int, *keys: Column | str) -> Column:
    """Block of a row by hash of the given columns, one of ``blocks``."""
    return F.pmod(F.xxhash64(*keys), F.lit(blocks)).cast("int")


def pack(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes, behind their count."""
    raw = np.ascontiguousarray(values, dtype=np.uint64)
    planes = raw.view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpack(packed: bytes) -> np.ndarray:
    count = int.from_bytes(packed[:8], "little")
    planes = pa.decompress(packed[8:], decompressed_size=8 * count, codec="zstd", asbytes=True)
    cells = np.frombuffer(planes, np.uint8).reshape(8, count).T
    return np.ascontiguousarray(cells).view(np.uint64).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending numbers by their differences."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(packed: bytes) -> np.ndarray:
    return np.cumsum(unpack(packed), dtype=np.uint64)


def totals_by_key(keys: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sum of each one's numbers."""
    if not len(keys):
        return keys, numbers
    order = np.argsort(keys)
    ordered = keys[order]
    edges = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    return ordered[edges], np.add.reduceat(numbers[order], edges)


# Distinct keys of a block, ascending, and one number for each.
Keys = tuple[np.ndarray, np.ndarray]


def _request_rows(block: int, keys: np.ndarray, numbers: np.ndarray, edges: np.ndarray) -> pa.Table:
    cuts = [0, *np.searchsorted(keys, edges), len(keys)]
    kept = [c for c in range(len(cuts) - 1) if cuts[c + 1] > cuts[c]]
    return pa.table(
        {
            "class": pa.array(kept, pa.int32()),
            "block": pa.array([block] * len(kept), pa.int32()),
            "keys": pa.array([pack_sorted(keys[cuts[c] : cuts[c + 1]]) for c in kept], pa.binary()),
            "numbers": pa.array([pack(numbers[cuts[c] : cuts[c + 1]]) for c in kept], pa.binary()),
        }
    )


def _class_edges(classes: int, key_bits: int) -> np.ndarray:
    """The first key of each class but the first; classes are cut by a key's leading bits."""
    return np.array([-(-(c << key_bits) // classes) for c in range(1, classes)], dtype=np.uint64)


def requests(blocks: DataFrame, keys_of: Callable[[pa.Table], Keys], key_bits: int) -> DataFrame:
    """Each block's keys, by class."""
    edges = _class_edges(classes_of(blocks.sparkSession), key_bits)

    def ask(table: pa.Table) -> pa.Table:
        return _request_rows(table.column("block")[0].as_py(), *keys_of(table), edges)

    return blocks.groupBy("block").applyInArrow(ask, _REQUEST)


def further_requests(
    blocks: DataFrame, answered: DataFrame, keys_of: Callable[[pa.Table, pa.Table], Keys], key_bits: int
) -> DataFrame:
    """Requests that depend on earlier answers."""
    edges = _class_edges(classes_of(blocks.sparkSession), key_bits)

    def ask(table: pa.Table, told: pa.Table) -> pa.Table:
        return _request_rows(table.column("block")[0].as_py(), *keys_of(table, told), edges)

    return with_answers(blocks, answered, ask, _REQUEST)


def _gathered(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """A class's key lists, its distinct keys and their totals."""
    lists = [unpack_sorted(k) for k in table.column("keys").to_pylist()]
    numbers = np.concatenate([unpack(n) for n in table.column("numbers").to_pylist()])
    return lists, *totals_by_key(np.concatenate(lists), numbers)


def answers(asked: DataFrame, answer: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """Per block and class the totals of the block's keys, in its order.

    ``answer`` maps totals to what the blocks want to know of them.
    """

    def total(table: pa.Table) -> pa.Table:
        lists, distinct, sums = _gathered(table)
        told = sums if answer is None else answer(sums).astype(np.uint64)
        packed = [pack(told[np.searchsorted(distinct, k)]) for k in lists]
        return table.select(["block", "class"]).append_column("totals", pa.array(packed, pa.binary()))

    return asked.groupBy("class").applyInArrow(total, _ANSWER)


def key_statistics(
    asked: DataFrame,
    counted: Callable[[np.ndarray], np.ndarray],
    total_of: Callable[[np.ndarray], np.ndarray] = np.asarray,
) -> DataFrame:
    """``distinct_keys, sum_totals`` per class, of the keys that ``counted`` selects and that have a total over 0.

    ``total_of`` gives the totals where the numbers hold more than counts.
    """

    def statistics(table: pa.Table) -> pa.Table:
        _, distinct, sums = _gathered(table)
        chosen = total_of(sums[counted(distinct)])
        return pa.table({"distinct_keys": [int(np.count_nonzero(chosen))], "sum_totals": [int(chosen.sum())]})

    return asked.groupBy("class").applyInArrow(statistics, "distinct_keys long, sum_totals long")


def chosen_keys(asked: DataFrame, choose: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Per block and class those of the block's keys whose totals ``choose`` selects."""

    def total(table: pa.Table) -> pa.Table:
        lists, distinct, sums = _gathered(table)
        chosen = choose(sums)
        kept = [k[chosen[np.searchsorted(distinct, k)]] for k in lists]
        return pa.table({"block": table.column("block"), "keys": pa.array(map(pack_sorted, kept), pa.binary())})

    return asked.groupBy("class").applyInArrow(total, "block int, keys binary")


def block_keys(answered: pa.Table) -> np.ndarray:
    """The keys sent to a block by ``chosen_keys``, ascending."""
    parts = answered.column("keys").to_pylist()
    return np.sort(np.concatenate([unpack_sorted(p) for p in parts])) if parts else np.empty(0, np.uint64)


def block_totals(answered: pa.Table) -> np.ndarray:
    """The answers to a block's keys, in the order of its keys."""
    parts = answered.select(["class", "totals"]).sort_by("class").column("totals").to_pylist()
    return np.concatenate([unpack(p) for p in parts]) if parts else np.empty(0, np.uint64)


def with_answers(
    blocks: DataFrame, answered: DataFrame, fn: Callable[[pa.Table, pa.Table], pa.Table], schema: str
) -> DataFrame:
    """``fn(block's rows, its answers)`` for every block."""
    return blocks.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(fn, schema)
