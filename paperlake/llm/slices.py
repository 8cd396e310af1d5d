"""Arrow batches cut into slices of bounded text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def text_slices(batch: pa.RecordBatch, text: str, most: int) -> Iterator[pa.RecordBatch]:
    """Consecutive slices with at most ``most`` bytes of text each, or one row if it has more."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    sums = np.r_[0, np.cumsum(lengths, dtype=np.int64)]
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(sums, sums[start] + most, "right")) - 1)
        yield batch.slice(start, end - start)
        start = end
