"""Arrow batches cut by the bytes of a text column."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# the corpus operators, which travel with their code, use it in tasks
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLICE_BYTES = 4 << 20


def text_slices(batches: Iterator[pa.RecordBatch], column: str,
                limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into runs of rows that hold about ``limit`` bytes of
    ``column`` (one row at least)."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop
