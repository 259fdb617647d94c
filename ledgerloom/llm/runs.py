"""Groups of neighbouring rows in sorted partitions, one at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each run of equal non-null integer keys, also where a run spans batches."""
    waiting: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        changed = np.zeros(batch.num_rows - 1, dtype=bool)
        for column in columns:
            changed |= column[1:] != column[:-1]
        cuts = np.concatenate(([0], np.flatnonzero(changed) + 1, [batch.num_rows]))
        for low, high in zip(cuts[:-1], cuts[1:]):
            now = tuple(column[low] for column in columns)
            if waiting and now != last:
                yield pa.Table.from_batches(waiting)
                waiting = []
            waiting.append(batch.slice(low, high - low))
            last = now
    if waiting:
        yield pa.Table.from_batches(waiting)
