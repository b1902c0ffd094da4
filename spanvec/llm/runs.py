"""Work on rows that are sorted by a key, group after group, without a group function's cost per group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of the rows that agree in the first ``keys`` columns, which sort the partition."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        if not table.num_rows:
            continue
        changed = np.zeros(table.num_rows - 1, bool)
        for i in range(keys):
            values = table.column(i).to_numpy()
            changed |= values[1:] != values[:-1]
        at = [0, *(np.flatnonzero(changed) + 1)]
        for begin, end in zip(at[:-1], at[1:], strict=True):
            yield table.slice(begin, end - begin)
        rest = table.slice(at[-1])
    if rest is not None and rest.num_rows:
        yield rest


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of equally long lists as a matrix of doubles."""
    parts = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    return np.concatenate([p.flatten().to_numpy(zero_copy_only=False).reshape(len(p), -1) for p in parts if len(p)]).astype(np.float64)
