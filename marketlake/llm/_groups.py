"""Whole groups out of Arrow batches that are sorted by key columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def bucket_runs(batches: Iterator[pa.RecordBatch], keys: list[str], limit: int
                ) -> Iterator[tuple[pa.RecordBatch, np.ndarray | None, np.ndarray | None]]:
    """(batch, begin, end): group ``i`` of the batch is ``begin[i]:end[i]``.

    A group with more than ``limit`` rows comes in pieces with None for begin and end as it is
    read, so no more than ``limit`` rows and one batch are held.
    """
    held = passed = None
    for batch in batches:
        if passed is not None:
            same = np.ones(batch.num_rows, dtype=bool)
            for name, value in passed.items():
                same &= batch.column(name).to_numpy(zero_copy_only=False) == value
            n = int(same.sum())  # the group goes on at the start of the batch
            if n:
                yield batch.slice(0, n), None, None
            if n == batch.num_rows:
                continue
            batch, passed = batch.slice(n), None
        if held is not None:
            batch, held = pa.concat_batches([held, batch]), None
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, dtype=bool)
        for name in keys:
            values = batch.column(name).to_numpy(zero_copy_only=False)
            new[1:] |= values[1:] != values[:-1]
        begin = np.concatenate(([0], np.flatnonzero(new)))
        end = np.concatenate((begin[1:], [batch.num_rows]))
        large = end - begin > limit
        for i in np.flatnonzero(large):
            yield batch.slice(begin[i], end[i] - begin[i]), None, None
        small = np.flatnonzero(~large[:-1])
        yield batch, begin[small], end[small]
        if large[-1]:
            passed = {k: batch.column(k)[batch.num_rows - 1].as_py() for k in keys}
        else:
            held = batch.slice(begin[-1])
    if held is not None:
        yield held, np.array([0]), np.array([held.num_rows])
