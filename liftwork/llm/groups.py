"""Streams sorted Arrow batches as groups of rows."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa


def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with equal values in the first ``keys`` columns."""
    for key, run in groupby(rows(batches), key=lambda r: r[:keys]):
        yield key, list(run)


def tables(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows with equal values in the first ``keys`` columns, none of them null, as tables."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(keys)]
        edges = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1
        for begin, end in zip([0, *edges], [*edges, batch.num_rows], strict=True):
            key = tuple(c[begin] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(begin, end - begin))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def batched(found: Iterator[tuple], schema: pa.Schema, size: int = 5000) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    for row in found:
        out.append(row)
        if len(out) == size:
            yield _batch(out, schema)
            out = []
    if out:
        yield _batch(out, schema)


def _batch(out: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
