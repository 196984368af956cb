"""Small helpers for code that runs inside tasks on Arrow batches."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text that a task holds in its working arrays at once; a single longer text is taken whole.
SLICE_BYTES = 2 << 20


def kept(key: Any, build: Callable[[], Any]) -> Any:
    """A value that a Python worker builds once and keeps for its later tasks."""
    module = sys.modules.setdefault("_textloom_llm_kept", types.ModuleType("_textloom_llm_kept"))
    store = module.__dict__.setdefault("store", {})
    if key not in store:
        store[key] = build()
    return store[key]


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``SLICE_BYTES`` bytes of ``column`` at most."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        part = (np.cumsum(size) - size) // SLICE_BYTES
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for first, last in zip(edges, edges[1:]):
            yield batch.slice(first, last - first)


def whole_groups(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[pa.Table]:
    """Batches that end where a group of rows with equal numbers in ``names`` ends; a group has a bounded size."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]) if rest is not None else table
        name = np.stack([table.column(c).to_numpy().astype(np.int64) for c in names], axis=1)
        cut = np.flatnonzero((name != name[-1]).any(axis=1)) if len(name) else []
        edge = int(cut[-1]) + 1 if len(cut) else 0
        if edge:
            yield table.slice(0, edge).combine_chunks()
        rest = table.slice(edge)
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks()


class Growing:
    """A flat array that grows at its end without being copied each time."""

    def __init__(self, kind: type):
        self._data, self._size = np.zeros(1024, dtype=kind), 0

    def __len__(self) -> int:
        return self._size

    def append(self, values: np.ndarray) -> None:
        size = self._size + len(values)
        if size > len(self._data):
            more = np.empty(max(size, len(self._data) * 3 // 2), dtype=self._data.dtype)
            more[: self._size] = self._data[: self._size]
            self._data = more
        self._data[self._size : size] = values
        self._size = size

    def __getitem__(self, at) -> np.ndarray:
        return self._data[: self._size][at]


def digest(text: str) -> Column:
    """Tells rows of one key apart by their texts; a null text is an empty one."""
    return F.md5(F.coalesce(F.col(text), F.lit("")))


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones for columns of one's own, which no column of the frame has."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        name = f"_own_{name}"
        while name in taken:
            name = f"_{name}"
        found.append(name)
    return found


def texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 of a string column; null is empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column from flat values and a count per row."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def out(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
    )
