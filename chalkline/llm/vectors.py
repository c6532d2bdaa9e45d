"""Vectors in Arrow batches and pivots, shared by the two vector joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Vectors in one block of a cell: bounds what a task holds.
BLOCK = 4096
# Pivots at most; they are gathered and sent to all tasks, so this times the dimension bounds the driver's share.
MOST_PIVOTS = 1024
# Vectors to a pivot, as long as there are few enough pivots.
CELL = 2048


def finite(vector: str) -> Column:
    """No null vector, no null or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & ~bad, F.lit(False))


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix of doubles) for each length of vector in a list column without nulls."""
    column = column.cast(pa.large_list(pa.float64()))
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, flat[offsets[rows][:, None] + np.arange(size)]


def pivots(rows: DataFrame, vector: str, count: int) -> dict[int, np.ndarray]:
    """Length of vector -> pivots: the ``count`` vectors with the least hashes."""
    picked = rows.select(vector).orderBy(F.xxhash64(vector), vector).limit(max(1, min(count, MOST_PIVOTS))).toArrow()
    if not picked.num_rows:
        return {}
    return {m.shape[1]: m for _, m in matrices(picked[vector].combine_chunks())}


def lists(matrix: np.ndarray) -> pa.ListArray:
    n, size = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * np.int32(size)), pa.array(matrix.ravel()))


def distances(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Euclidean distances, points x centers."""
    squares = (points * points).sum(axis=1)[:, None] + (centers * centers).sum(axis=1) - 2 * (points @ centers.T)
    return np.sqrt(np.maximum(squares, 0))
