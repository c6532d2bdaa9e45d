"""Joins of every asking row with many asked rows, in cells of a grid.

Both sides lie in leaves of an index. Asking rows are dealt to ``rows`` of a grid and asked rows to its ``columns``, whole
leaves side by side and a leaf larger than its share over several, and a cell holds one row and one column. With about
the square roots of the numbers of blocks as rows and columns, an asked vector is copied once for each row and an asking
one once for each column at most, however little the index rules out. In a cell the asking side is held and the asked
side streamed past it, so memory follows the square root of the data, not a cell's rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

Leaf = tuple[int, int]


def lines(rows: int, block: int) -> int:
    """Rows or columns for so many vectors: the square root of the number of blocks."""
    return max(1, math.ceil(math.sqrt(rows / block)))


def deal(counts: dict[Leaf, int], into: int) -> dict[Leaf, list[int]]:
    """(length of vector, leaf) -> its lines. Leaves follow each other until a line is full; one larger than a line's
    share gets several of its own. At most ``into`` + leaves lines are used, whatever the counts."""
    share = max(1, math.ceil(sum(counts.values()) / into))
    out, line, held = {}, 0, 0
    for leaf, n in sorted(counts.items()):
        if held and held + n > share:
            line, held = line + 1, 0
        out[leaf] = list(range(line, line + max(1, math.ceil(n / share))))
        line, held = out[leaf][-1], (n if len(out[leaf]) == 1 else share)
    return out


class Best:
    """The k highest scores so far for each window of each asking row; of equal ones those with the smaller ids."""

    NONE = -(2**63)
    UNLIMITED = 2**62

    def __init__(self, rows: int, windows: int, k: int):
        self.scores = np.full((rows, windows, k), self.NONE, dtype=np.int64)
        self.ids = np.full((rows, windows, k), 2**63 - 1, dtype=np.int64)
        self.k = k

    def add(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """``scores`` and ``allowed`` of asking rows ``at`` x asked rows with ascending ``ids``; windows of each asking row."""
        n = len(ids)
        take = min(self.k, n)
        small = 2 * max(int(np.abs(scores).max(initial=0)), 1) * n < self.UNLIMITED
        place = np.arange(n - 1, -1, -1)
        for w in range(low.shape[1]):
            fits = allowed & (scores >= low[:, w, None]) & (scores <= high[:, w, None])
            if not fits.any():
                continue
            if small:
                order = np.argpartition(np.where(fits, -(scores * n + place), self.UNLIMITED), take - 1, axis=1)[:, :take]
            else:
                order = np.lexsort((np.broadcast_to(ids, scores.shape), np.where(fits, -scores, self.UNLIMITED * 2 - 1)), axis=-1)[:, :take]
            picked = np.take_along_axis(fits, order, axis=1)
            more = np.where(picked, np.take_along_axis(scores, order, axis=1), self.NONE)
            both = np.concatenate([self.scores[at, w], more], axis=1)
            names = np.concatenate([self.ids[at, w], np.where(picked, ids[order], 2**63 - 1)], axis=1)
            # the sentinel has no negative
            best = np.lexsort((names, -np.maximum(both, self.NONE + 1)), axis=-1)[:, : self.k]
            self.scores[at, w] = np.take_along_axis(both, best, axis=1)
            self.ids[at, w] = np.take_along_axis(names, best, axis=1)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(asking row, window, id, score) of all that are there."""
        row, window, k = np.nonzero(self.scores != self.NONE)
        return row, window, self.ids[row, window, k], self.scores[row, window, k]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers held as doubles, as longs: through doubles where those are exact."""
    largest = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if largest * largest * max(1, a.shape[1]) < 2.0**53:
        return (a @ b.T).astype(np.int64)
    a, b = (np.clip(m, -(2.0**63), 2.0**63 - 1025).astype(np.int64) for m in (a, b))
    return a @ b.T


def streamed(keys: list[str], kind: str, begin: Callable, schema: pa.Schema):
    """Runs over partitions sorted by the cell's ``keys``, then ``kind`` (0: asking, 1: asked), then whatever.

    ``begin`` gets the asking rows of a cell as one batch and returns an object with ``feed(batch)`` and ``end()``, which
    gives the cell's result as a batch. Cells without asked rows give nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, asking, state = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            changed = np.zeros(batch.num_rows - 1, dtype=bool)
            for c in [*keys, kind]:
                changed |= np.diff(batch.column(c).to_numpy()) != 0
            cuts = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
            for first, last in zip(cuts[:-1], cuts[1:], strict=True):
                part = batch.slice(first, last - first)
                here = tuple(part.column(c)[0].as_py() for c in keys)
                if here != cell:
                    if state is not None:
                        yield state.end()
                    cell, asking, state = here, [], None
                if part.column(kind)[0].as_py() == 0:
                    asking.append(part)
                elif asking:
                    if state is None:
                        state = begin(pa.Table.from_batches(asking).combine_chunks().to_batches()[0])
                    state.feed(part)
        if state is not None:
            yield state.end()
        yield pa.RecordBatch.from_pylist([], schema=schema)

    return run
