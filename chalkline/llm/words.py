"""Hashes of words, shingles and sets for Arrow batches of texts, in numpy.

Nothing here knows Spark: the operators call these functions inside their tasks. All work goes through windows of about
``WINDOW`` bytes cut at separators, so that a very long text costs no more memory than its own bytes and word hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WINDOW = 1 << 20
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
# Values of the 256 bytes; A-Z count as a-z in the second table.
_EXACT = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _EXACT.copy()
_FOLDED[65:91] = _FOLDED[97:123]
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 2**64)
_POWERS: dict[int, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_constants(seed: int, n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, WINDOW + 1), base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _POWERS[base] = have
    return have[:n]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    body = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return body[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_groups(offsets: np.ndarray, limit: int = WINDOW) -> Iterator[tuple[int, int]]:
    """Consecutive rows of about ``limit`` bytes together, one row at least."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def _span_hashes(body: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    n = len(body)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(table[body] * _powers(_BASE, n), out=total[1:])
    return mixed((total[ends] - total[starts]) * _powers(_BACK, n + 1)[starts])


def _cuts(body: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Windows of a body that end at a separator or a row's end."""
    at, n = 0, len(body)
    while at < n:
        end = at + WINDOW
        if end >= n:
            yield at, n
            return
        row_end = int(offsets[np.searchsorted(offsets, end, side="left")])
        reach = end
        while reach < row_end:  # the first separator after the window, looked for piece by piece
            found = np.flatnonzero(SPACE[body[reach : min(reach + 65536, row_end)]])
            if len(found):
                reach += int(found[0])
                break
            reach = min(reach + 65536, row_end)
        yield at, reach
        at = reach


def word_hashes(body: np.ndarray, offsets: np.ndarray, fold: bool = True, punctuation: bool = False):
    """(hash, byte start) of every word, and the number of words by row.

    Words are runs without the six ASCII separators. With ``punctuation``, runs of ASCII punctuation are words of their
    own. ``fold`` lower-cases A-Z.
    """
    table = _FOLDED if fold else _EXACT
    kinds = _KINDS if punctuation else (~SPACE).astype(np.uint8)
    hashes, places = [], []
    for low, high in _cuts(body, offsets):
        piece = body[low:high]
        kind = kinds[piece]
        change = np.empty(len(piece) + 1, dtype=bool)
        change[0] = change[-1] = True
        np.not_equal(kind[1:], kind[:-1], out=change[1:-1])
        inner = offsets[np.searchsorted(offsets, low) : np.searchsorted(offsets, high)] - low
        change[inner] = True
        edges = np.flatnonzero(change)
        starts, ends = edges[:-1], edges[1:]
        worded = kind[starts] > 0
        starts, ends = starts[worded], ends[worded]
        hashes.append(_span_hashes(piece, starts, ends, table))
        places.append(starts + low)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    place = np.concatenate(places)
    bounds = np.searchsorted(place, offsets)
    return np.concatenate(hashes), place, np.diff(bounds)


_KINDS = np.ones(256, dtype=np.uint8)
_KINDS[[33 <= b < 127 and not chr(b).isalnum() for b in range(256)]] = 2
_KINDS[SPACE] = 0


def segments(counts: np.ndarray) -> np.ndarray:
    """Start of every row's values in one flat array, and the end of the last."""
    out = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def shingles(hashes: np.ndarray, counts: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of runs of ``width`` words, number by row); a shorter row is one run of all its words."""
    at = segments(counts)
    factors = odd_constants(71, width + 1)
    out_counts = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    out_at = segments(out_counts)
    rows = np.repeat(np.arange(len(counts)), out_counts)
    first = at[rows] + np.arange(out_at[-1]) - out_at[rows]
    length = np.minimum(counts, width)[rows]
    total = length.astype(np.uint64) * factors[width]
    for k in range(width):
        here = length > k
        if here.all():
            total += hashes[first + k] * factors[k]
        else:
            total[here] += hashes[first[here] + k] * factors[k]
    return mixed(total), out_counts


def distinct(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's values sorted and without repeats."""
    at, flat = segments(counts), values.copy()
    for low, high in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        flat[low:high].sort()
    fresh = np.ones(len(flat) + 1, dtype=bool)
    fresh[1:-1] = flat[1:] != flat[:-1]
    fresh[at] = True
    before = np.zeros(len(flat) + 1, dtype=np.int64)
    np.cumsum(fresh[:-1], out=before[1:])
    return flat[fresh[:-1]], before[at[1:]] - before[at[:-1]]


def set_keys(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys of every row's set of values; equal sets have equal keys."""
    at = segments(counts)
    keys = []
    for salt in odd_constants(5, 2):
        total = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(mixed(values ^ salt), out=total[1:])
        keys.append(mixed(total[at[1:]] - total[at[:-1]]).view(np.int64))
    return keys[0], keys[1]


def signatures(values: np.ndarray, counts: np.ndarray, size: int, seed: int = 11) -> np.ndarray:
    """MinHash signatures, rows x ``size`` of int32; rows without values must be left out before."""
    starts = segments(counts)[:-1]
    out = np.empty((len(counts), size), dtype=np.int32)
    if not len(counts):
        return out
    salts, factors = odd_constants(seed, size), odd_constants(seed + 1, size)
    for k in range(size):
        least = np.minimum.reduceat((values ^ salts[k]) * factors[k], starts)
        out[:, k] = (least >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return out


def packed(flat: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A flat array as an Arrow list column."""
    return pa.ListArray.from_arrays(pa.array(segments(counts).astype(np.int32)), pa.array(flat, type=kind))
