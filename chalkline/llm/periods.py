"""Periodic runs of words by online dyadic square catching."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chalkline.llm import words

# Words in a run at least, whatever its period.
LEAST = 12
# Bytes of text whose words are watched together.
_GROUP = 1 << 21
_STEP = words.odd_constants(61, 1)[0]


class Grown:
    """An array of 64-bit names that is appended to."""

    def __init__(self):
        self.held, self.n = np.empty(1024, dtype=np.uint64), 0

    def append(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self.held):
            wider = np.empty(max(2 * len(self.held), self.n + len(values)), dtype=np.uint64)
            wider[: self.n] = self.held[: self.n]
            self.held = wider
        self.held[self.n : self.n + len(values)] = values
        self.n += len(values)

    @property
    def values(self) -> np.ndarray:
        return self.held[: self.n]


class Catchers:
    """Watches a growing sequence of symbols for squares.

    Level k has a catcher for each completed block of 2^k symbols that begins at a multiple of 2^k. It waits for its
    block to come again at one of the level's distances p. Two words p apart agree over p symbols in a square, and over
    ``least`` - p in a short run, and the level of p is the largest whose blocks must have one whole within so long a
    stretch, 2^(k+1) - 1 symbols. So every run is caught. Each appended symbol completes one string of 2^k symbols at
    every level, and that string is held against the few catchers which wait for it just then.

    ``belongs`` numbers the texts: a catcher does not wait for symbols of another one.
    """

    def __init__(self, least: int = LEAST, longest: int | None = None):
        self.least, self.longest = least, longest
        self.names: list[Grown] = [Grown()]
        self.texts = Grown()
        self.caught: list[list[tuple[np.ndarray, np.ndarray]]] = [[]]

    def distances(self, k: int) -> list[tuple[int, int]]:
        """Intervals of the distances that level k watches."""
        low, high = 2 ** (k + 1) - 1, 2 ** (k + 2) - 2
        half = (self.least + 1) // 2
        short = max(1, self.least - high), min(half - 1, self.least - low)
        long = max(low, half), high
        # of the lowest level are also the distances that leave no larger block
        long = (half, long[1]) if k == 0 else long
        short = (short[0], half - 1) if k == 0 else short
        return [x for x in (short, long) if x[0] <= x[1]]

    def append(self, symbols: np.ndarray, belongs: np.ndarray) -> None:
        """More symbols (64-bit hashes), with the number of the text that each is of."""
        self.names[0].append(words.mixed(symbols ^ _STEP))
        self.texts.append(belongs.astype(np.uint64))
        total = self.names[0].n
        longest = total if self.longest is None else self.longest
        k = 0
        while 2 ** (k + 1) - 1 <= max(longest // 2, self.least):
            if k == len(self.names):
                self.names.append(Grown())
                self.caught.append([])
            here = self.names[k]
            if k:
                below, half = self.names[k - 1].values, 1 << (k - 1)
                fresh = np.arange(here.n, max(here.n, total - 2 * half + 1))
                first = len(fresh) and fresh[0]
                here.append(words.mixed(below[first : first + len(fresh)] * _STEP + below[first + half : first + half + len(fresh)]))
            else:
                fresh = np.arange(total - len(symbols), total)
            if len(fresh):
                self._compare(k, fresh)
            k += 1

    def _compare(self, k: int, ends: np.ndarray) -> None:
        """Strings of 2^k symbols that begin at ``ends`` against the catchers that wait for them."""
        names, texts = self.names[k].values, self.texts.values
        mine = names[ends[0] : ends[-1] + 1]
        for low, high in self.distances(k):
            nearest = (ends - low) >> k << k
            for back in range(0, high - low + (1 << k), 1 << k):
                begin = nearest - back
                hit = names[np.maximum(begin, 0)] == mine
                hit &= (begin >= 0) & (ends - begin <= high)
                at = np.flatnonzero(hit)
                at = at[texts[begin[at]] == texts[ends[at]]]
                if len(at):
                    self.caught[k].append((begin[at], ends[at] - begin[at]))

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and smallest period of all runs so far, by start, then period."""
        found = [self._merged(k) for k in range(len(self.names)) if self.caught[k]]
        start, length, period = (np.concatenate(x) for x in zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 3
        # a run is also caught by multiples of its period
        order = np.lexsort((period, length, start))
        start, length, period = start[order], length[order], period[order]
        fresh = np.ones(len(start), dtype=bool)
        fresh[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
        order = np.lexsort((period[fresh], start[fresh]))
        return start[fresh][order], length[fresh][order], period[fresh][order]

    def _merged(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Squares of one level: neighbouring blocks caught at one distance are one stretch of agreement, whose ends lie
        less than a block further on, as the next block was not caught."""
        begin, p = (np.concatenate(x) for x in zip(*self.caught[k], strict=True))
        order = np.lexsort((begin, p))
        begin, p = begin[order], p[order]
        cut = np.ones(len(begin), dtype=bool)
        cut[1:] = (p[1:] != p[:-1]) | (begin[1:] - begin[:-1] != 1 << k)
        first, last = np.flatnonzero(cut), np.r_[np.flatnonzero(cut)[1:], len(begin)] - 1
        left, right, p = begin[first].copy(), begin[last] + (1 << k), p[first]
        texts = self.texts.values
        for q in range(k - 1, -1, -1):
            names, size = self.names[q].values, 1 << q
            to = left - size
            same = (to >= 0) & (names[np.maximum(to, 0)] == names[np.maximum(to, 0) + p])
            left = np.where(same, to, left)
            beyond = right + p + size > len(texts)
            at = np.where(beyond, 0, right)
            same = ~beyond & (names[at] == names[np.where(beyond, 0, right + p)])
            right = np.where(same, right + size, right)
        length = right - left + p
        fits = length >= np.maximum(self.least, 2 * p)
        return left[fits], length[fits], p[fits]


def _bounds(body: np.ndarray, offsets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """End of each word."""
    last = np.zeros(len(body) + 1, dtype=bool)
    last[:-1] = words.SPACE[body]
    last[offsets] = True
    stops = np.flatnonzero(last)
    return stops[np.searchsorted(stops, starts, side="right")]


def _covered(n: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which of n places lie in [low, high) of any pair."""
    depth = np.zeros(n + 1, dtype=np.int64)
    np.add.at(depth, low, 1)
    np.add.at(depth, high, -1)
    return np.cumsum(depth[:-1]) > 0


def _watched(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, offsets = words.buffers(batch.column(1))
            for low, high in words.row_groups(offsets, _GROUP):
                part, bounds = body[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
                hashes, starts, counts = words.word_hashes(part, bounds, fold=False)
                text = np.repeat(np.arange(len(counts)), counts)
                # no run reaches over a symbol that occurs once: one behind each text keeps them apart
                gaps = np.cumsum(counts)
                catchers = Catchers(least, int(counts.max(initial=0)))
                unique = words.mixed(np.arange(1, len(counts) + 1, dtype=np.uint64))
                catchers.append(np.insert(hashes, gaps, unique), np.insert(text, gaps, np.arange(len(counts))))
                begin, length, period = catchers.runs()
                own = catchers.texts.values[begin].astype(np.int64)
                begin = begin - own  # places without the symbols between texts
                kept = ~_covered(len(hashes), begin + period, begin + length)
                first = words.segments(counts)
                per_text = np.bincount(own, minlength=len(counts))
                at = pa.array(words.segments(per_text).astype(np.int32))
                runs = pa.StructArray.from_arrays([pa.array(begin - first[own]), pa.array(length), pa.array(period)], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low), pa.array(counts), pa.ListArray.from_arrays(at, runs),
                        _collapsed(part, bounds, starts, text, kept),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return run


def _collapsed(body: np.ndarray, offsets: np.ndarray, starts: np.ndarray, text: np.ndarray, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    ends = _bounds(body, offsets, starts)[kept]
    starts, text = starts[kept], text[kept]
    stays = _covered(len(body), starts, ends)
    follow = ends[:-1][text[1:] == text[:-1]] if len(ends) else ends
    stays[follow] = True  # the separator behind a word that another one follows
    made = body.copy()
    made[follow] = 32
    at = np.zeros(len(body) + 1, dtype=np.int64)
    np.cumsum(stays, out=at[1:])
    return pa.Array.from_buffers(
        pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(at[offsets])), pa.py_buffer(made[stays].tobytes())]
    ).cast(pa.string())


def runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``runs`` and ``collapsed``.

    A run is a longest stretch of words whose smallest period q occurs twice at least and that has ``least`` words or
    more; ``runs`` lists their start (word number from 0), length and period, by start, then period. ``collapsed`` is
    the text without the words that any run holds after its first q, joined by single spaces. Words are runs of
    characters other than the six ASCII separators, and equal if their bytes are.

    Squares are caught online, see ``Catchers``; the words of a few texts are appended together, so that numpy advances
    all catchers of a level at once. A text needs some 8 bytes a word for each power of two up to its length. Rows do
    not depend on each other: no shuffle. Null, empty and blank texts have no words, no runs and an empty collapsed
    text. Rows repeated whole give a row each; a null doc_id is carried along. Other columns are not read. No rows give
    no rows.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        _watched(least),
        f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string",
    )
