"""Components of near-duplicate links, without listing the pairs of large groups.

Nodes are distinct sets of 64-bit hashes. ``marks`` are values by which similar nodes meet: two nodes that agree in some
mark fall into one bucket. Linking takes two looks:

1. Star: every node is held against the least node of each of its buckets, on full sets. That is one pair per posting.
2. Rest: buckets that still hold several components are cut into blocks, and pairs of blocks are compared in tasks of
   bounded size. Pairs inside one component are skipped, all others are held against each other on full sets; a task
   gives out a forest of links, never the pairs.

So every pair that shares a bucket is either confirmed, refuted, or already connected.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chalkline.llm import words
from chalkline.session import BROADCAST_ROWS, materialized

# Nodes in one block of a large bucket.
BLOCK = 512
# Cells of up to so many rows are compared many at once, in groups of about so many bytes.
FEW = 64
GROUP_BYTES = 1 << 20
# Bits that a set is folded into, and pairs that are looked at together.
FOLD = 2048
PAIRS = 1 << 15


def forest(a: np.ndarray, b: np.ndarray) -> dict[int, int]:
    """Node -> least node reachable in these links, for nodes that are not the least themselves."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        path = []
        while x in above:
            path.append(x)
            x = above[x]
        for y in path[:-1]:
            above[y] = x
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = top(x), top(y)
        if x != y:
            above[max(x, y)] = min(x, y)
    return {x: top(x) for x in above}


# Links that one local union-find takes at once: bounds its memory, whatever the partition holds.
LOCAL_LINKS = 500_000


def _local_forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []

    def flush():
        above = forest(
            np.concatenate([x.column(0).to_numpy() for x in held]), np.concatenate([x.column(1).to_numpy() for x in held])
        )
        return pa.RecordBatch.from_arrays(
            [pa.array(list(above.keys()), pa.int64()), pa.array(list(above.values()), pa.int64())], ["u", "v"]
        )

    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= LOCAL_LINKS:
            yield flush()
            held.clear()
    if held:
        yield flush()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``node``, ``component`` (the least node reachable) of every node in links ``(a, b)``, two longs.

    Distributed union-find: each partition reduces its links to a forest, then large-star and small-star rounds merge
    the forests until nothing changes; each round is written to the shared folder. Only a count and a checksum of a
    round reach the driver. No links give no rows.
    """
    tree = materialized(
        links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .mapInArrow(_local_forests, "u long, v long").distinct(),
        name,
    )
    seen = None
    while True:
        mark = tree.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or mark[0] == 0:
            break
        seen = mark
        # large star: each node's larger neighbours hang under its least neighbour
        both = tree.union(tree.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
        # small star: smaller neighbours and the node itself hang under the least of them
        least = large.groupBy("u").agg(F.min("v").alias("least"))
        small = large.join(least, "u").where("v != least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        tree = materialized(small.union(least.select("u", F.col("least").alias("v"))).distinct(), name)
    roots = tree.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return tree.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def within(df: DataFrame, keys: DataFrame, on: list[str], rows: int) -> DataFrame:
    """Inner join with ``keys``, broadcast only if their counted ``rows`` are few."""
    return df.join(F.broadcast(keys) if rows <= BROADCAST_ROWS else keys, on)


def shared_buckets(postings: DataFrame) -> DataFrame:
    """Postings ``(mark, value, node)`` whose bucket holds others too, with its ``size`` and ``center``, its least node."""
    bucket = Window.partitionBy("value", "mark")  # sorted by the first column, and few values are the same
    return postings.withColumns(
        {"size": F.count("*").over(bucket), "center": F.min("node").over(bucket)}
    ).where("size > 1")


def sets_fit(a: Column, b: Column, percent: int) -> Column:
    """100 * intersection >= percent * union of two arrays without repeats."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b))
    return F.when(small * 100 < large * percent, False).otherwise(both * 100 >= (small + large - both) * percent)


def _confirmed(pairs: DataFrame, sets: DataFrame, fits: Callable[[Column, Column], Column]) -> DataFrame:
    """Pairs ``(a, b)`` whose contents fit."""
    left = sets.select(F.col("node").alias("a"), F.col("content").alias("content_a"))
    right = sets.select(F.col("node").alias("b"), F.col("content").alias("content_b"))
    return pairs.join(left, "a").join(right, "b").where(fits(F.col("content_a"), F.col("content_b"))).select("a", "b")


class ArrayContents:
    """Contents of a cell that are lists of longs without repeats."""

    def __init__(self, column: pa.Array):
        offsets = column.offsets.to_numpy()
        self.sizes = np.diff(offsets).astype(np.int64)
        self.flat = column.values.to_numpy()[offsets[0] : offsets[-1]]
        self.bits: np.ndarray | None = None

    def may_fit(self, i: int, rest: np.ndarray, percent: int) -> np.ndarray:
        return np.minimum(self.sizes[rest], self.sizes[i]) * 100 >= np.maximum(self.sizes[rest], self.sizes[i]) * percent

    def fit(self, i: int, rest: np.ndarray, percent: int) -> np.ndarray:
        """Those of ``rest`` that are similar to ``i``: common values are common bits."""
        if self.bits is None:
            self.bits = self._bits()
        both = np.bitwise_count(self.bits[rest] & self.bits[i]).sum(axis=1).astype(np.int64)
        return rest[both * 100 >= (self.sizes[rest] + self.sizes[i] - both) * percent]

    def fit_pairs(self, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
        """Whether the rows of each pair are similar.

        A row's values are folded into bits first. A bit that one row has and the other has not is a value that is not in
        both, so most pairs are ruled out by counts of bits; the others are held against each other value by value.
        """
        starts = words.segments(self.sizes)
        folded = np.zeros((len(self.sizes), FOLD), dtype=bool)
        folded[np.repeat(np.arange(len(self.sizes)), self.sizes), self.flat.view(np.uint64) % np.uint64(FOLD)] = True
        folded = np.packbits(folded, axis=1).view(np.uint64)
        # values that fell on a bit that another one has
        hidden = self.sizes - np.bitwise_count(folded).sum(axis=1).astype(np.int64)
        out = np.zeros(len(a), dtype=bool)
        for first in range(0, len(a), PAIRS):
            x, y = a[first : first + PAIRS], b[first : first + PAIRS]
            both = np.bitwise_count(folded[x] & folded[y]).sum(axis=1).astype(np.int64) + np.minimum(hidden[x], hidden[y])
            may = np.flatnonzero(both * 100 >= (self.sizes[x] + self.sizes[y] - both) * percent)
            for k in may.tolist():
                i, j = x[k], y[k]
                values = np.sort(np.concatenate([self.flat[starts[i] : starts[i + 1]], self.flat[starts[j] : starts[j + 1]]]))
                same = int((values[1:] == values[:-1]).sum())
                out[first + k] = same * 100 >= (len(values) - same) * percent
        return out

    def _bits(self) -> np.ndarray:
        """Rows of bits over the values that two rows at least hold."""
        _, place, times = np.unique(self.flat, return_inverse=True, return_counts=True)
        rank = np.cumsum(times > 1) - 1
        several = times[place] > 1
        row, bit = np.repeat(np.arange(len(self.sizes)), self.sizes)[several], rank[place[several]]
        out = np.zeros((len(self.sizes), int(rank[-1]) // 64 + 1 if len(rank) else 1), dtype=np.uint64)
        np.bitwise_or.at(out, (row, bit >> 6), np.uint64(1) << (bit & 63).astype(np.uint64))
        return out


def _compare(cell: pa.RecordBatch, contents, min_hits: int, percent: int) -> tuple[list[int], list[int]]:
    """A forest of the links in one pair of blocks that join different components."""
    low, high, here = (cell.column(c)[0].as_py() for c in ("low", "high", "mark"))
    block, node, posted = (cell.column(c).to_numpy() for c in ("block", "node", "posted"))
    component = cell.column("component").to_numpy().copy()
    own, other = np.flatnonzero(block == low), np.flatnonzero(block == high)
    central = node == cell.column("center")[0].as_py()
    apart = component[~central]
    if not len(apart) or (apart == apart[0]).all():  # all but the center, which has been looked at, are connected
        return [], []
    marks = cell.column("marks").flatten().to_numpy().reshape(len(node), -1)
    places = np.arange(marks.shape[1])
    held = None
    out_a, out_b = [], []
    for i in own[~central[own]].tolist():
        rest = other[other > i] if low == high else other
        rest = rest[(component[rest] != component[i]) & ~central[rest]]
        if not len(rest):
            continue
        held = contents(cell.column("content")) if held is None else held
        rest = rest[held.may_fit(i, rest, percent)]
        if not len(rest):
            continue
        equal = marks[rest] == marks[i]
        rest, equal = rest[enough := equal.sum(axis=1) >= min_hits], equal[enough]
        # a pair is looked at in the first bucket that both are posted to
        shared = equal & ((posted[rest, None] & posted[i]) >> places & 1).astype(bool)
        for j in held.fit(i, rest[shared.argmax(axis=1) == here], percent).tolist():
            x, y = component[i], component[j]
            if x != y:
                component[component == max(x, y)] = min(x, y)
                out_a.append(int(node[i]))
                out_b.append(int(node[j]))
    return out_a, out_b


def _compare_few(rows: pa.RecordBatch, cell: np.ndarray, contents, min_hits: int, percent: int) -> tuple[list[int], list[int]]:
    """A forest of the links in several small cells, whose pairs are all listed; ``cell`` has a row's cell, in order."""
    node, component, block, posted, here = (rows.column(c).to_numpy() for c in ("node", "component", "block", "posted", "mark"))
    behind = np.searchsorted(cell, cell, side="right") - 1 - np.arange(len(cell))
    a = np.repeat(np.arange(len(cell)), behind)
    b = a + 1 + np.arange(len(a)) - np.repeat(words.segments(behind)[:-1], behind)
    central = node == rows.column("center").to_numpy()
    one_block = rows.column("low").to_numpy() == rows.column("high").to_numpy()
    open_pair = (component[a] != component[b]) & ~central[a] & ~central[b] & (one_block[a] | (block[a] != block[b]))
    a, b = a[open_pair], b[open_pair]
    if not len(a):
        return [], []
    marks = rows.column("marks").flatten().to_numpy().reshape(len(node), -1)
    equal = marks[a] == marks[b]
    # a pair is looked at in the first bucket that both are posted to
    shared = equal & (((posted[a] & posted[b])[:, None] >> np.arange(marks.shape[1])) & 1).astype(bool)
    wanted = (equal.sum(axis=1) >= min_hits) & (shared.argmax(axis=1) == here[a])
    a, b = a[wanted], b[wanted]
    if not len(a):
        return [], []
    both = np.concatenate([a, b])
    _, first, place = np.unique(node[both], return_index=True, return_inverse=True)
    held = contents(rows.column("content").take(pa.array(both[first])))
    fit = held.fit_pairs(place[: len(a)], place[len(a) :], percent)
    above = forest(node[a[fit]], node[b[fit]])
    return list(above.keys()), list(above.values())


CELL_KEYS = ["mark", "value", "low", "high"]


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Whole cells of a partition that is sorted by cell, and the first row of each; the last one is held back."""
    held: list[pa.RecordBatch] = []

    def starts(batch: pa.RecordBatch) -> np.ndarray:
        changed = np.zeros(batch.num_rows, dtype=bool)
        changed[0] = True
        for c in CELL_KEYS:
            changed[1:] |= np.diff(batch.column(c).to_numpy()) != 0
        return np.flatnonzero(changed)

    def whole() -> tuple[pa.RecordBatch, np.ndarray]:
        batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0] if len(held) > 1 else held[0]
        return batch, starts(batch)

    for batch in batches:
        if not batch.num_rows:
            continue
        last = int(starts(batch)[-1])
        if held and last == 0 and all(held[0].column(c)[-1] == batch.column(c)[0] for c in CELL_KEYS):
            held.append(batch)
            continue
        if last:
            held.append(batch.slice(0, last))
        if held:
            yield whole()
        held = [batch.slice(last)]
    if held:
        yield whole()


def _rest(contents, min_hits: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for batch, starts in _cells(batches):
            sizes = np.diff(np.r_[starts, batch.num_rows])
            cell = np.repeat(np.arange(len(sizes)), sizes)
            found = [
                _compare(batch.slice(int(starts[k]), int(sizes[k])), contents, min_hits, percent) for k in np.flatnonzero(sizes > FEW).tolist()
            ]
            few = np.flatnonzero(sizes[cell] <= FEW)
            # cut where a cell ends, by the bytes before it
            bytes_before = np.r_[0, np.cumsum(_sizes(batch.column("content"))[few])]
            ends = np.flatnonzero(np.r_[cell[few][1:] != cell[few][:-1], True]) + 1 if len(few) else few
            group = bytes_before[ends] // GROUP_BYTES
            cuts = [0, *ends[np.flatnonzero(np.diff(group))].tolist(), len(few)]
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                at = few[low:high]
                found.append(_compare_few(batch.take(pa.array(at)), cell[at], contents, min_hits, percent))
            for more_a, more_b in found:
                a += more_a
                b += more_b
            if len(a) >= LOCAL_LINKS:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _sizes(column: pa.Array) -> np.ndarray:
    """Bytes of each row of texts or lists of longs."""
    if pa.types.is_list(column.type):
        return np.diff(column.offsets.to_numpy()).astype(np.int64) * 8
    return np.diff(words.buffers(column)[1])


def linked(
    buckets: DataFrame, nodes: DataFrame, sets: DataFrame, min_hits: int, percent: int,
    fits: Callable[[Column, Column], Column] | None = None, contents: type = ArrayContents,
) -> DataFrame:
    """``node``, ``component`` of all nodes with a link.

    ``buckets``: a written table from ``shared_buckets``, with ``hits``, the marks that node and center have in common.
    ``nodes``: node, marks (array of values, one for each mark), posted (a bit for each mark it is posted to).
    ``sets``: node, content (array of longs without repeats) of all nodes in ``buckets``. A link needs ``min_hits``
    common marks and 100 * intersection >= ``percent`` * union. Contents of another kind come with ``fits``, which
    tells that of two columns, and a class like ``ArrayContents``, which holds them in a task.
    """
    fits = fits or (lambda a, b: sets_fit(a, b, percent))
    stars = buckets.where(f"node != center and hits >= {min_hits}").select(F.col("center").alias("a"), F.col("node").alias("b"))
    first = materialized(_confirmed(stars.distinct(), sets, fits), "star-links")
    labels = materialized(components(first), "labels")
    bucket = Window.partitionBy("mark", "value")
    open_buckets = (
        buckets.where("size > 2").join(labels, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .withColumns({"least": F.min("component").over(bucket), "most": F.max("component").over(bucket)})
        .where("least != most")
        .withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
        .select("mark", "value", "center", "node", "component", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("x"))
        .select("mark", "value", "center", "node", "component", "block", F.least("block", "x").alias("low"), F.greatest("block", "x").alias("high"))
    )
    # a number of its own, as a cell's work follows the square of its rows and adaptive execution counts bytes
    parts = int(buckets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = open_buckets.join(nodes, "node").join(sets, "node").repartition(parts, *CELL_KEYS).sortWithinPartitions(*CELL_KEYS)
    second = materialized(
        cells.mapInArrow(_rest(contents, min_hits, percent), "a long, b long"),
        "rest-links",
    )
    if second.isEmpty():
        return labels
    return components(first.union(second))
