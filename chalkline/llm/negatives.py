"""Hard-negative mining in a multiway hyperplane tree with distance ranges (GNAT)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from chalkline.llm import grid, vectors
from chalkline.llm.nearest import _flat, _lifted, whole
from chalkline.llm.links import within
from chalkline.session import materialized

POSITIVES = 5
NEGATIVES = 3
# A negative's score lies between so many percent of the positive's.
LEAST, MOST = 50, 95
# Split points of a node at most.
WIDTH = 16
# Anchors to a block of the grid.
ANCHORS = 512

_FILED = "row long, vec_id long, label long, size int, leaf int, vector array<double>"
_CELL = ["size", "line", "pillar"]
_CELLS = (
    "size int, line int, pillar int, kind int, leaf int, row long, vec_id long, label long, vector array<double>, "
    "lows array<long>, highs array<long>, leaves array<int>"
)


class Tree:
    """Each node has split points; a vector belongs to the subtree of the nearest one. Of a node, split point i and
    subtree j, ``low`` and ``high`` hold the range of the distances from i to all vectors of j."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.points: list[np.ndarray] = []
        self.children: list[list[int]] = []  # a node's number, or ~leaf
        self.leaves = 0
        self.root = self._grow(sample, leaves)
        self.low = [np.full((len(p), len(p)), np.inf) for p in self.points]
        self.high = [np.full((len(p), len(p)), -np.inf) for p in self.points]

    def _grow(self, sample: np.ndarray, leaves: int) -> int:
        sample = np.unique(sample, axis=0)
        if leaves < 2 or len(sample) < 2 * min(WIDTH, leaves):
            self.leaves += 1
            return ~(self.leaves - 1)
        chosen = [0]
        far = vectors.distances(sample, sample[:1])[:, 0]
        for _ in range(min(WIDTH, leaves) - 1):  # far from each other
            chosen.append(int(far.argmax()))
            far = np.minimum(far, vectors.distances(sample, sample[chosen[-1:]])[:, 0])
        node = len(self.points)
        self.points.append(sample[chosen])
        self.children.append([])
        home = vectors.distances(sample, sample[chosen]).argmin(axis=1)
        for j in range(len(chosen)):
            own = sample[home == j]
            self.children[node].append(self._grow(own, round(leaves * len(own) / len(sample))))
        return node

    def descend(self, points: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray]]]:
        """Leaf of each point, and for each node it came through: (node, distances to its split points, subtree)."""
        leaf, seen = np.zeros(len(points), dtype=np.int32), []
        waiting = [(self.root, np.arange(len(points)))]
        while waiting:
            node, at = waiting.pop()
            if node < 0:
                leaf[at] = ~node
                continue
            far = vectors.distances(points[at], self.points[node])
            home = far.argmin(axis=1)
            seen.append((node, far, home))
            waiting += [(child, at[home == j]) for j, child in enumerate(self.children[node]) if (home == j).any()]
        return leaf, seen

    def within(self, points: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
        """points x leaves: whether a leaf may hold vectors at a distance from ``near`` to ``far``.

        A vector of subtree j is d(q, i) + high away at most, and d(q, i) - high or low - d(q, i) at least, for every
        split point i. A sibling whose range leaves out the annulus goes with all that is below it.
        """
        out = np.zeros((len(points), self.leaves), dtype=bool)
        waiting = [(self.root, np.arange(len(points)))]
        while waiting:
            node, at = waiting.pop()
            if node < 0:
                out[at, ~node] = True
                continue
            to = vectors.distances(points[at], self.points[node])[:, :, None]
            most = (to + self.high[node]).min(axis=1)
            least = np.maximum(to - self.high[node], self.low[node] - to).max(axis=1)
            open_ = (most >= near[at][:, None]) & (least <= far[at][:, None])
            waiting += [(child, at[open_[:, j]]) for j, child in enumerate(self.children[node]) if open_[:, j].any()]
        return out


def _rounded(scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, matrix in vectors.matrices(batch.column(3)):
                points, taken = whole(matrix, scale), pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).take(taken) for c in range(3)), pa.array(np.full(len(at), matrix.shape[1], np.int32)),
                        vectors.lists(points), pa.array((points * points).sum(axis=1)),
                    ],
                    ["row", "vec_id", "label", "size", "vector", "square"],
                )

    return run


def _filed(trees: dict[int, Tree], tops: dict[int, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, points in vectors.matrices(batch.column(4)):
                leaf, _ = trees[points.shape[1]].descend(_lifted(points, tops[points.shape[1]]))
                taken = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(taken) for c in range(4)), pa.array(leaf), batch.column(4).take(taken)],
                    ["row", "vec_id", "label", "size", "leaf", "vector"],
                )

    return run


def _ranges(trees: dict[int, Tree], tops: dict[int, float]):
    """Least and largest distance of a batch's vectors from split point i of a node, by subtree j."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for _, points in vectors.matrices(batch.column(0)):
                size = points.shape[1]
                for node, far, home in trees[size].descend(_lifted(points, tops[size]))[1]:
                    for j in np.unique(home).tolist():
                        own = far[home == j]
                        out += [(size, node, i, j, a, b) for i, (a, b) in enumerate(zip(own.min(axis=0).tolist(), own.max(axis=0).tolist(), strict=True))]
            kinds = [pa.int32()] * 4 + [pa.float64()] * 2
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["size", "node", "i", "j", "low", "high"])

    return run


def _routed(trees: dict[int, Tree], tops: dict[int, float], lines: dict, pillars: dict, home: str):
    """Anchors, once for each column of the grid that has leaves they need: those within the annulus of their windows of
    scores; ``home`` says whether only the anchor's own leaf is meant, all but that, or any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            lows, highs = (batch.column(c).to_pylist() for c in ("lows", "highs"))
            rows, own = batch.column("row").to_numpy(), batch.column("leaf").to_numpy()
            for at, points in vectors.matrices(batch.column("vector")):
                size = points.shape[1]
                tree, flat = trees[size], _flat(points)
                if home == "only":
                    open_ = np.zeros((len(at), tree.leaves), dtype=bool)
                    open_[np.arange(len(at)), own[at]] = True
                else:
                    # a score s is a distance d with d^2 = |q|^2 + top - 2s
                    total = (points * points).sum(axis=1) + tops[size]
                    slack = 1e-6 * np.sqrt(total) + 1e-6
                    near = np.sqrt(np.maximum(total - 2.0 * np.array([max(highs[k]) for k in at.tolist()]), 0)) - slack
                    far = np.sqrt(np.maximum(total - 2.0 * np.array([min(lows[k]) for k in at.tolist()]), 0)) + slack
                    open_ = tree.within(flat, near, far)
                    if home == "others":
                        open_[np.arange(len(at)), own[at]] = False
                for k, mine in zip(at.tolist(), open_, strict=True):
                    line = lines[size, int(own[k])]
                    by_pillar: dict[int, list[int]] = {}
                    for leaf in np.flatnonzero(mine).tolist():
                        for pillar in pillars.get((size, leaf), ()):
                            by_pillar.setdefault(pillar, []).append(leaf)
                    out += [(k, size, line[int(rows[k]) % len(line)], pillar, leaves) for pillar, leaves in by_pillar.items()]
            k, size, line, pillar, leaves = zip(*out, strict=True) if out else [[]] * 5
            taken = batch.take(pa.array(k, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(size, pa.int32()), pa.array(line, pa.int32()), pa.array(pillar, pa.int32()), pa.array([0] * len(k), pa.int32()),
                    *(taken.column(c) for c in ("leaf", "row", "vec_id", "label", "vector", "lows", "highs")), pa.array(leaves, pa.list_(pa.int32())),
                ],
                ["size", "line", "pillar", "kind", "leaf", "row", "vec_id", "label", "vector", "lows", "highs", "leaves"],
            )

    return run


class _Cell:
    """Anchors of a cell; leaves stream past them."""

    def __init__(self, asking: pa.RecordBatch, k: int, same: bool):
        self.points = next(m for _, m in vectors.matrices(asking.column("vector")))
        self.row, self.label = (asking.column(c).to_numpy() for c in ("row", "label"))
        self.low, self.high = (np.array(asking.column(c).to_pylist(), dtype=np.int64) for c in ("lows", "highs"))
        self.same, self.best = same, grid.Best(len(self.row), self.low.shape[1], k)
        self.of_leaf: dict[int, list[int]] = {}
        for at, leaves in enumerate(asking.column("leaves").to_pylist()):
            for leaf in leaves:
                self.of_leaf.setdefault(leaf, []).append(at)

    def feed(self, part: pa.RecordBatch) -> None:
        leaf = part.column("leaf").to_numpy()
        points = next(m for _, m in vectors.matrices(part.column("vector")))
        ids, row, label = (part.column(c).to_numpy() for c in ("vec_id", "row", "label"))
        for name in np.unique(leaf).tolist():
            anchors = np.array(self.of_leaf.get(name, []), dtype=np.int64)
            here = np.flatnonzero(leaf == name)
            here = here[np.argsort(ids[here], kind="stable")]
            for first in range(0, len(anchors), 256):
                at = anchors[first : first + 256]
                allowed = (self.label[at][:, None] == label[here]) == self.same
                allowed &= self.row[at][:, None] != row[here]
                self.best.add(at, grid.products(self.points[at], points[here]), ids[here], allowed, self.low[at], self.high[at])

    def end(self) -> pa.RecordBatch:
        at, window, ids, scores = self.best.found()
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (self.row[at], window, ids, scores)], ["row", "place", "vec_id", "score"])


class _Index:
    """All rows filed in the leaves of trees fitted on a bounded sample, and the search in them."""

    def __init__(self, rows: DataFrame, is_anchor: Column):
        self.spark = rows.sparkSession
        sizes = {r["size"]: (r["top"], r["n"]) for r in rows.groupBy("size").agg(F.max("square").alias("top"), F.count("*").alias("n")).collect()}
        self.tops = {size: top for size, (top, _) in sizes.items()}
        total = sum(n for _, n in sizes.values())
        wanted = min(vectors.MOST_PIVOTS, total // vectors.CELL + 1)
        sample = vectors.pivots(rows, "vector", 8 * wanted)
        self.trees = {
            size: Tree(_lifted(sample.get(size, np.zeros((1, size))), top), round(wanted * n / total)) for size, (top, n) in sizes.items()
        }
        filed = rows.select("row", "vec_id", "label", "size", "vector").mapInArrow(_filed(self.trees, self.tops), _FILED)
        self.filed = materialized(filed, "filed")
        ranges = self.filed.select("vector").mapInArrow(_ranges(self.trees, self.tops), "size int, node int, i int, j int, low double, high double")
        for r in ranges.groupBy("size", "node", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
            tree = self.trees[r["size"]]
            tree.low[r["node"]][r["i"], r["j"]], tree.high[r["node"]][r["i"], r["j"]] = r["low"], r["high"]
        self.anchors = self.filed.where(is_anchor)
        counts = self.filed.groupBy("size", "leaf").agg(F.count("*").alias("n"), F.count_if(is_anchor).alias("asking")).collect()
        asking = {(r["size"], r["leaf"]): r["asking"] for r in counts if r["asking"]}
        self.lines = grid.deal(asking, grid.lines(sum(asking.values()), ANCHORS))
        self.pillars = grid.deal({(r["size"], r["leaf"]): r["n"] for r in counts}, grid.lines(total, vectors.BLOCK))

    def search(self, anchors: DataFrame, k: int, same: bool, home: str, name: str) -> DataFrame:
        """``row`` of an anchor, ``place`` of a window, ``vec_id`` and ``score`` of the k best in it, by cell of the grid.

        ``anchors``: rows of the index with ``lows`` and ``highs``, the bounds of their windows.
        """
        routed = materialized(anchors.mapInArrow(_routed(self.trees, self.tops, self.lines, self.pillars, home), _CELLS), f"{name}-routes")
        # lines that need a leaf: no more than lines of the grid times leaves
        needs = materialized(routed.select("size", "line", F.explode("leaves").alias("leaf")).distinct(), f"{name}-needs")
        pillars = self.spark.createDataFrame(
            [(size, leaf, pillars) for (size, leaf), pillars in self.pillars.items()], "size int, leaf int, pillars array<int>"
        )
        asked = within(self.filed.join(F.broadcast(pillars), ["size", "leaf"]), needs, ["size", "leaf"], needs.count())
        none = F.array().cast("array<long>")
        asked = asked.select(
            "size", "line", F.get("pillars", F.pmod(F.xxhash64("row"), F.size("pillars")).cast("int")).alias("pillar"), F.lit(1).alias("kind"), "leaf",
            "row", "vec_id", "label", "vector", none.alias("lows"), none.alias("highs"), F.array().cast("array<int>").alias("leaves"),
        )
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        cells = routed.unionByName(asked).repartition(parts, *_CELL).sortWithinPartitions(*_CELL, "kind", "leaf")
        schema = pa.schema([(c, pa.int64()) for c in ("row", "place", "vec_id", "score")])
        solved = cells.mapInArrow(grid.streamed(_CELL, "kind", lambda asking: _Cell(asking, k, same), schema), "row long, place long, vec_id long, score long")
        return materialized(solved, name)


def hard_negatives(
    rows: DataFrame, is_anchor: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST, scale: float = 256.0,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score``, ``negative_score``.

    A score is the inner product of floor(scale * x) of both vectors; of equal ones the smaller vec_id comes first. An
    anchor's positives are the ``positives`` best other rows of its label. For each, the ``negatives`` best rows of other
    labels are returned whose score is from ``least`` to ``most`` percent of the positive's. ``is_anchor`` tells anchors
    by vec_id (a long).

    All rows are filed in a tree whose split points come from a bounded sample, at most eight vectors to each of its
    leaves (``vectors.MOST_PIVOTS`` at most). With one more coordinate, a window of scores is an annulus around the
    anchor, and ranges of distances rule out subtrees that it doesn't meet. Positives are sought in the anchor's own
    leaf first, which bounds their distance elsewhere. What is left is compared exactly, in the cells of a grid
    (``grid``), which bounds the copies where nothing is ruled out.

    Rows with a null vec_id, label or vector, or null or non-finite components, take no part; labels are whole numbers.
    Vectors of different length have no score. Rows repeated whole count once; different rows of one vec_id are rows of
    their own. Components beyond the range of a long are cut to it, scores beyond it wrap around. Other columns are not
    read. No rows, or no anchors, give no rows.
    """
    if not isinstance(rows.schema[label].dataType, IntegralType):
        raise ValueError(f"{label} is no whole number")
    used = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("vector"))
    used = used.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & vectors.finite("vector")).distinct()
    numbered = materialized(
        used.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "vector")
        .mapInArrow(_rounded(scale), "row long, vec_id long, label long, size int, vector array<double>, square double"),
        "mined",
    )
    index = _Index(numbered, is_anchor)
    far, all_scores = grid.Best.UNLIMITED, index.anchors.select("*", F.array(F.lit(-grid.Best.UNLIMITED)).alias("lows"))
    all_scores = all_scores.withColumn("highs", F.array(F.lit(far)))
    at_home = index.search(all_scores, positives, True, "only", "own-leaf")
    # the worst of the positives found at home bounds what is worth a look elsewhere
    by_score = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    enough = (
        at_home.withColumn("n", F.row_number().over(by_score)).where(F.col("n") == positives).select("row", F.col("score").alias("bound"))
    )
    elsewhere = all_scores.join(enough, "row", "left").withColumn("lows", F.array(F.coalesce("bound", F.lit(-far)))).drop("bound")
    found = at_home.unionByName(index.search(elsewhere, positives, True, "others", "other-leaves"))
    chosen = materialized(
        found.withColumn("n", F.row_number().over(by_score)).where(F.col("n") <= positives)
        .select("row", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), "n"),
        "positives",
    )
    # whole numbers s with least * p <= 100 * s <= most * p
    p = "cast(positive_score as decimal(20, 0))"
    low = F.expr(f"({p} * {least} + pmod(-{p} * {least}, 100)) div 100")
    high = F.expr(f"({p} * {most} - pmod({p} * {most}, 100)) div 100")
    windows = chosen.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("n", low.alias("low"), high.alias("high")))).alias("w"))
    spare = F.array_repeat(F.lit(far), positives)
    asking = (
        index.anchors.join(windows, "row")
        .withColumn("lows", F.slice(F.concat(F.col("w.low"), spare), 1, positives))
        .withColumn("highs", F.slice(F.concat(F.col("w.high"), F.transform(spare, lambda x: -x)), 1, positives))
        .drop("w")
        .where(F.exists(F.arrays_zip("lows", "highs"), lambda w: w["lows"] <= w["highs"]))
    )
    mined = index.search(asking, negatives, False, "any", "negatives").withColumn("n", F.col("place") + 1)
    order = Window.partitionBy("row", "n").orderBy(F.desc("score"), "vec_id")
    ranked = mined.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return (
        ranked.join(chosen, ["row", "n"]).join(index.anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
        .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )
