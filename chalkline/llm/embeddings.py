"""Embedding near-dedup by an exact metric range join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chalkline.llm import vectors
from chalkline.llm.links import components
from chalkline.session import materialized

LEAST_COSINE = 0.95
# Allowance for rounding where distances only rule out pairs.
SLACK = 1e-7

# Bytes of vectors in one block at most: a pair of blocks goes to a task as one row.
BLOCK_BYTES = 1 << 20

_BLOCK = "no long, size int, cell int, near array<boolean>, nodes binary, copies binary, points binary"
_PAIR = ("no", "size", "cell", "nodes", "copies", "points")


def _units(matrix: np.ndarray) -> np.ndarray:
    """Vectors of length 1; scaled first, so that no square under- or overflows."""
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _homes(centers: dict[int, np.ndarray], counts: dict[tuple[int, int], int] | None):
    """(node, copies, vector) with the length ``size``, the ``cell`` of the nearest pivot, the distance ``far`` to it
    and, with ``counts`` of the cells, the vector's ``block`` in its cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, matrix in vectors.matrices(batch.column(2)):
                size = matrix.shape[1]
                far = vectors.distances(_units(matrix), _middle(centers, size))
                home = far.argmin(axis=1)
                block = np.zeros(len(rows), dtype=np.int32)
                if counts is not None:
                    held = min(vectors.BLOCK, max(1, BLOCK_BYTES // (8 * size)))
                    blocks = np.array([-(-counts.get((size, k), 1) // held) for k in range(far.shape[1])], dtype=np.uint64)
                    mixed = batch.column(0).to_numpy()[rows].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                    block = ((mixed >> np.uint64(32)) % blocks[home]).astype(np.int32)
                taken = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(column.take(taken) for column in batch.columns), pa.array(np.full(len(rows), size, np.int32)),
                        pa.array(home.astype(np.int32)), pa.array(block), pa.array(far[np.arange(len(rows)), home]),
                    ],
                    [*batch.schema.names, "size", "cell", "block", "far"],
                )

    return run


def _middle(centers: dict[int, np.ndarray], size: int) -> np.ndarray:
    return _units(centers[size]) if size in centers else np.zeros((1, size))


def _near(points: np.ndarray, home: int, middle: np.ndarray, wide: np.ndarray, cells: np.ndarray, reach: float) -> np.ndarray:
    """Points of the cell ``home`` x ``cells``: whether that cell may hold vectors within ``reach`` of the point.

    It does not if the triangle inequality says that all of it is farther: by the cell's radius, d(v, i) > radius + reach,
    or by the plane between the two pivots, from which v is (d(v, i)^2 - d(v, home)^2) / 2 d(i, home) away.
    """
    far = vectors.distances(points, middle[cells])
    own = vectors.distances(points, middle[home : home + 1])
    apart = vectors.distances(middle[home : home + 1], middle[cells])
    return (far <= wide[cells] + reach + SLACK) & (far**2 - own**2 <= 2 * apart * (reach + SLACK) + SLACK)


def _wide(radii: dict[tuple[int, int], float], size: int, cells: int) -> np.ndarray:
    return np.array([radii.get((size, k), -10.0) for k in range(cells)])


def _packed(part: pa.Table, centers: dict[int, np.ndarray], radii: dict[tuple[int, int], float], reach: float) -> pa.Table:
    """A block of vectors as one row: unit vectors, and near which cells any of them is."""
    part = part.combine_chunks()
    size, cell, block = (part[c][0].as_py() for c in ("size", "cell", "block"))
    points = _units(next(vectors.matrices(part["vector"].chunk(0)))[1])
    middle = _middle(centers, size)
    near = _near(points, cell, middle, _wide(radii, size, len(middle)), np.arange(len(middle)), reach).any(axis=0)
    return pa.table({
        "no": pa.array([(cell << 40) + block], pa.int64()), "size": pa.array([size], pa.int32()), "cell": pa.array([cell], pa.int32()),
        "near": pa.array([near.tolist()], pa.list_(pa.bool_())), "nodes": pa.array([part["node"].to_numpy().tobytes()], pa.binary()),
        "copies": pa.array([part["copies"].to_numpy().tobytes()], pa.binary()), "points": pa.array([points.tobytes()], pa.binary()),
    })


class _Found:
    """What the pairs of blocks of a task find: number of linked vectors by node, and a forest of links.

    Held are a few numbers for each node of the blocks that were seen, whatever the number of links.
    """

    def __init__(self):
        self.begin: dict[tuple[int, int], int] = {}
        self.node = np.zeros(0, np.int64)
        self.linked = np.zeros(0, np.int64)
        self.label = np.zeros(0, np.int64)
        self.under: dict[int, list[int]] = {}
        self.forest: list[tuple[int, int]] = []

    def at(self, block: tuple[int, int], nodes: np.ndarray) -> int:
        """Place of a block's first node."""
        if block not in self.begin:
            self.begin[block] = len(self.node)
            self.label = np.r_[self.label, np.arange(len(self.node), len(self.node) + len(nodes))]
            self.node, self.linked = np.r_[self.node, nodes], np.r_[self.linked, np.zeros(len(nodes), np.int64)]
        return self.begin[block]

    def add(self, a: np.ndarray, b: np.ndarray, copies_a: np.ndarray, copies_b: np.ndarray) -> None:
        """Links between places, in order of ``a``."""
        np.add.at(self.linked, a, copies_b)
        np.add.at(self.linked, b, copies_a)
        cuts = np.flatnonzero(np.diff(a)) + 1
        for first, last in zip(np.r_[0, cuts], np.r_[cuts, len(a)], strict=True):
            labels = np.unique(np.r_[self.label[a[first]], self.label[b[first:last]]]).tolist()
            if len(labels) > 1:
                top = max(labels, key=lambda x: len(self.under.get(x, ())))
                mine = self.under.setdefault(top, [top])
                for label in labels:
                    if label != top:
                        rest = self.under.pop(label, [label])
                        self.label[rest] = top
                        mine += rest
                        self.forest.append((label, top))

    def rows(self) -> pa.RecordBatch:
        """Number of linked vectors by node (b null), and the forest (a, b)."""
        some = np.flatnonzero(self.linked)
        pairs = np.array(self.forest, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.r_[self.node[some], self.node[pairs[:, 0]]], pa.int64()),
                pa.array([None] * len(some) + self.node[pairs[:, 1]].tolist(), pa.int64()),
                pa.array(np.r_[self.linked[some], np.zeros(len(pairs), np.int64)], pa.int64()),
            ],
            ["a", "b", "links"],
        )


def _links(left: np.ndarray, right: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, columns) of the inner products from ``least`` on.

    Single precision rules out most: its error is far below the allowance.
    """
    size = left.shape[1]
    quick_left, quick_right = left.astype(np.float32), right.astype(np.float32).T
    floor = np.float32(least - (size + 8) * 2.0**-22)
    for begin in range(0, len(left), 512):
        rows, columns = np.nonzero(quick_left[begin : begin + 512] @ quick_right >= floor)
        if len(rows) * 50 > min(512, len(left) - begin) * len(right):
            rows, columns = np.nonzero(left[begin : begin + 512] @ right.T >= least)
        elif len(rows):
            sure = np.einsum("ij,ij->i", left[rows + begin], right[columns]) >= least
            rows, columns = rows[sure], columns[sure]
        if len(rows):
            yield rows + begin, columns


def _solve(centers: dict[int, np.ndarray], radii: dict[tuple[int, int], float], reach: float, least: float):
    """Links between pairs of blocks, summed up for all pairs of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _Found()
        for batch in batches:
            for row in range(batch.num_rows):
                one, other = ({c: batch.column(f"{side}_{c}")[row] for c in _PAIR} for side in ("a", "b"))
                size = one["size"].as_py()
                blocks = []
                for side, across in ((one, other), (other, one)):
                    nodes, copies = (np.frombuffer(side[c].as_buffer(), np.int64) for c in ("nodes", "copies"))
                    points = np.frombuffer(side["points"].as_buffer(), np.float64).reshape(-1, size)
                    cell, there = side["cell"].as_py(), across["cell"].as_py()
                    kept = np.arange(len(nodes))
                    if cell != there:
                        middle = _middle(centers, size)
                        kept = np.flatnonzero(_near(points, cell, middle, _wide(radii, size, len(middle)), np.array([there]), reach))
                    blocks.append((kept + found.at((size, side["no"].as_py()), nodes), copies[kept], points[kept]))
                (a, copies_a, left), (b, copies_b, right) = blocks
                for rows, columns in _links(left, right, least):
                    if one["no"] == other["no"]:
                        rows, columns = rows[columns > rows], columns[columns > rows]
                    if len(rows):
                        found.add(a[rows], b[columns], copies_a[rows], copies_b[columns])
        yield found.rows()

    return run


def near_vectors(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", least: float = LEAST_COSINE
) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links`` (other vectors with cosine >= ``least``), ``component_id`` (least vec_id
    reachable by links), ``kept`` (vec_id = component_id).

    The cosine of unit vectors is a Euclidean distance, so this is a range join in a metric space: pivots, a bounded
    sample of the vectors, partition them into cells, and cells into blocks, each written once as one row. Tasks read
    two lists of blocks and hold every pair of them against each other that the triangle inequality allows; nothing is
    copied by a shuffle, so the disk taken grows as the vectors do. No pairs come out of a task: only numbers of links,
    and a forest of links for the components. Equal vectors are one node from the start.

    Null, zero and empty vectors, and those with null or non-finite components, link with nothing; nor do vectors of
    different length. A null vec_id is carried along and counts as larger than any number. Rows repeated whole are
    linked rows like any equal vectors, so all rows of the least vec_id are kept. Other columns are not read. No rows
    give no rows.
    """
    named = rows.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"))
    usable = vectors.finite("vector") & F.coalesce(F.exists("vector", lambda x: x != 0), F.lit(False))
    nodes = materialized(
        named.where(usable).groupBy("vector").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
        .withColumn("node", F.monotonically_increasing_id()),
        "vector-nodes",
    )
    total = nodes.count()
    centers = vectors.pivots(nodes, "vector", total // vectors.CELL + 1)
    reach = float(np.sqrt(max(0.0, 2 - 2 * least)))
    plain = nodes.select("node", "copies", "vector")
    placed = f"node long, copies long, vector {nodes.schema['vector'].dataType.simpleString()}, size int, cell int, block int, far double"
    # a row for each pivot at most, and for each length of vector that has none
    cells = plain.mapInArrow(_homes(centers, None), placed).groupBy("size", "cell").agg(F.max("far").alias("far"), F.count("*").alias("n")).collect()
    radii, counts = ({(r["size"], r["cell"]): r[c] for r in cells} for c in ("far", "n"))
    blocks = materialized(
        plain.mapInArrow(_homes(centers, counts), placed).drop("far").groupBy("size", "cell", "block")
        .applyInArrow(lambda part: _packed(part, centers, radii, reach), _BLOCK),
        "vector-blocks",
    )
    one, other = (blocks.select(*[F.col(c).alias(f"{side}_{c}") for c in blocks.columns]) for side in "ab")
    # two comparisons for an equality, by which all of one length would go to one task
    same = (F.col("a_size") <= F.col("b_size")) & (F.col("a_size") >= F.col("b_size")) & (F.col("a_no") <= F.col("b_no"))
    reached = (F.col("a_cell") == F.col("b_cell")) | (F.get("a_near", F.col("b_cell")) & F.get("b_near", F.col("a_cell")))
    pairs = one.join(other.hint("shuffle_replicate_nl"), same & reached).select(*[f"{side}_{c}" for side in "ab" for c in _PAIR])
    found = materialized(pairs.mapInArrow(_solve(centers, radii, reach, least), "a long, b long, links long"), "vector-links")
    counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    joined = components(found.where("b is not null").select("a", "b"), "vector-components")
    least_id = joined.join(nodes.select("node", "vec_id"), "node").groupBy("component").agg(F.min("vec_id").alias("component_id"))
    labels = joined.join(least_id, "component").select("node", "component_id")
    known = (
        nodes.join(counts, "node", "left").join(labels, "node", "left")
        .select(
            "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
        )
    )
    return (
        named.where(usable).join(known, "vector").select("vec_id", "n_links", "component_id")
        .unionByName(named.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
