"""Exact top-k search by inner product as a Voronoi kNN join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chalkline.llm import vectors
from chalkline.session import materialized

K = 10
# Queries to a group.
GROUP = 512
# Products are exact in doubles up to here.
EXACT = 2.0**53


def whole(matrix: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) as doubles that hold whole numbers."""
    return np.floor(matrix * scale)


def _lifted(points: np.ndarray, top: float) -> np.ndarray:
    """Points with one more coordinate that gives all of them the length ``top``: then the nearest to a query, whose own
    further coordinate is 0, are those with the largest inner product."""
    rest = np.sqrt(np.maximum(top - (points * points).sum(axis=1), 0))
    return np.concatenate([points, rest[:, None]], axis=1)


def _flat(points: np.ndarray) -> np.ndarray:
    return np.concatenate([points, np.zeros((len(points), 1))], axis=1)


def _cells(centers: dict[int, np.ndarray], tops: dict[int, float], lift: bool, scale: float):
    """(size, cell, far) of each vector: its nearest pivot and the distance to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, matrix in vectors.matrices(batch.column(0)):
                size = matrix.shape[1]
                points = whole(matrix, scale)
                far = vectors.distances(_lifted(points, tops[size]) if lift else _flat(points), centers[size])
                home = far.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(home), size, np.int32)), pa.array(home.astype(np.int32)), pa.array(far[np.arange(len(home)), home])],
                    ["size", "cell", "far"],
                )

    return run


def _squares(scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, matrix in vectors.matrices(batch.column(0)):
                points = whole(matrix, scale)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([matrix.shape[1]], pa.int32()), pa.array([float((points * points).sum(axis=1).max())]), pa.array([len(points)], pa.int64())],
                    ["size", "top", "n"],
                )

    return run


def bounds(
    data: dict[tuple[int, int], list[float]], queries: dict[tuple[int, int], float],
    data_centers: dict[int, np.ndarray], query_centers: dict[int, np.ndarray], k: int,
) -> dict[tuple[int, int], tuple[float, np.ndarray, float]]:
    """Query group -> (bound, distances from its pivot to the data pivots, its radius).

    Each data cell's summary holds its least distances to the pivot. A vector at distance f from its pivot p is within
    radius + d(pivot of the group, p) + f of every query of the group, so the k-th least of these sums bounds the
    distance of every query's k-th neighbour.
    """
    out = {}
    for (size, group), radius in queries.items():
        between = vectors.distances(query_centers[size][group : group + 1], data_centers[size])[0]
        reach = sorted(radius + between[cell] + f for (s, cell), least in data.items() if s == size for f in least)
        out[size, group] = (reach[k - 1] if len(reach) >= k else np.inf, between, radius)
    return out


def _needed(centers, tops, limits, slices: dict[int, int], scale: float):
    """Data vectors, once for each query group that may need them: all queries of a group are at least
    d(pivots) - radius - f away, and more than the bound is too far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, matrix in vectors.matrices(batch.column(1)):
                size = matrix.shape[1]
                points = whole(matrix, scale)
                far = vectors.distances(_lifted(points, tops[size]), centers[size])
                home = far.argmin(axis=1)
                own = far[np.arange(len(rows)), home]
                slack = 1e-6 * np.sqrt(tops[size]) + 1e-6
                for (s, group), (limit, between, radius) in limits.items():
                    if s != size:
                        continue
                    taken = np.flatnonzero(between[home] - radius - own <= limit + slack)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(taken), size, np.int32)), pa.array(np.full(len(taken), group, np.int32)),
                            pa.array(np.full(len(taken), slices[size], np.int32)), batch.column(0).take(pa.array(rows[taken])),
                            vectors.lists(points[taken]),
                        ],
                        ["size", "grp", "slices", "vec_id", "vector"],
                    )

    return run


def _grouped(centers, tops, slices: dict[int, int], scale: float):
    """Queries with the group of their nearest query pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, matrix in vectors.matrices(batch.column(1)):
                size = matrix.shape[1]
                points = whole(matrix, scale)
                group = vectors.distances(_flat(points), centers[size]).argmin(axis=1).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(rows), size, np.int32)), pa.array(group), pa.array(np.full(len(rows), slices[size], np.int32)),
                        batch.column(0).take(pa.array(rows)), vectors.lists(points),
                    ],
                    ["size", "grp", "slices", "vec_id", "vector"],
                )

    return run


def _best(queries: pa.Table, data: pa.Table, k: int) -> pa.Table:
    """Each query's k best of one slice of its group's data."""
    q_id, d_id = (t["vec_id"].combine_chunks().to_numpy() for t in (queries, data))
    out: list[list[np.ndarray]] = [[], [], []]
    if len(q_id) and len(d_id):
        q, d = (np.concatenate([m for _, m in vectors.matrices(t["vector"].combine_chunks())]) for t in (queries, data))
        order = np.argsort(d_id, kind="stable")
        d_id, d = d_id[order], d[order]
        largest = max(np.abs(q).max(initial=0), np.abs(d).max(initial=0))
        if largest * largest * max(1, q.shape[1]) >= EXACT:
            q, d = (np.clip(m, -(2.0**63), 2.0**63 - 1025).astype(np.int64) for m in (q, d))
        for begin in range(0, len(q_id), 256):
            scores = (q[begin : begin + 256] @ d.T).astype(np.int64)
            for at, row in enumerate(scores, begin):
                fit = np.ones(len(d_id), dtype=bool)
                low, high = np.searchsorted(d_id, [q_id[at], q_id[at] + 1])
                fit[low:high] = (d[low:high] != q[at]).any(axis=1)  # not the query's own row
                ids, values = d_id[fit], row[fit]
                if len(values) > 4 * k:  # rows repeated whole may crowd the best, so cut by distinct ids below
                    least = np.partition(values, len(values) - 4 * k)[len(values) - 4 * k]
                    some = values >= least
                    if len(np.unique(ids[some])) >= k:
                        ids, values = ids[some], values[some]
                best = np.lexsort((ids, -values))
                pairs = np.stack([ids[best], values[best]], axis=1)
                fresh = np.r_[True, (pairs[1:] != pairs[:-1]).any(axis=1)] if len(pairs) else np.zeros(0, bool)
                pairs = pairs[fresh][:k]
                out[0].append(np.full(len(pairs), q_id[at]))
                out[1].append(pairs[:, 0])
                out[2].append(pairs[:, 1])
    columns = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]
    return pa.table(dict(zip(("query_id", "vec_id", "score"), (pa.array(c, pa.int64()) for c in columns), strict=True)))


def top_by_inner_product(
    rows: DataFrame, is_query: Column, k: int = K, scale: float = 1024.0, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` of each query's ``k`` highest scores among all other rows.

    ``is_query`` tells by vec_id (a long) which rows are queries. A score is the inner product of floor(scale * x) of
    both vectors; of equal scores the smaller vec_id comes first. Fewer rows than k give all.

    With one more coordinate the largest inner products are the nearest neighbours, and those are found by a Voronoi kNN
    join: queries and data are grouped by nearest pivots (a bounded sample), summaries of the groups (radius, least
    distances to the pivot) bound the k-th distance for each query group, and only data that may lie within the bound
    go to a group. There, slices of the data are searched independently and their best k merged.

    Null vectors, vectors with null or non-finite components and rows without a vec_id take no part; vectors of
    different length have no score. Rows repeated whole count once; different vectors of one vec_id are rows of their
    own, and if they are queries, their results are ranked together under that id. Components beyond the range of a long are cut to it, scores beyond it wrap around. Other columns are
    not read. No rows, or no queries, give no rows.
    """
    spark = rows.sparkSession
    data = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector")).where(
        F.col("vec_id").isNotNull() & vectors.finite("vector")
    )
    queries = data.where(is_query)
    only = data.select("vector")
    sizes = {
        r["size"]: (r["top"], r["n"])
        for r in only.mapInArrow(_squares(scale), "size int, top double, n long").groupBy("size").agg(F.max("top").alias("top"), F.sum("n").alias("n")).collect()
    }
    asked = queries.count()
    tops = {size: top for size, (top, _) in sizes.items()}
    slices = {size: int(n // vectors.BLOCK + 1) for size, (_, n) in sizes.items()}
    total = sum(n for _, n in sizes.values())

    def sampled(df: DataFrame, count: int, lift: bool) -> dict[int, np.ndarray]:
        found = vectors.pivots(df, "vector", count)
        made = {size: whole(found.get(size, np.zeros((1, size))), scale) for size in sizes}
        return {size: _lifted(m, tops[size]) if lift else _flat(m) for size, m in made.items()}

    data_centers = sampled(only, total // vectors.CELL + 1, True)
    query_centers = sampled(queries.select("vector"), asked // GROUP + 1, False)
    kind = "size int, cell int, far double"
    cells = only.mapInArrow(_cells(data_centers, tops, True, scale), kind)
    by_far = Window.partitionBy("size", "cell").orderBy("far")
    # the query itself may be among a cell's least, so one more than k counts; equal distances count once, as they may be
    # of one row repeated: the bound only gets wider. The summary of a cell needs its k + 1 least distances: first those of each hash slice, then of the cell
    sliced = Window.partitionBy("size", "cell", "part").orderBy("far")
    least = (
        cells.distinct().withColumn("part", F.pmod(F.xxhash64("far"), F.lit(64))).withColumn("n", F.row_number().over(sliced)).where(F.col("n") <= k + 1)
        .withColumn("n", F.row_number().over(by_far)).where(F.col("n") <= k + 1)
        .groupBy("size", "cell").agg(F.collect_list("far").alias("least"))
    )
    summary = {(r["size"], r["cell"]): r["least"] for r in least.collect()}
    radii = {
        (r["size"], r["cell"]): r["far"]
        for r in queries.select("vector").mapInArrow(_cells(query_centers, tops, False, scale), kind)
        .groupBy("size", "cell").agg(F.max("far").alias("far")).collect()
    }
    limits = bounds(summary, radii, data_centers, query_centers, k + 1)
    out = "size int, grp int, slices int, vec_id long, vector array<double>"
    slice_of = F.pmod(F.xxhash64("vec_id"), "slices").cast("int")
    needed = data.mapInArrow(_needed(data_centers, tops, limits, slices, scale), out).withColumn("slice", slice_of)
    asking = (
        queries.mapInArrow(_grouped(query_centers, tops, slices, scale), out)
        .withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    )
    key = ["size", "grp", "slice"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    best = (
        asking.repartition(parts, *key).groupBy(*key)
        .cogroup(needed.repartition(parts, *key).groupBy(*key))
        .applyInArrow(lambda q, d: _best(q, d, k), "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = materialized(best, "best").distinct()
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
