"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chalkline.llm import words

# Log2 of the number of weights, which is also the size of the model that is broadcast (2 MB).
BITS = 18
# Labelled rows that are learned from, at most: those with the least hashes of doc_id.
SAMPLE = 24_000
# The sample is learned in so many parts, whose weights are averaged.
SHARDS = 6
PASSES = 3
CUT = 0.3
SCALE = 8.0


def features(body: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(weight places, number by row): hashed words and word pairs; letters keep their case, punctuation is a word."""
    hashes, _, counts = words.word_hashes(body, offsets, fold=False, punctuation=True)
    shift = np.uint64(64 - bits)
    single = (hashes >> shift).astype(np.int64)
    if len(hashes) < 2:
        return single, counts
    rows = np.repeat(np.arange(len(counts)), counts)
    inside = rows[1:] == rows[:-1]
    first, second = hashes[:-1][inside], hashes[1:][inside]
    # a word repeated at once is the same pair whatever the word: what tells is the repeating
    pair = np.where(first == second, np.uint64(1), first * np.uint64(3) + second * np.uint64(0x9E3779B97F4A7C15))
    double = (words.mixed(pair) >> shift).astype(np.int64)
    pair_counts = np.maximum(counts - 1, 0)
    out_counts = counts + pair_counts
    at = words.segments(out_counts)
    out = np.empty(at[-1], dtype=np.int64)
    own = words.segments(counts)
    out[at[rows] + np.arange(len(single)) - own[rows]] = single
    pair_rows, pair_own = rows[1:][inside], words.segments(pair_counts)
    out[at[pair_rows] + counts[pair_rows] + np.arange(len(double)) - pair_own[pair_rows]] = double
    return out, out_counts


def _texts(column: pa.Array, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    body, offsets = words.buffers(column)
    for low, high in words.row_groups(offsets):
        yield features(body[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], bits)


def follow_the_leader(
    examples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, bits: int, passes: int = PASSES,
    alpha: float = 2.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02,
) -> np.ndarray:
    """Weights after FTRL-proximal updates, one example at a time; the last weight is the bias."""
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weights(at):
        zs, ns = z[at], n[at]
        return np.where(np.abs(zs) <= l1, 0.0, -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(ns)) / alpha + l2))

    for _ in range(passes):
        for (at, x), label in zip(examples, labels.tolist(), strict=True):
            w = weights(at)
            score = 1.0 / (1.0 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (score - label) * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
    return weights(np.arange(len(z)))


def _example(places: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A text's places without repeats and their values, the bias last."""
    at, times = np.unique(places, return_counts=True)
    return np.r_[at, 1 << bits], np.r_[times * (SCALE / max(1, len(places))), 1.0]


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
    bits: int = BITS, sample: int = SAMPLE,
) -> np.ndarray:
    """Weights learned from labelled rows whose crc32(doc_id as text) mod 5 is not 0.

    At most ``sample`` of those rows are learned from, the ones with the least hashes of doc_id, and of rows with one
    doc_id the one with the least hash of its text; only their ids, then
    ``SHARDS`` weight vectors are gathered, never texts. Contradicting labels of one doc_id count as the least. No
    labelled rows, or none of one class, is allowed: weights 0 score 0.5. Labels other than 0 and 1 are not read.
    """
    chosen = (
        labels.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out("doc_id"))
        .groupBy("doc_id").agg(F.min("label").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    # one row for each chosen id, so that the bound holds for rows, too
    once = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = once.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SHARDS)))

    def learn(part: pa.Table) -> pa.Table:
        part = part.take(np.lexsort((part["text_hash"].to_numpy(), part["order"].to_numpy())))
        examples = []
        for batch in part["text"].chunks:
            for places, counts in _texts(batch, bits):
                at = words.segments(counts)
                examples += [_example(places[a:b], bits) for a, b in zip(at[:-1], at[1:], strict=True)]
        found = follow_the_leader(examples, part["label"].to_numpy(), bits)
        some = np.flatnonzero(found)
        return pa.table({"place": pa.array(some, pa.int64()), "weight": pa.array(found[some], pa.float64())})

    learned = (
        rows.select("shard", "label", "text", F.xxhash64("doc_id", F.lit(2)).alias("order"), F.xxhash64("text").alias("text_hash"))
        .groupBy("shard").applyInArrow(learn, "place long, weight double")
        .groupBy("place").agg((F.sum(F.round("weight", 12).cast("decimal(30,12)")) / SHARDS).cast("double").alias("weight"))
    )
    weights = np.zeros((1 << bits) + 1)
    found = learned.toArrow()
    weights[found["place"].to_numpy()] = found["weight"].to_numpy()
    return weights


def held_out(doc_id: str) -> Column:
    """Rows that are never learned from: crc32 of the id as text mod 5 is 0, or no id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(True))


def scored(weights, text: str, bits: int = BITS) -> Column:
    """Score 0 to 1 of a text column: a sparse dot product with the broadcast weights. Null counts as empty: bias only."""

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        w = weights.value
        for batch in batches:
            out = []
            for places, counts in _texts(batch, bits):
                total = np.zeros(len(counts))
                some = counts > 0
                if some.any():  # each text for itself, so that its score doesn't depend on its neighbours
                    total[some] = np.add.reduceat(w[places], words.segments(counts)[:-1][some])
                out.append(total * (SCALE / np.maximum(1, counts)) + w[-1])
            values = np.concatenate(out) if out else np.zeros(0)
            yield pa.array(1.0 / (1.0 + np.exp(-np.clip(values, -35, 35))))

    return run(F.col(text))


def classify(
    docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text", cut: float = CUT,
) -> DataFrame:
    """The documents with ``held_out``, ``score`` (higher: label 1 likelier) and ``predicted`` (1 from ``cut`` on) added.

    Only the text is looked at. The features of a text are its hashed words and word pairs, by their share of all of
    the text's features. Null or empty text scores by the bias alone. Repeated rows score alike, a null doc_id counts
    as held out, other columns pass through unless they bear one of the added names, which are replaced. No rows give
    no rows. Scoring is one pass without a shuffle.
    """
    weights = docs.sparkSession.sparkContext.broadcast(train(docs, labels, label, doc_id, text))
    return docs.withColumns({"held_out": held_out(doc_id), "score": scored(weights, text)}).withColumn(
        "predicted", (F.col("score") >= cut).cast("int")
    )
