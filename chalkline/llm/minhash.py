"""MinHash near-dedup by a signature-coordinate inverted join."""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chalkline.llm import words
from chalkline.llm.links import linked, shared_buckets, within
from chalkline.session import BROADCAST_ROWS, materialized

WIDTH = 5
PERCENT = 85
SIZE = 32
# A pair at the threshold is missed with at most this probability.
MISSED = 1e-5


def matches_for(percent: int, size: int = SIZE) -> int:
    """The most coordinates, of ``size``, in which a pair at ``percent`` agrees but for a probability of ``MISSED``.

    17 of 32 at 85, as P(Bin(32, .85) < 17) is 3.5e-6; 15 at 80, as P(Bin(32, .8) < 15) is 6.6e-6.
    """
    p, missed = percent / 100, 0.0
    for k in range(size + 1):
        missed += comb(size, k) * p**k * (1 - p) ** (size - k)
        if missed > MISSED:
            break
    if k == 0:
        raise ValueError(f"{size} coordinates don't find pairs at {percent} percent")
    return k


def _sets(batch: pa.RecordBatch, width: int):
    """Distinct shingles of the batch's texts (last column): first row, flat values, number by row."""
    body, offsets = words.buffers(batch.column(batch.num_columns - 1))
    for low, high in words.row_groups(offsets):
        part = body[offsets[low] : offsets[high]]
        hashes, _, counts = words.word_hashes(part, offsets[low : high + 1] - offsets[low])
        yield low, *words.distinct(*words.shingles(hashes, counts, width))


def _hashed(width: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, values, counts in _sets(batch, width):
                full = np.flatnonzero(counts)
                marks = np.zeros((len(counts), size), dtype=np.int32)
                marks[full] = words.signatures(values, counts[full], size)
                key_a, key_b = words.set_keys(values, counts)
                rows = batch.slice(low, len(counts))
                lengths = np.full(len(counts), size)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(counts), pa.array(key_a), pa.array(key_b), words.packed(marks.ravel(), lengths, pa.int32())],
                    ["doc_id", "row", "n_shingles", "key_a", "key_b", "marks"],
                )

    return run


def _contents(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, values, counts in _sets(batch, width):
                key_a, key_b = words.set_keys(values, counts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, len(counts)), pa.array(key_a), pa.array(key_b), words.packed(values.view(np.int64), counts, pa.int64())],
                    ["row", "key_a", "key_b", "content"],
                )

    return run


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT,
    size: int = SIZE, matches: int | None = None,
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``, ``row`` (hash of id and text).

    Words are runs without ASCII white space, A-Z lower-cased; a document's set holds its distinct ``width``-word
    shingles, the whole sequence as one if it has fewer words. Documents with 100 * intersection >= ``percent`` * union
    are linked; ``component_id`` is the least doc_id reachable.

    Documents with equal sets are one node. A node has ``size`` MinHash coordinates; each (coordinate, value) is a
    posting list. Two nodes can agree in ``matches`` coordinates only if they meet in one of the size - matches + 1
    rarest lists of either, so only those are posted (prefix), and of those only lists that hold two nodes at least;
    a node with fewer than ``matches`` shared lists is skipped. Collisions are counted where nodes meet, and links are
    confirmed on full sets. ``matches`` follows ``percent`` and ``size`` (``matches_for``) unless it is given.

    Null or empty text, or only white space: n_shingles 0, linked with nothing. A null doc_id is carried along and
    counts as larger than any number. Repeated rows have equal sets, so they share a component; all rows with its least
    doc_id are kept. Other columns are not read. No rows give no rows.
    """
    matches = matches_for(percent, size) if matches is None else matches
    if size > 62 or not 0 < matches <= size:
        raise ValueError("size must be at most 62 and matches within it")
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(doc_id), F.col(text)).alias("row"), F.col(text).alias("text"))
    hashed = materialized(
        rows.mapInArrow(
            _hashed(width, size),
            f"doc_id {kind}, row long, n_shingles long, key_a long, key_b long, marks array<int>",
        ),
        "hashed",
    )
    nodes = materialized(
        hashed.where("n_shingles > 0").groupBy("key_a", "key_b")
        .agg(F.min("doc_id").alias("doc_id"), F.min("row").alias("row"), F.first("marks").alias("marks"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    lists = shared_buckets(nodes.select("node", F.posexplode("marks").alias("mark", "value")))
    prefix = (
        lists.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("size", "mark", "value"))).alias("shared"))
        .where(F.size("shared") >= matches)
        .select("node", F.slice("shared", 1, F.size("shared") - (matches - 1)).alias("prefix"))
    )
    posted = materialized(
        prefix.join(nodes.select("node", "marks", "row", "key_a", "key_b"), "node").withColumn(
            "posted", F.aggregate("prefix", F.lit(0).cast("long"), lambda bits, p: bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), p["mark"])))
        ),
        "posted",
    )
    postings = posted.select("node", "marks", F.explode("prefix").alias("p")).select("node", "marks", "p.mark", "p.value")
    agree = F.size(F.filter(F.zip_with("marks", "center_marks", lambda x, y: x == y), lambda same: same))
    meeting = shared_buckets(postings)
    centers = posted.select(F.col("node").alias("center"), F.col("marks").alias("center_marks"))
    buckets = materialized(
        meeting.join(centers, "center").select("mark", "value", "size", "node", "center", agree.alias("hits")), "buckets"
    )
    wanted = posted.select("node", "row", "key_a", "key_b")
    picked = within(rows, wanted.select("row").distinct(), ["row"], posted.count())
    sets = materialized(
        picked.select("row", "text").mapInArrow(_contents(width), "row long, key_a long, key_b long, content array<long>")
        .join(wanted, ["row", "key_a", "key_b"]).groupBy("node").agg(F.first("content").alias("content")),
        "sets",
    )
    joined = linked(buckets, posted.select("node", "marks", "posted"), sets, matches, percent)
    least = joined.join(nodes.select("node", "doc_id"), "node").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = (
        nodes.select("key_a", "key_b", "node", "doc_id")
        .join(joined.join(least, "component").select("node", "component_id"), "node", "left")
        .select("key_a", "key_b", F.coalesce("component_id", "doc_id").alias("component_id"))
    )
    return (
        hashed.select("doc_id", "row", "n_shingles", "key_a", "key_b").where("n_shingles > 0").join(named, ["key_a", "key_b"])
        .select("doc_id", "n_shingles", "component_id", "row")
        .unionByName(hashed.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "row"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select("doc_id", "n_shingles", "component_id", "kept", "row")
    )


def without_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents, all columns as they were, of which one of each component of ``near_duplicates`` stays: the one
    with the least doc_id. Documents without words all stay. Rows repeated whole are one document and stay together.

    The rows that go are broadcast only if counted to be few, else joined by a shuffle of the documents.
    """
    found = near_duplicates(docs, doc_id, text, **options).where("not kept")
    gone = materialized(found.select(F.col("doc_id").alias("__doc"), F.col("row").alias("__of")).distinct(), "gone")
    few = gone.count() <= BROADCAST_ROWS
    # by id and hash: the hash alone would meet by chance among very many documents
    same = (F.col("__row") == F.col("__of")) & F.col(doc_id).eqNullSafe(F.col("__doc"))
    marked = docs.withColumn("__row", F.xxhash64(F.col(doc_id), F.col(text)))
    return marked.join(F.broadcast(gone) if few else gone, same, "left_anti").select(*docs.columns)
