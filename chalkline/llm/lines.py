"""Line dedup: fuzzy lines by MinHash over character shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chalkline.llm import words
from chalkline.llm.links import ArrayContents, linked, shared_buckets, within
from chalkline.session import materialized

# Characters in a shingle; similarity of two lines that count as one, in percent.
WIDTH = 8
PERCENT = 80
# 10 bands of 3 coordinates find a pair at the threshold with a probability of 1 - (1 - .8 ** 3) ** 10 = .9992.
BANDS = 10
ROWS = 3

_GROUP = 1 << 18
_OTHER = words.odd_constants(31, 256)
_OTHER[65:91] = _OTHER[97:123]
_FACTORS = words.odd_constants(43, BANDS * ROWS).astype(np.uint32) | np.uint32(1)
_STEPS = words.odd_constants(47, 4).astype(np.uint32) | np.uint32(1)
_BAND_FACTORS = words.odd_constants(53, ROWS)
_WIDE = words.odd_constants(59, 4)
# Lines whose bands a task remembers to have given out.
_KNOWN = 1 << 20


def _spans(newlines: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all lines, in order, of texts within ``bounds``."""
    return np.sort(np.r_[bounds[:-1], newlines + 1], kind="stable"), np.sort(np.r_[newlines, bounds[1:]], kind="stable")


def _grams(characters: np.ndarray) -> np.ndarray:
    """32-bit hash of the 8 characters from every place on (the last 7 places hold rubbish)."""
    g = (characters + np.uint32(1)) * _STEPS[0]
    for step, shift in zip(_STEPS[1:], (1, 2, 4), strict=True):
        ahead = np.zeros_like(g)
        ahead[:-shift] = g[shift:]
        ahead *= step
        g += ahead
        g ^= g >> np.uint32(15)
    g *= np.uint32(0x2C1B3C6D)
    g ^= g >> np.uint32(12)
    return g


def read_lines(body: np.ndarray, offsets: np.ndarray):
    """Per line that is not blank: text, number in the text, two keys; then flat 32-bit shingle hashes, number by line.

    Two lines have equal keys if they are the same but for A-Z and a-z. A line shorter than a shingle is one shingle.
    """
    starts, ends = _spans(np.flatnonzero(body == 10), offsets)
    text = np.searchsorted(offsets, starts, side="right") - 1
    # an empty last line of one text begins where the next text does
    per_text = np.bincount(np.searchsorted(offsets[1:], np.flatnonzero(body == 10), side="right"), minlength=len(offsets) - 1) + 1
    text = np.repeat(np.arange(len(offsets) - 1), per_text)
    number = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    filled = np.zeros(len(body) + 1, dtype=np.int64)
    np.cumsum(~words.SPACE[body], out=filled[1:])
    full = filled[ends] > filled[starts]
    keys = [words._span_hashes(body, starts[full], ends[full], t) for t in (words._FOLDED, _OTHER)]
    characters = np.frombuffer(body.tobytes().lower().decode("utf-8", errors="replace").encode("utf-32-le"), dtype=np.uint32)
    begun = np.zeros(len(body) + 1, dtype=np.int64)
    np.cumsum((body & 0xC0) != 0x80, out=begun[1:])
    starts, ends = begun[starts[full]], begun[ends[full]]
    long = ends - starts >= WIDTH
    counts = np.where(long, ends - starts - (WIDTH - 1), 1)
    inside = np.zeros(len(characters) + 1, dtype=np.int32)
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, ends[long] - (WIDTH - 1), -1)
    inside = np.cumsum(inside[:-1]).astype(bool)
    values = np.empty(int(counts.sum()), dtype=np.uint32)
    of_long = np.repeat(long, counts)
    values[of_long] = _grams(characters)[inside]
    values[~of_long] = (keys[0][~long] >> np.uint64(32)).astype(np.uint32)
    return text[full], number[full], keys, values, counts


def bands(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Lines x bands of 64-bit values."""
    out = np.zeros((len(counts), BANDS), dtype=np.uint64)
    if not len(counts):
        return out.view(np.int64)
    starts = words.segments(counts)[:-1]
    for k in range(BANDS * ROWS):
        least = np.minimum.reduceat(values * _FACTORS[k], starts)
        out[:, k // ROWS] += (least.astype(np.uint64) + np.uint64(1)) * _BAND_FACTORS[k % ROWS]
    return words.mixed(out).view(np.int64)


def _groups(batch: pa.RecordBatch):
    body, offsets = words.buffers(batch.column(batch.num_columns - 1))
    for low, high in words.row_groups(offsets, _GROUP):
        yield low, *read_lines(body[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with their keys; the bands of a line come with its first occurrence in the task, and are null later."""
    names = ["doc_id", "row", "line_no", "key_a", "key_b", *(f"band_{k}" for k in range(BANDS))]
    known: set[tuple[int, int]] = set()
    for batch in batches:
        for low, text, number, keys, values, counts in _groups(batch):
            fresh = np.zeros(len(text), dtype=bool)
            for k, key in enumerate(zip(keys[0].tolist(), keys[1].tolist(), strict=True)):
                if key not in known:
                    known.add(key)
                    fresh[k] = True
            if len(known) > _KNOWN:
                known.clear()
            rows = batch.select(["doc_id", "row"]).take(pa.array(text + low))
            found = bands(values[np.repeat(fresh, counts)], counts[fresh])
            place = pa.array(np.cumsum(fresh) - 1, mask=~fresh)
            columns = [rows.column(0), rows.column(1), pa.array(number), *(pa.array(k.view(np.int64)) for k in keys)]
            columns += [pa.array(np.ascontiguousarray(band)).take(place) for band in found.T]
            yield pa.RecordBatch.from_arrays(columns, names)


def _wanted_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each text, the lines whose first key is asked for, A-Z lower-cased, with both keys."""
    for batch in batches:
        body, offsets = words.buffers(batch.column(1))
        for low, high in words.row_groups(offsets, _GROUP):
            part, bounds = body[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
            starts, ends = _spans(np.flatnonzero(part == 10), bounds)
            found = [words._span_hashes(part, starts, ends, t).view(np.int64) for t in (words._FOLDED, _OTHER)]
            _, first = np.unique(found[0], return_index=True)
            asked = batch.column(0).slice(low, high - low).flatten().to_numpy()
            at = first[np.isin(found[0][first], asked)]
            text = part.tobytes().lower()
            lines = [text[a:b].decode() for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[0][at]), pa.array(found[1][at]), pa.array(lines, pa.string())], ["key_a", "key_b", "content"]
            )


def shingle_set(line: str) -> frozenset[str]:
    """Distinct shingles of a lower-cased line."""
    return frozenset([line[k : k + WIDTH] for k in range(max(1, len(line) - WIDTH + 1))])


def similar(a: frozenset, b: frozenset, percent: int) -> bool:
    if min(len(a), len(b)) * 100 < max(len(a), len(b)) * percent:
        return False
    both = len(a & b)
    return both * 100 >= (len(a) + len(b) - both) * percent


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the shingles of lower-cased lines, with repeats, and their number by line."""
    body, offsets = words.buffers(column)
    characters = np.frombuffer(body.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
    begun = np.zeros(len(body) + 1, dtype=np.int64)
    np.cumsum((body & 0xC0) != 0x80, out=begun[1:])
    at = begun[offsets]
    sizes = np.diff(at)
    g = (characters.astype(np.uint64) + np.uint64(1)) * _WIDE[0]
    for step, shift in zip(_WIDE[1:], (1, 2, 4), strict=True):
        g[:-shift] += g[shift:] * step
        g ^= g >> np.uint64(31)
    counts = np.maximum(sizes - (WIDTH - 1), 1)
    first = np.repeat(at[:-1], counts)
    place = first + np.arange(len(first)) - np.repeat(words.segments(counts)[:-1], counts)
    long = np.repeat(sizes >= WIDTH, counts)
    out = np.empty(len(place), dtype=np.uint64)
    out[long] = words.mixed(g[place[long]])
    short = sizes < WIDTH
    out[~long] = words._span_hashes(body, offsets[:-1][short], offsets[1:][short], _OTHER)
    return out, counts


class LineContents(ArrayContents):
    """Lower-cased lines of a cell, as sets of 64-bit shingle hashes."""

    def __init__(self, column: pa.Array):
        self.flat, self.sizes = words.distinct(*shingles(column))
        self.bits: np.ndarray | None = None


# Bits of a hash that fit beside the number of a pair in a batch.
_PAIR = 44


def fitting(a: pa.Array, b: pa.Array, percent: int) -> np.ndarray:
    """Whether the lines of each pair are similar, all pairs at once.

    Sets are sorted runs of (pair, some bits of the hash) in one array for each side. Bits that are equal by chance could
    only tip a pair that is one shingle off the threshold, so those are held against each other as texts.
    """
    keys, sizes = [], []
    for column in (a, b):
        hashes, counts = shingles(column)
        pair = np.repeat(np.arange(len(counts), dtype=np.uint64), counts) << np.uint64(_PAIR)
        held = np.sort(pair | (hashes >> np.uint64(64 - _PAIR)))
        held = held[np.r_[True, held[1:] != held[:-1]]] if len(held) else held
        keys.append(held)
        sizes.append(np.bincount((held >> np.uint64(_PAIR)).astype(np.int64), minlength=len(counts)))
    merged = np.sort(np.concatenate(keys))
    again = merged[:-1][merged[1:] == merged[:-1]]
    both = np.bincount((again >> np.uint64(_PAIR)).astype(np.int64), minlength=len(a))
    over = both * 100 - (sizes[0] + sizes[1] - both) * percent
    out = over >= 0
    for k in np.flatnonzero(np.abs(over) <= 100 + percent).tolist():
        out[k] = similar(shingle_set(a[k].as_py()), shingle_set(b[k].as_py()), percent)
    return out


def lines_fit(percent: int):
    """Two columns of lower-cased lines -> whether their shingle sets are similar."""

    @F.arrow_udf("boolean")
    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        cuts = [0]
        for low, high in words.row_groups(words.buffers(a)[1] + words.buffers(b)[1], _GROUP):
            cuts.append(high)
        found = [fitting(a.slice(low, high - low), b.slice(low, high - low), percent) for low, high in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.array(np.concatenate([*found, np.zeros(0, dtype=bool)]), pa.bool_())

    return lambda a, b: run(a, b)


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """A row's identity is its doc_id and text."""
    return docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(doc_id), F.col(text)).alias("row"), F.col(text).alias("text"))


def fuzzy_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per line that is not blank: ``doc_id``, ``row`` (hash of id and text), ``line_no`` (from 0),
    ``first_doc_id`` and ``first_line_no`` of its component's first line, and ``kept``: whether it is that line.

    Lines are split at \\n. Lines that differ only in A-Z against a-z are one node. Two nodes are linked if their sets
    of 8-character shingles have 100 * intersection >= ``percent`` * union; candidates meet in one of 10 bands of 3
    MinHash coordinates, all are confirmed on full sets. A component's first line is that of the least
    (doc_id, line_no).

    Null or empty texts and blank lines give no rows. A null doc_id sorts last. Rows repeated whole, and different rows
    of one doc_id, are told from others by (doc_id, line_no): all of them that are the first line are kept. Other
    columns are not read. No rows give no rows. The bands serve a ``percent`` of 80 or more; less is refused, as pairs
    would be missed.
    """
    if percent < PERCENT:
        raise ValueError(f"{BANDS} bands of {ROWS} miss pairs below {PERCENT} percent")
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = _rows(docs, doc_id, text)
    names = [f"band_{k}" for k in range(BANDS)]
    schema = f"doc_id {kind}, row long, line_no long, key_a long, key_b long, " + ", ".join(f"{n} long" for n in names)
    lines = materialized(rows.mapInArrow(_hashed, schema), "lines")
    nodes = materialized(
        lines.groupBy("key_a", "key_b")
        .agg(F.count("*").alias("times"), F.min("row").alias("row"), *(F.max(n).alias(n) for n in names))
        .withColumn("node", F.monotonically_increasing_id()),
        "line-nodes",
    )
    buckets = materialized(
        shared_buckets(nodes.select("node", F.posexplode(F.array(*names)).alias("mark", "value"))).withColumn("hits", F.lit(1)),
        "line-buckets",
    )
    meeting = buckets.select("node").distinct()
    posted = materialized(
        nodes.join(meeting, "node").select(
            "node", "key_a", "key_b", "row", F.array(*names).alias("marks"), F.lit((1 << BANDS) - 1).cast("long").alias("posted")
        ),
        "line-posted",
    )
    asked = posted.groupBy("row").agg(F.collect_set("key_a").alias("asked"))
    picked = within(rows, asked, ["row"], posted.count())
    sets = materialized(
        picked.select("asked", "text").mapInArrow(_wanted_lines, "key_a long, key_b long, content string")
        .join(posted.select("node", "key_a", "key_b"), ["key_a", "key_b"])
        .groupBy("node").agg(F.max("content").alias("content")),
        "line-sets",
    )
    joined = linked(
        buckets, posted.select("node", "marks", "posted"), sets, 1, percent, lines_fit(percent), LineContents
    )
    several = (
        nodes.select("node", "key_a", "key_b", "times").join(joined, "node", "left")
        .where("times > 1 or component is not null")
        .select("key_a", "key_b", F.coalesce("component", "node").alias("component"))
    )
    labelled = materialized(
        lines.select("doc_id", "row", "line_no", "key_a", "key_b").join(several, ["key_a", "key_b"], "left")
        .select("doc_id", "row", "line_no", "component"),
        "line-labels",
    )
    firsts = (
        labelled.where("component is not null").groupBy("component")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "line_no")).alias("first"))
        .select("component", F.col("first.doc_id").alias("first_doc_id"), F.col("first.line_no").alias("first_line_no"))
    )
    alone = labelled.where("component is null").select("doc_id", "row", "line_no", F.col("doc_id").alias("first_doc_id"), F.col("line_no").alias("first_line_no"))
    shared = labelled.join(firsts, "component").select("doc_id", "row", "line_no", "first_doc_id", "first_line_no")
    return alone.unionByName(shared).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("first_doc_id")) & (F.col("line_no") == F.col("first_line_no"))
    )


def without_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The documents, all columns as they were, with only the kept lines in their text.

    Blank lines stay where they are. A document of which no line is left, though it had some, is dropped: all it said
    stands in other documents. Documents without any line (null or blank text) stay. Columns may have any names.
    """
    dropped = (
        fuzzy_lines(docs, doc_id, text, percent).groupBy("doc_id", "row")
        .agg(F.collect_set(F.when(~F.col("kept"), F.col("line_no"))).alias("__gone"), F.max(F.col("kept").cast("int")).alias("__some"))
        .where(F.size("__gone") > 0)
        .select(F.col("doc_id").alias("__doc"), F.col("row").alias("__of"), "__gone", "__some")
    )
    # by id and hash: the hash alone would meet by chance among very many documents
    same = (F.col("__row") == F.col("__of")) & F.col(doc_id).eqNullSafe(F.col("__doc"))
    met = docs.withColumn("__row", F.xxhash64(F.col(doc_id), F.col(text))).join(dropped, same, "left").where("__some is null or __some = 1")
    met = met.withColumn("__lines", F.when(F.col("__gone").isNotNull(), F.split(text, "\n", -1)))
    stay = F.array_except(F.sequence(F.lit(0).cast("long"), F.size("__lines") - F.lit(1).cast("long")), F.col("__gone"))
    left = F.array_join(F.transform(stay, lambda k: F.get("__lines", k.cast("int"))), "\n")
    return met.withColumn(text, F.when(F.col("__gone").isNull(), F.col(text)).otherwise(left)).select(*docs.columns)
