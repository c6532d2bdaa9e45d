"""Suffix-array dedup by prefix-free parsing: bytes within long strings that occur twice.

Texts are parsed into phrases at triggers, places whose rolling hash is the least among the next ones. A string of
``length`` bytes always holds the trigger of its own first places, so equal strings are parsed alike wherever they occur,
and each is a tail of one phrase (the bytes before its trigger) and a head of the parse's suffix behind it.

Most is settled on the dictionary of distinct phrases, each taken with the bytes that its strings reach into: what
occurs twice is repeated throughout, and what shares its next bytes with no other phrase is not. For the rest, the edges
of repeated passages, the suffix arrays are made: the distinct heads behind the triggers in order (the parse's), and the
distinct phrase tails in order (the dictionary's, read backwards from the trigger). Two strings are equal if their tails
lie in one interval of the first array and their heads in one of the second, so the pair of intervals stands for a string's
place in the order of the whole corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chalkline.llm import words
from chalkline.session import BROADCAST_ROWS, materialized

# Bytes of a string that may not occur twice.
LENGTH = 200
# Bytes under a rolling hash.
TRIGGER = 16

_CHUNK = 1 << 20
_STEPS = words.odd_constants(67, 8).astype(np.uint32) | np.uint32(1)
_OTHER = words.odd_constants(73, 256)
# Numbers of rows within a partition of a suffix array.
_ROWS = 40


def reach(length: int) -> int:
    """Places among which a string's trigger is sought: the bytes behind the last of them still tell phrases apart."""
    return min(length * 3 // 4, length - TRIGGER + 1)


def _rolled(body: np.ndarray) -> np.ndarray:
    """Hash of the TRIGGER bytes from each place on; at the end of the body, of fewer."""
    out, width = (body.astype(np.uint32) + np.uint32(1)) * _STEPS[0], 1
    for step in _STEPS[1 : TRIGGER.bit_length()]:
        out[:-width] = out[:-width] * step + out[width:]
        out ^= out >> np.uint32(15)
        width *= 2
    return out * _STEPS[-1]


def _least(values: np.ndarray, wide: int) -> np.ndarray:
    """Minimum of the ``wide`` values from each place on (fewer at the end)."""
    width, out = 1, values.copy()
    while 2 * width <= wide:
        np.minimum(out[:-width], out[width:], out=out[:-width])
        width *= 2
    if width < wide:
        np.minimum(out[: width - wide], out[wide - width :], out=out[: width - wide])
    return out


def phrases(body: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, trigger, first and last start of the strings with that trigger, three hashes), places within the text.

    The hashes are of the bytes from the trigger on that all these strings hold, and twice of all bytes they hold.
    """
    wide = reach(length)
    low, n = 0, len(body)
    while low < n:
        high = min(n, low + _CHUNK)
        piece = body[low : min(n, high + length + wide)]
        rolled = _rolled(piece).astype(np.uint64) << np.uint64(32)
        trigger = (_least(rolled | np.arange(len(piece), dtype=np.uint64), wide)[: high - low] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        start = np.arange(low, high)
        text = np.searchsorted(offsets, start, side="right") - 1
        whole = start + length <= offsets[text + 1]
        start, text, trigger = start[whole], text[whole], trigger[whole] + low
        cut = np.flatnonzero(np.r_[True, trigger[1:] != trigger[:-1]]) if len(start) else np.zeros(0, np.int64)
        first, last = start[cut], start[np.r_[cut[1:], len(start)] - 1] if len(start) else start
        text, trigger = text[cut], trigger[cut]
        following = high
        if high < n and len(last) and last[-1] == high - 1:  # the last phrase may go on behind this piece
            following = int(first[-1]) if first[-1] > low else high
            if following < high:
                first, last, text, trigger = first[:-1], last[:-1], text[:-1], trigger[:-1]
        if len(first):
            yield (text, trigger, first, last, *_hashes(piece, trigger - low, first - low, last - low, length, wide))
        low = following


def _hashes(piece, trigger, first, last, length: int, wide: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(piece)
    powers, back = words._powers(words._BASE, n), words._powers(words._BACK, n + 1)
    out = []
    for table in (words._EXACT, _OTHER):
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(table[piece] * powers, out=total[1:])
        if not out:
            out.append(words.mixed((total[trigger + length - wide + 1] - total[trigger]) * back[trigger]).view(np.int64))
        out.append(words.mixed((total[last + length] - total[first]) * back[first]).view(np.int64))
    return tuple(out)


def _parsed(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, offsets = words.buffers(batch.column(2))
            for low, high in words.row_groups(offsets, _CHUNK):
                part, bounds = body[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
                for text, trigger, first, last, key, a, b in phrases(part, bounds, length):
                    rows = pa.array(text + low)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(rows), batch.column(1).take(rows),
                            pa.array((trigger - bounds[text]) << 32 | (trigger - first) << 16 | (trigger - last)),
                            pa.array(key), pa.array(a), pa.array((b >> 32).astype(np.int32)),
                        ],
                        ["doc_id", "row", "place", "key", "a", "b"],
                    )

    return run


# A phrase's place in its text is one long: the trigger, and how far before it its strings begin, at most and at least.
_AT, _BACK, _FORE = (lambda place: F.shiftright(place, 32), lambda place: F.shiftright(place, 16).bitwiseAND(0xFFFF), lambda place: F.col(place).bitwiseAND(0xFFFF))


def _contexts(length: int):
    """For each wanted phrase of a text: the bytes before the trigger, last first, and those from it on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entry, tail, head = [], [], []
            for entries, places, text in zip(*(batch.column(c) for c in range(3)), strict=True):
                body = text.as_py().encode()
                entry += entries.as_py()
                for place in places.as_py():
                    at, back = place >> 32, place >> 16 & 0xFFFF
                    tail.append(body[at - back : at][::-1])
                    head.append(body[at : at + length])
            yield pa.RecordBatch.from_arrays([pa.array(entry, pa.int64()), pa.array(tail, pa.binary()), pa.array(head, pa.binary())], ["entry", "tail", "head"])

    return run


def common(a: bytes, b: bytes) -> int:
    """Bytes that two strings share at their beginning."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(k for k in range(n) if a[k] != b[k])


def _common_with_next(strings: list[bytes]) -> list[int]:
    """Bytes that each string shares with the next one; one less than there are strings."""
    if len(strings) < 2:
        return []
    size = np.array([len(s) for s in strings])
    wide = int(size.max()) or 1
    table = np.frombuffer(b"".join(s.ljust(wide, b"\0") for s in strings), dtype=np.uint8).reshape(-1, wide)
    unlike = table[1:] != table[:-1]
    first = np.where(unlike.any(axis=1), unlike.argmax(axis=1), wide)
    return np.minimum(first, np.minimum(size[1:], size[:-1])).tolist()


def _intervals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition of a suffix array, in order: for each string the intervals it lies in.

    The interval at depth d holds the strings that share their first d bytes, and is named after the first of them. It
    changes at few depths, ``depths``, from which on ``names`` holds. ``near`` is the most that the string shares with
    a neighbour, all of it if it occurs several times. ``edge`` marks the first and the last string of the partition.
    """
    base = TaskContext.get().partitionId() << _ROWS
    number, depths, names = 0, [], []
    held = None  # the last string waits, as its next one is in the next batch
    out: list[tuple] = []

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) if out else [[]] * 5
        kinds = [pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.int32(), pa.bool_()]
        made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["string", "depths", "names", "near", "edge"])
        out.clear()
        return made

    for batch in batches:
        strings, several = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        if not strings:
            continue
        shared = _common_with_next(([held[0]] if held else []) + strings)
        if not held:
            shared = [-1, *shared]
        for string, both, more in zip(strings, shared, several, strict=True):
            if held:
                alone = held[3] >= 0 and not held[4]
                out.append((held[0], held[1], held[2], max(held[3], both) if alone else len(held[0]), held[3] < 0))
            keep = sum(d <= both for d in depths)
            depths, names = [*depths[:keep], max(both, 0) + 1], [*names[:keep], base + number]
            held, number = (string, depths, names, both, more), number + 1
        if len(out) >= 10_000:
            yield flush()
    if held:
        out.append((held[0], held[1], held[2], len(held[0]), True))
    yield flush()


def _at(depths, names, depth):
    """Names of the intervals at some depths."""
    return np.asarray(names)[np.searchsorted(np.asarray(depths), depth, side="right") - 1]


def joints(edges: list[tuple[int, bytes, list[int], list[int]]]) -> dict[int, list[tuple[int, int, int]]]:
    """Intervals that begin in earlier partitions: name of a partition's first interval -> (from depth, to depth, name).

    ``edges``: number, string, depths and names of the first and last string of each partition, in order.
    """
    out: dict[int, list[tuple[int, int, int]]] = {}
    before = None
    for number, string, depths, names in edges:
        base = number << _ROWS
        if before and before[0] != number:
            shared = common(before[1], string)
            parts = []
            for k, low in enumerate(before[2]):
                high = min(shared, before[2][k + 1] - 1 if k + 1 < len(before[2]) else shared)
                if low > high:
                    continue
                name = before[3][k]
                parts += [(max(low, x), min(high, y), z) for x, y, z in out.get(name, []) if max(low, x) <= min(high, y)]
                known = max([y for _, y, _ in out.get(name, [])], default=0)
                if known < high:
                    parts.append((max(low, known + 1), high, name))
            out[base] = parts
        before = number, string, depths, names
    return out


def suffix_array(strings: DataFrame, name: str) -> tuple[DataFrame, dict[int, list[tuple[int, int, int]]]]:
    """The distinct values of a binary column in order, with their intervals (see ``_intervals``), written; and the joints
    of its partitions. Being distinct, the values spread over the partitions however often one occurs."""
    column = strings.columns[0]
    parts = int(strings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = strings.groupBy(column).agg((F.count("*") > 1).alias("several"))
    ordered = distinct.repartitionByRange(parts, column).sortWithinPartitions(column)
    table = materialized(
        ordered.mapInArrow(_intervals, "string binary, depths array<int>, names array<long>, near int, edge boolean"), name
    )
    # two strings of each partition
    ends = table.where("edge").orderBy("string").select("string", "depths", "names").collect()
    return table, joints([(max(r["names"]) >> _ROWS, bytes(r["string"]), r["depths"], r["names"]) for r in ends])


def _named(depths, names, wanted: np.ndarray, joined: dict[int, list[tuple[int, int, int]]]) -> np.ndarray:
    """Names of intervals at the ``wanted`` depths, under the name of the partition they begin in."""
    out = _at(depths, names, np.maximum(wanted, 1))
    for base in {x for x in names if x & ((1 << _ROWS) - 1) == 0}:
        for low, high, name in joined.get(base, ()):
            out = np.where((out == base) & (wanted >= low) & (wanted <= high), name, out)
    return np.where(wanted == 0, -1, out)


def _placed(length: int, of_tails, of_heads):
    """Strings of an entry that may have equal ones: how far their starts lie before the trigger, from ``low`` to ``high``,
    a row for each stretch in one interval of tails and one of heads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for r in batch.to_pylist():
                before = np.arange(max(r["fore"], length - r["head_near"]), min(r["back"], r["tail_near"]) + 1)
                if not len(before):
                    continue
                tail = _named(r["tail_depths"], r["tail_names"], before, of_tails)
                head = _named(r["head_depths"], r["head_names"], length - before, of_heads)
                cut = np.flatnonzero(np.r_[True, (tail[1:] != tail[:-1]) | (head[1:] != head[:-1])])
                columns = [tail[cut], head[cut], before[cut], before[np.r_[cut[1:], len(before)] - 1]]
                for held, more in zip(out, [*(c.tolist() for c in columns), [r["entry"]] * len(cut), [r["times"]] * len(cut)], strict=True):
                    held += more
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["tail", "head", "low", "high", "entry", "times"])

    return run


def _key(column: str, side: str) -> list[Column]:
    """128 bits in place of a string."""
    return [F.xxhash64(column).alias(f"{side}_a"), F.xxhash64(F.lit(1), column).alias(f"{side}_b")]


def _few(df: DataFrame, lists: str | None = None) -> DataFrame:
    """A written table, broadcast only if its rows, and what its lists hold, are counted to be few."""
    rows, held = df.agg(F.count("*"), F.sum(F.size(lists)) if lists else F.lit(0)).first()
    return F.broadcast(df) if rows <= BROADCAST_ROWS and (held or 0) <= 8 * BROADCAST_ROWS else df


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Starts and ends of the longest runs that the spans of each text cover."""
    for batch in batches:
        starts, ends, counts = [], [], []
        for spans in batch.column(2):
            span = np.sort(spans.values.to_numpy())
            low, high = span >> 32, np.maximum.accumulate(span & 0xFFFFFFFF)
            cut = np.flatnonzero(low[1:] > high[:-1])
            starts.append(low[np.r_[0, cut + 1]])
            ends.append(high[np.r_[cut, len(span) - 1]])
            counts.append(len(cut) + 1)
        columns = [words.packed(np.concatenate(x) if x else np.zeros(0, np.int64), np.array(counts, dtype=np.int64), pa.int64()) for x in (starts, ends)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["of_doc", "of_row", "starts", "ends"])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        body, offsets = words.buffers(batch.column(1))
        sizes, starts, ends, counts, kept = [], [], [], [], []
        for k, (low, high) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
            text = body[offsets[k] : offsets[k + 1]]
            low, high = (x.values.to_numpy() if x.is_valid else np.zeros(0, np.int64) for x in (low, high))
            gone = np.zeros(len(text) + 1, dtype=np.int8)
            gone[low] += 1
            gone[high] -= 1
            sizes.append(len(text))
            starts.append(low)
            ends.append(high)
            counts.append(len(low))
            kept.append(text[np.cumsum(gone[:-1], dtype=np.int8) == 0].tobytes())
        spans = pa.StructArray.from_arrays([pa.array(np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64)) for x in (starts, ends)], ["start", "end"])
        at = pa.array(words.segments(np.array(counts, dtype=np.int64)).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(at, spans), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "removed", "kept"],
        )


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes``, ``removed`` (start and end of the longest runs of bytes that go) and
    ``kept``, the other bytes.

    A byte goes if any string of ``length`` bytes that covers it begins at another place too, of the same text or any
    other; strings overlap freely, never reach over a text's end, and are those of the texts as given, in UTF-8. So all
    copies of a repeated passage go, the first as well. What is kept may cut characters, so it is bytes.

    Null and empty texts have no bytes. A row's identity is its doc_id and a hash of its text; rows repeated whole are
    different places, so all of such a text's strings occur twice. A null doc_id is carried along. Columns other than the
    two are not read. No rows give no rows. A ``length`` below 32 is refused, as triggers need ``TRIGGER`` bytes.
    """
    if length < 2 * TRIGGER:
        raise ValueError(f"strings of {2 * TRIGGER} bytes at least")
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("row"), F.col(text).alias("text"))
    # made twice rather than written: it is as large as the texts
    parse = rows.mapInArrow(_parsed(length), f"doc_id {kind}, row long, place long, key long, a long, b int")
    # the dictionary: distinct phrases, counted before the shuffle
    dictionary = materialized(
        parse.groupBy("key", "a", "b").agg(F.count("*").alias("times"), *(F.first(c).alias(c) for c in ("doc_id", "row", "place"))), "dictionary"
    )
    keys = dictionary.groupBy("key").agg(F.sum("times").alias("all"), F.count_if(F.col("times") == 1).alias("alone"))
    open_keys = materialized(keys.where("`all` > 1 and alone > 0").select("key"), "open-keys")
    entries = materialized(
        dictionary.join(_few(open_keys), "key")
        .select(F.monotonically_increasing_id().alias("entry"), "times", "doc_id", "row", "place"),
        "entries",
    )
    repeated = parse.join(dictionary.where("times > 1").select("key", "a", "b"), ["key", "a", "b"]).select(
        "doc_id", "row", (_AT("place") - _BACK("place")).alias("low"), (_AT("place") - _FORE("place") + length).alias("high")
    )
    spans = _edge_spans(rows, entries, length).unionByName(repeated)
    listed = materialized(
        spans.select("doc_id", "row", (F.shiftleft("low", 32) + F.col("high")).alias("span"))
        .groupBy("doc_id", "row").agg(F.collect_list("span").alias("spans"))
        .mapInArrow(_merged, f"of_doc {kind}, of_row long, starts array<long>, ends array<long>"),
        "spans",
    )
    met = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("row") == F.col("of_row"))
    return rows.join(_few(listed, "starts"), met, "left").select("doc_id", "text", "starts", "ends").mapInArrow(
        _kept, f"doc_id {kind}, n_bytes long, removed array<struct<start: long, end: long>>, kept binary"
    )


def _edge_spans(rows: DataFrame, entries: DataFrame, length: int) -> DataFrame:
    """Repeated strings of phrases that occur once: ``doc_id``, ``row``, ``low``, ``high``."""
    both = entries.groupBy("doc_id", "row").agg(F.collect_list(F.struct("entry", "place")).alias("wanted"))
    wanted = materialized(
        both.select(F.col("doc_id").alias("of_doc"), F.col("row").alias("of_row"), F.col("wanted.entry").alias("entries"), F.col("wanted.place").alias("places")),
        "wanted",
    )
    met = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("row") == F.col("of_row"))
    contexts = materialized(
        rows.join(_few(wanted, "places"), met).select("entries", "places", "text")
        .mapInArrow(_contexts(length), "entry long, tail binary, head binary"),
        "contexts",
    )
    tails, of_tails = suffix_array(contexts.select("tail"), "tails")
    heads, of_heads = suffix_array(contexts.select("head"), "heads")

    def named(table: DataFrame, side: str) -> DataFrame:
        return table.select(*_key("string", side), *(F.col(c).alias(f"{side}_{c}") for c in ("depths", "names", "near")))

    keyed = contexts.select("entry", *_key("tail", "tail"), *_key("head", "head"))
    stretches = materialized(
        keyed.join(named(tails, "tail"), ["tail_a", "tail_b"]).join(named(heads, "head"), ["head_a", "head_b"])
        .join(entries.select("entry", "times", _BACK("place").alias("back"), _FORE("place").alias("fore")), "entry")
        .mapInArrow(_placed(length, of_tails, of_heads), "tail long, head long, low long, high long, entry long, times long"),
        "edge-strings",
    )
    # how many strings lie in a pair of intervals, by their distance from the trigger: a few dozen rows for each pair
    pair = ["tail", "head"]
    ends = F.array(F.struct(F.col("low").alias("at"), F.col("times").alias("n")), F.struct((F.col("high") + 1).alias("at"), (-F.col("times")).alias("n")))
    steps = stretches.select(*pair, F.inline(ends)).groupBy(*pair, "at").agg(F.sum("n").alias("n"))
    along = Window.partitionBy(*pair).orderBy("at")
    again = (
        steps.select(*pair, "at", F.lead("at").over(along).alias("until"), F.sum("n").over(along).alias("n")).where("n > 1")
        .groupBy(*pair).agg(F.collect_list(F.struct("at", "until")).alias("again"))
    )
    found = (
        stretches.where("times = 1").join(again, pair).select("entry", "low", "high", F.inline("again"))
        .select("entry", F.greatest("low", "at").alias("low"), F.least("high", F.col("until") - 1).alias("high")).where("low <= high")
    )
    return found.join(entries.select("entry", "doc_id", "row", _AT("place").alias("at")), "entry").select(
        "doc_id", "row", (F.col("at") - F.col("high")).alias("low"), (F.col("at") - F.col("low") + length).alias("high")
    )
