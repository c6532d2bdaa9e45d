"""Repeated strings, periodic runs and hard negatives against plain versions."""

import os
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from chalkline.llm import grid, negatives, periods, queries, repeats, vectors

SMALL = "/root/testdata/sf0.001"
# Other columns bear the operators' inner names.
CLASHING = "doc_id long, text string, row int, key string, spans double, words array<int>"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "k", 0.5, [1]) for i, t in rows], CLASHING)


@pytest.mark.parametrize("name", ["op11_repeats", "op12_periods", "op13_negatives"])
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for file in sorted(os.listdir(SMALL)):
        con.execute(f"create view {file.removesuffix('.parquet')} as select * from read_parquet('{SMALL}/{file}')")
    found = queries.QUERIES[name](spark, SMALL)
    wanted = con.execute(queries.ORACLES[name])
    names = [d[0] for d in wanted.description]
    assert sorted(found.columns) == sorted(names)
    assert sorted(map(repr, (tuple(r[c] for c in names) for r in found.collect()))) == sorted(map(repr, wanted.fetchall()))


# repeated strings


def plain_repeats(texts, length):
    bodies = [(t or "").encode() for t in texts]
    seen = {}
    for k, b in enumerate(bodies):
        for i in range(len(b) - length + 1):
            seen.setdefault(b[i : i + length], []).append((k, i))
    gone = [np.zeros(len(b), dtype=bool) for b in bodies]
    for places in seen.values():
        if len(places) > 1:
            for k, i in places:
                gone[k][i : i + length] = True
    return [(len(b), int(g.sum()), int((np.diff(g.astype(int), prepend=0) == 1).sum()), bytes(np.frombuffer(b, np.uint8)[~g])) for b, g in zip(bodies, gone, strict=True)]


def repeated_texts(seed, alphabet, length):
    draw = random.Random(seed)

    def prose(n):
        return "".join(draw.choice(alphabet) for _ in range(n))

    shared = [prose(draw.randint(length - 3, 3 * length)) for _ in range(6)]
    texts = [None, "", "x", prose(length - 1), prose(length), "ä" * length, prose(20 * length)]
    for _ in range(60):
        parts = [prose(draw.randint(0, length)) if draw.random() < 0.5 else draw.choice(shared) for _ in range(draw.randint(1, 6))]
        whole = "".join(parts)
        if draw.random() < 0.3 and whole:  # an edit within a copy
            at = draw.randrange(len(whole))
            whole = whole[:at] + "é" + whole[at + 1 :]
        texts.append(whole)
    return texts + [texts[-1], texts[-1], "ab" * length * 2, "q" * (3 * length), "q" * (length + 1)]


@pytest.mark.parametrize(("length", "alphabet", "few"), [(32, "ab", True), (40, "abcdefgh ", False), (200, "abcdefgh ", True)])
def test_repeats(spark, monkeypatch, length, alphabet, few):
    monkeypatch.setattr(repeats, "BROADCAST_ROWS", 500_000 if few else 0)
    texts = repeated_texts(length, alphabet, length)
    rows = list(enumerate(texts)) + [(None, texts[8]), (5, texts[8]), (None, texts[-4])]  # same ids, null ids, rows repeated whole
    rows.append(rows[-1])
    got = repeats.without_repeats(frame(spark, rows), length=length).collect()
    want = plain_repeats([t for _, t in rows], length)
    made = [(r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.removed), len(r.removed), bytes(r.kept)) for r in got]
    assert sorted(map(repr, made)) == sorted(repr((i, *w)) for (i, _), w in zip(rows, want, strict=True))
    assert 0 < sum(w[1] for w in want) < sum(w[0] for w in want)


def test_repeats_of_a_very_long_text(spark):
    draw = random.Random(5)
    long = "".join(draw.choice("abcdefghij klmnop") for _ in range(3_000_000))
    got = {r.doc_id: r for r in repeats.without_repeats(spark.createDataFrame([(1, long), (2, "zz" + long[1_048_000:1_049_500] + "zz")], "doc_id long, text string")).collect()}
    assert [tuple(s) for s in got[1].removed] == [(1_048_000, 1_049_500)]
    assert [tuple(s) for s in got[2].removed] == [(2, 1_502)]
    assert bytes(got[2].kept) == b"zzzz"


def test_repeats_without_rows_and_refused_length(spark):
    empty = spark.createDataFrame([], "doc_id string, text string")
    assert repeats.without_repeats(empty).collect() == []
    with pytest.raises(ValueError, match="32 bytes"):
        repeats.without_repeats(empty, length=31)


def test_phrases_do_not_depend_on_pieces(monkeypatch):
    body = np.frombuffer("".join(repeated_texts(1, "abc", 60)[6:]).encode(), dtype=np.uint8)
    offsets = np.array([0, 100, 100, 1500, len(body)])
    found = []
    for piece in (400, 1 << 20):
        monkeypatch.setattr(repeats, "_CHUNK", piece)
        found.append([np.concatenate(c) for c in zip(*repeats.phrases(body, offsets, 60), strict=True)])
    assert all(np.array_equal(a, b) for a, b in zip(*found, strict=True))
    text, trigger, first, last = found[0][:4]
    assert (last - first + 1).sum() == sum(max(0, n - 59) for n in np.diff(offsets))
    by_string = {}
    for t, a, b in zip(trigger.tolist(), first.tolist(), last.tolist(), strict=True):
        for s in range(a, b + 1):
            by_string.setdefault(body[s : s + 60].tobytes(), set()).add(t - s)
    assert all(len(places) == 1 for places in by_string.values())


def test_suffix_array_intervals_reach_over_partitions(spark):
    draw = random.Random(7)
    strings = sorted({bytes(draw.choice(b"ab") for _ in range(draw.randint(0, 12))) for _ in range(300)} | {b"", b"aaaaaaaaaaaaaaaa"})
    table, joined = repeats.suffix_array(spark.createDataFrame([(bytearray(s),) for s in strings * 2], "s binary").repartition(5), "test-array")
    assert joined
    rows = {bytes(r.string): r for r in table.collect()}
    assert sorted(rows) == strings
    for depth in (1, 2, 5, 9):
        groups, names = {}, {}
        for s in strings:
            if len(s) >= depth:
                name = int(repeats._named(rows[s].depths, rows[s].names, np.array([depth]), joined)[0])
                groups.setdefault(s[:depth], set()).add(name)
                names.setdefault(name, set()).add(s[:depth])
        assert all(len(g) == 1 for g in groups.values()) and all(len(g) == 1 for g in names.values())


# periodic runs


def plain_runs(w, least):
    found = {}
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j > i and j - i + p >= max(least, 2 * p):
                found.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted((s, p, n) for (s, n), p in found.items())


def sequences():
    draw = random.Random(1)
    fibonacci = [[0], [0, 1]]
    while len(fibonacci[-1]) < 300:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    out = [fibonacci[-1], [k.bit_count() & 1 for k in range(300)], [1] * 200, [1, 2] * 90, [], [1] * 11, [1] * 12, [1] * 23 + [2] + [1] * 13]
    for _ in range(120):
        w = [draw.randrange(draw.choice([1, 2, 3, 5])) for _ in range(draw.randint(0, 90))]
        stretch = [draw.randrange(9) for _ in range(draw.randint(1, 25))]
        out.append(w + stretch * draw.randint(0, 5) + stretch[: draw.randint(0, 9)] + w[:7])
    return out


@pytest.mark.parametrize("least", [1, 5, 12, 31])
@pytest.mark.parametrize("step", [1, 17, 10_000])
def test_catchers(least, step):
    for w in sequences()[:: 4 if step == 1 else 1]:
        catchers, symbols = periods.Catchers(least), np.array(w, dtype=np.uint64)
        for k in range(0, len(w), step):
            catchers.append(symbols[k : k + step], np.zeros(len(symbols[k : k + step]), dtype=np.int64))
        start, length, period = catchers.runs()
        assert list(zip(start.tolist(), period.tolist(), length.tolist(), strict=True)) == plain_runs(w, least)


def test_runs_of_documents(spark):
    texts = [" ".join(f"w{x}" for x in w) for w in sequences()]
    texts += [None, "", " \t\n", "One one  ONE", "a\tb\n" * 20, "é è " * 9 + "\x1c", "x" * 100_000 + " y", texts[3], texts[3]]
    rows = [(k if k % 5 else None, t) for k, t in enumerate(texts)]
    got = periods.runs(frame(spark, rows)).collect()
    want = []
    for i, t in rows:
        split = (t or "").encode().split()
        found = plain_runs(split, 12)
        gone = {k for s, p, n in found for k in range(s + p, s + n)}
        want.append((i, len(split), found, b" ".join(x for k, x in enumerate(split) if k not in gone).decode()))
    assert sorted(repr((r.doc_id, r.n_words, [(x.start, x.period, x.length) for x in r.runs], r.collapsed)) for r in got) == sorted(map(repr, want))


def test_runs_of_very_long_texts(spark):
    rows = [(1, "a " * 300_000), (2, " ".join(str(k * k % 1009) for k in range(200_000)))]
    got = {r.doc_id: r for r in periods.runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [tuple(x) for x in got[1].runs] == [(0, 300_000, 1)] and got[1].collapsed == "a"
    assert [tuple(x) for x in got[2].runs] == [(0, 200_000, 1009)]


def test_runs_without_rows(spark):
    assert periods.runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []


# hard negatives


def plain_negatives(rows, anchors, k=5, n=3, least=50, most=95):
    used = {(i, y, tuple(v)) for i, v, y in rows if i is not None and y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    used = sorted((i, y, [int(np.floor(256 * x)) for x in v]) for i, y, v in used)
    out = []
    for a in [x for x in used if x[0] % anchors == 0]:
        scored = [(-sum(p * q for p, q in zip(a[2], b[2], strict=True)), b[0], b[1]) for b in used if b is not a and len(b[2]) == len(a[2])]
        for p, i, _ in sorted(x for x in scored if x[2] == a[1])[:k]:
            fit = sorted((s, j) for s, j, y in scored if y != a[1] and least * -p <= 100 * -s <= most * -p)[:n]
            out += [(a[0], i, r, j, -p, -s) for r, (s, j) in enumerate(fit, 1)]
    return sorted(out)


def labelled(seed):
    draw = np.random.default_rng(seed)
    rows = []
    for _ in range(14):
        middle = draw.normal(size=5)
        rows += [((middle + draw.normal(size=5) * 0.3).round(2).tolist(), int(y)) for y in draw.integers(0, 3, 25)]
    rows += [([0.25] * 5, 1)] * 30 + [(draw.normal(size=3).round(2).tolist(), int(y)) for y in draw.integers(0, 2, 25)]
    rows += [([], 0), ([0.0] * 5, 2), (None, 1), ([1.0, None, 0.0, 0.0, 0.0], 1), ([float("nan")] * 5, 1), ([float("inf")] * 5, 0), ([1.0] * 5, None)]
    ids = draw.permutation(len(rows)).tolist()
    rows = [(i, v, y) for i, (v, y) in zip(ids, rows, strict=True)]
    return rows + [rows[0], rows[1], (None, [1.0] * 5, 1)]


@pytest.mark.parametrize(("cell", "block"), [(12, 8), (2048, 4096)])
def test_hard_negatives(spark, monkeypatch, cell, block):
    monkeypatch.setattr(vectors, "CELL", cell)
    monkeypatch.setattr(vectors, "BLOCK", block)
    monkeypatch.setattr(negatives, "ANCHORS", block)
    rows = labelled(3)
    df = spark.createDataFrame([(i, v, y, 1, "l") for i, v, y in rows], "vec_id long, embedding array<double>, label int, row int, leaf string")
    got = negatives.hard_negatives(df, F.col("vec_id") % 4 == 0)
    want = plain_negatives(rows, 4)
    assert sorted(tuple(r) for r in got.collect()) == want
    assert len(want) > 300


def test_hard_negatives_of_huge_components(spark):
    draw = np.random.default_rng(9)
    rows = [(i, [float(x) for x in draw.integers(-50, 1_000_000, 3)], i % 2) for i in range(40)]
    got = negatives.hard_negatives(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long"), F.col("vec_id") % 10 == 0)
    assert sorted(tuple(r) for r in got.collect()) == plain_negatives(rows, 10)


def test_hard_negatives_without_rows(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert negatives.hard_negatives(spark.createDataFrame([], schema), F.col("vec_id") % 4 == 0).collect() == []
    assert negatives.hard_negatives(spark.createDataFrame([(1, [1.0], 1)], schema), F.col("vec_id") % 4 == 0).collect() == []
    with pytest.raises(ValueError, match="whole number"):
        negatives.hard_negatives(spark.createDataFrame([], "vec_id long, embedding array<float>, label string"), F.col("vec_id") % 4 == 0)


def test_tree_rules_out_only_what_is_outside():
    draw = np.random.default_rng(4)
    points = np.concatenate([draw.normal(size=(60, 3)) * 0.1 + 3 * draw.normal(size=3) for _ in range(20)])
    tree = negatives.Tree(points[::3], 24)
    leaf, seen = tree.descend(points)
    for node, far, home in seen:
        for j in np.unique(home):
            tree.low[node][:, j], tree.high[node][:, j] = far[home == j].min(axis=0), far[home == j].max(axis=0)
    asked = points[::7]
    near, wide = np.full(len(asked), 0.5), np.full(len(asked), 2.0)
    open_ = tree.within(asked, near, wide)
    true = vectors.distances(asked, points)
    for k in range(len(asked)):
        assert set(leaf[(true[k] >= 0.5) & (true[k] <= 2.0)]) <= set(np.flatnonzero(open_[k]))
    assert tree.leaves > 10 and open_.mean() < 0.6


def test_grid_lines_are_shared_out():
    dealt = grid.deal({(5, 0): 10, (5, 1): 1000, (5, 2): 10, (5, 3): 10}, 4)
    assert len(dealt[5, 1]) == 4 and dealt[5, 2] == dealt[5, 3]
    assert grid.lines(10, 512) == 1 and grid.lines(512 * 100, 512) == 10 and grid.deal({}, 1) == {}
