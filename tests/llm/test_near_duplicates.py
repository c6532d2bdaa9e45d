"""MinHash near-dedup and line dedup against brute force."""

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chalkline.llm import lines, links, minhash, words

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, node string, row int, component double"


def frame(spark, rows):
    """Documents with columns that bear the operators' inner names."""
    return spark.createDataFrame([(i, t, "n", 1, 0.5) for i, t in rows], SCHEMA)


def odd_texts():
    long = " ".join(f"t{k}" for k in range(30_000))
    return [None, "", " \t\n ", "one", "ONE", "one two three", "one  two\nthree", long, long + " end", "\x00\x1c é", "a b c d e"]


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    texts = odd_texts() + brute.variants(1, 60, 80, 6) + brute.variants(2, 40, 120, 12) + ["same as ever and ever"] * 30
    return rows + [(10_000 + k, t) for k, t in enumerate(texts)]


def test_word_hashes_tell_words_apart():
    texts = ["Ab c", "", "ab\tC ", "ä Ä", "\n", "x" * 3_000_000 + " y"]
    body, offsets = words.buffers(pa.array(texts))
    hashes, _, counts = words.word_hashes(body, offsets)
    assert counts.tolist() == [2, 0, 2, 2, 0, 2]
    assert hashes[0] == hashes[2] and hashes[1] == hashes[3] and hashes[4] != hashes[5]


def test_shingles_are_those_of_the_words(documents):
    body, offsets = words.buffers(pa.array([t for _, t in documents], pa.string()))
    hashes, _, counts = words.word_hashes(body, offsets)
    _, sizes = words.distinct(*words.shingles(hashes, counts))
    assert sizes.tolist() == [len(brute.shingles(t)) for _, t in documents]


@pytest.mark.parametrize("block", [8, 512])
def test_minhash_components(spark, documents, monkeypatch, block):
    monkeypatch.setattr(links, "BLOCK", block)
    got = {r.doc_id: r for r in minhash.near_duplicates(frame(spark, documents)).collect()}
    sets = {i: brute.shingles(t) for i, t in documents}
    want = brute.components(sets, 85)
    assert {i: r.component_id for i, r in got.items()} == want
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert all(r.kept == (i == want[i]) for i, r in got.items())
    stay = minhash.without_near_duplicates(frame(spark, documents))
    assert stay.columns == ["doc_id", "text", "node", "row", "component"]
    assert sorted(r.doc_id for r in stay.collect()) == sorted(i for i in want if want[i] == i)


def test_pipeline_drops_near_duplicates_from_80_percent_on(spark):
    rows = [(k, t) for k, t in enumerate(brute.variants(1, 60, 80, 6) + brute.variants(2, 40, 120, 12))]
    base = [f"v{k}" for k in range(94)]
    # 90 shingles each, of which the first text has 80 in common with the second and 79 with the third
    for k, (low, high) in enumerate(((0, 94), (10, 94), (0, 83))):
        rows.append((1000 + k, " ".join([f"a{j}" for j in range(low)] + base[low:high] + [f"z{j}" for j in range(high, 94)])))
    sets = {i: brute.shingles(t) for i, t in rows}
    assert [(len(sets[1000] & sets[k]), len(sets[1000] | sets[k])) for k in (1001, 1002)] == [(80, 100), (79, 101)]
    want = brute.components(sets, 80)
    assert want != brute.components(sets, 85)
    stay = corpus_pipeline.distinct_documents(spark, frame(spark, rows), SF)
    assert sorted(r.doc_id for r in stay.collect()) == sorted(i for i in want if want[i] == i)


def test_matches_follow_the_threshold():
    assert [minhash.matches_for(p) for p in (100, 85, 80, 60)] == [32, 17, 15, 7]
    with pytest.raises(ValueError):
        minhash.matches_for(10)


def test_minhash_edges(spark):
    rows = [(None, "a b c"), (3, "a b c"), (3, "a b c"), (None, None), (2, "A B C"), (None, "lonely words stand here")]
    got = sorted(minhash.near_duplicates(frame(spark, rows)).drop("row").collect(), key=str)
    assert got == sorted(
        [(None, 1, 2, False), (3, 1, 2, False), (3, 1, 2, False), (None, 0, None, True), (2, 1, 2, True), (None, 1, None, True)], key=str
    )
    assert minhash.near_duplicates(frame(spark, [])).count() == 0
    assert minhash.without_near_duplicates(frame(spark, [])).count() == 0


def test_components_of_a_long_chain(spark):
    draw = np.random.default_rng(0)
    names = draw.permutation(300).tolist()
    chain = spark.createDataFrame([(names[k], names[k + 1]) for k in range(299)], "a long, b long").repartition(16)
    assert {tuple(r) for r in links.components(chain).collect()} == {(n, 0) for n in names}
    assert links.components(chain.limit(0)).count() == 0


@pytest.mark.parametrize("block", [8, 512])
def test_fuzzy_lines(spark, documents, monkeypatch, block):
    monkeypatch.setattr(links, "BLOCK", block)
    rows = documents + [(20_000 + k, f"{a}\n\n{b}") for k, (a, b) in enumerate(zip(brute.variants(3, 30, 20, 2), brute.variants(4, 30, 30, 4), strict=True))]
    got = {(r.doc_id, r.line_no): r for r in lines.fuzzy_lines(frame(spark, rows)).collect()}
    want = brute.components(brute.lines(rows), 80)
    assert {k: (r.first_doc_id, r.first_line_no) for k, r in got.items()} == want
    assert all(r.kept == (want[k] == k) for k, r in got.items())
    left = lines.without_repeated_lines(frame(spark, rows))
    assert left.columns == ["doc_id", "text", "node", "row", "component"]
    texts = {}
    for i, text in rows:
        own = [k for k in want if k[0] == i]
        if not own or any(want[k] == k for k in own):
            parts = (text or "").split("\n")
            kept = [line for k, line in enumerate(parts) if (i, k) not in want or want[i, k] == (i, k)]
            texts[i] = None if text is None else "\n".join(kept)
    assert {r.doc_id: r.text for r in left.collect()} == texts


def test_fuzzy_lines_refuse_thresholds_that_the_bands_miss(spark):
    with pytest.raises(ValueError):
        lines.fuzzy_lines(frame(spark, []), percent=79)
    assert lines.fuzzy_lines(frame(spark, []), percent=90).count() == 0


def test_fuzzy_lines_edges(spark):
    rows = [(None, "a line of text\nonly here it is"), (5, "A line of text"), (5, "A line of text"), (6, None), (7, "\n \n"), (4, "a line of text\nmore\nmore")]
    got = sorted((r.doc_id, r.line_no, r.first_doc_id, r.first_line_no, r.kept) for r in lines.fuzzy_lines(frame(spark, rows)).where("doc_id is not null").collect())
    assert got == [(4, 0, 4, 0, True), (4, 1, 4, 1, True), (4, 2, 4, 1, False), (5, 0, 4, 0, False), (5, 0, 4, 0, False)]
    nameless = lines.fuzzy_lines(frame(spark, rows)).where("doc_id is null").select("line_no", "first_doc_id", "kept").collect()
    assert sorted(map(tuple, nameless)) == [(0, 4, False), (1, None, True)]
    left = {(r.doc_id, r.text) for r in lines.without_repeated_lines(frame(spark, rows)).collect()}
    assert left == {(None, "only here it is"), (6, None), (7, "\n \n"), (4, "a line of text\nmore")}
    assert lines.fuzzy_lines(frame(spark, [])).count() == 0
    assert lines.without_repeated_lines(frame(spark, [])).count() == 0


def test_rest_links_are_found(spark, monkeypatch):
    """Copies that are similar to each other but not to the least of their buckets."""
    monkeypatch.setattr(links, "BLOCK", 4)
    texts = []
    for k in range(12):
        texts += brute.variants(50 + k % 3, 3, 60, 9 - k // 2)
    rows = [(k, t) for k, t in enumerate(texts)]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.components({i: brute.shingles(t) for i, t in rows}, 85)


def test_sets_fit_is_exact(spark):
    row = spark.range(1).select(
        links.sets_fit(F.array(*map(F.lit, range(17))), F.array(*map(F.lit, range(20))), 85).alias("at"),
        links.sets_fit(F.array(*map(F.lit, range(16))), F.array(*map(F.lit, range(19))), 85).alias("below"),
    ).first()
    assert (row["at"], row["below"]) == (True, False)


def test_small_cells_are_compared_together(monkeypatch):
    """Cells of a few nodes and of many, whole and in pairs of blocks, in batches cut anywhere."""
    draw = np.random.Generator(np.random.PCG64(4))
    number, marks = 900, 3
    seeds = draw.integers(0, 1 << 62, (60, 40))
    sets = []
    for _ in range(number):
        values = seeds[draw.integers(60)].copy()
        changed = draw.integers(40, size=draw.integers(8))
        values[changed] = draw.integers(0, 1 << 62, len(changed))
        sets.append(np.unique(values))
    values = draw.integers(0, (40, 90, 250), (number, marks))
    values[:150, 0] = 1000  # a bucket of many

    def fit(i, j):
        both = len(np.intersect1d(sets[i], sets[j]))
        return both * 100 >= (len(sets[i]) + len(sets[j]) - both) * 80

    buckets = [(m, v, np.flatnonzero(values[:, m] == v)) for m in range(marks) for v in np.unique(values[:, m]).tolist()]
    buckets = [b for b in buckets if len(b[2]) > 2]
    every = [(int(i), int(j)) for _, _, n in buckets for k, i in enumerate(n) for j in n[k + 1 :] if fit(i, j)]
    stars = [(int(n[0]), int(j)) for _, _, n in buckets for j in n[1:] if fit(n[0], j)]
    want, star = (links.forest(*np.array(x).T) for x in (every, stars))
    assert want != star
    rows = []
    for m, v, nodes in buckets:
        blocks = 2 if v % 3 == 0 else 1
        for low, high in [(0, 0), (0, 1), (1, 1)][: 2 * blocks - 1]:
            inside = [n for n in nodes.tolist() if n % blocks in (low, high)]
            rows += [(m, v, low, high, int(nodes[0]), n, star.get(n, n), n % blocks, values[n].tolist(), 7, sets[n].tolist()) for n in inside]
    names = ["mark", "value", "low", "high", "center", "node", "component", "block", "marks", "posted", "content"]
    table = pa.table(dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)))
    made = []

    class Counted(links.ArrayContents):
        def __init__(self, column):
            made.append(len(column))
            super().__init__(column)

    for size in (7, 100, len(rows)):
        made.clear()
        out = list(links._rest(Counted, 1, 80)(iter(table.combine_chunks().to_batches(size))))
        a, b = (np.concatenate([x.column(k).to_numpy() for x in out]) for k in (0, 1))
        assert {n: k for n, k in links.forest(np.r_[a, list(star)], np.r_[b, list(star.values())]).items()} == want
    assert len(made) <= 5 < len(buckets) // 10, "one for the small cells, and one for each large one"
    monkeypatch.setattr(links, "GROUP_BYTES", 1)
    out = list(links._rest(Counted, 1, 80)(iter(table.to_batches())))
    a, b = (np.concatenate([x.column(k).to_numpy() for x in out]) for k in (0, 1))
    assert links.forest(np.r_[a, list(star)], np.r_[b, list(star.values())]) == want
