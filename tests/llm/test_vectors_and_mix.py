"""Vector joins, mixing, registered SQL and the pipeline against plain versions."""

import hashlib
import math
import os
import re
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chalkline.llm import embeddings, mixing, nearest, queries, vectors

SMALL = "/root/testdata/sf0.001"
ODD = [None, [], [0.0, 0.0], [1.0, None], [float("nan"), 1.0], [float("inf"), 0.0]]


@pytest.fixture(scope="module")
def points():
    """Clusters, copies, a hot vector and vectors of another length."""
    draw = np.random.default_rng(2)
    rows = []
    for _ in range(12):
        middle = draw.normal(size=6)
        rows += [(middle + draw.normal(size=6) * 0.12).round(3).tolist() for _ in range(12)]
    rows += [[0.5] * 6] * 60 + [[1e-200 * x for x in range(1, 7)], [1e200 * x for x in range(1, 7)]]
    rows += draw.normal(size=(40, 3)).tolist()
    order = draw.permutation(len(rows)).tolist()
    return {i: rows[k] for i, k in enumerate(order)}


def unit(v):
    v = np.array(v) / max(map(abs, v))
    return v / math.sqrt(v @ v)


@pytest.mark.parametrize("cell", [8, 2048])
def test_near_vectors(spark, points, monkeypatch, cell):
    monkeypatch.setattr(vectors, "CELL", cell)
    monkeypatch.setattr(vectors, "BLOCK", cell)
    rows = [(i, v, 1, "c") for i, v in points.items()] + [(9000 + k, v, 1, "c") for k, v in enumerate(ODD)]
    rows += [(None, [9.0, 0.0, 0.0, 0.0, 0.0, -9.0], 1, "c"), (None, ODD[2], 1, "c")]
    got = embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, node int, links string"))
    own = {i: unit(v) for i, v in points.items()}
    near = {i: [j for j, w in own.items() if j != i and len(w) == len(v) and v @ w >= 0.95] for i, v in own.items()}
    label = {i: i for i in own}
    for _ in own:
        label = {i: min([label[i], *(label[j] for j in near[i])]) for i in own}
    want = [(i, len(near[i]), label[i], label[i] == i) for i in own] + [(9000 + k, 0, 9000 + k, True) for k in range(len(ODD))]
    found = got.collect()
    assert sorted(tuple(r) for r in found if r.vec_id is not None) == sorted(want)
    assert [tuple(r) for r in found if r.vec_id is None] == [(None, 0, None, True)] * 2
    assert sum(map(len, near.values())) > 1000


def test_near_vectors_writes_each_vector_once(spark, points, monkeypatch):
    """However many cells a vector is near to."""
    monkeypatch.setattr(vectors, "CELL", 8)
    monkeypatch.setattr(vectors, "BLOCK", 8)
    written = {}
    kept = embeddings.materialized
    monkeypatch.setattr(embeddings, "materialized", lambda df, name: written.setdefault(name, kept(df, name)))
    embeddings.near_vectors(spark.createDataFrame([(i, v) for i, v in points.items()], "vec_id long, embedding array<double>")).collect()
    total = written["vector-nodes"].count()
    held = [r.nodes for r in written["vector-blocks"].select("nodes").collect()]
    assert sum(len(nodes) // 8 for nodes in held) == total and len(held) > total / 20
    assert all(df.count() <= total for name, df in written.items() if name != "vector-links")


def test_links_of_few_and_of_many():
    draw = np.random.default_rng(3)
    few = embeddings._units(draw.normal(size=(700, 16)))
    few[600:] = embeddings._units(few[:100] + 0.05 * draw.normal(size=(100, 16)))
    many = embeddings._units(1 + 0.3 * draw.normal(size=(700, 16)))
    for points, least in ((few, 0.95), (many, 0.9), (many, -1.0)):
        got = [np.concatenate(x) for x in zip(*embeddings._links(points, points, least), strict=True)]
        want = np.nonzero(points @ points.T >= least)
        assert [x.tolist() for x in got] == [x.tolist() for x in want]


def test_near_vectors_without_rows(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embeddings.near_vectors(empty).count() == 0
    odd = spark.createDataFrame([(k, v) for k, v in enumerate(ODD)], "vec_id long, embedding array<float>")
    assert {tuple(r) for r in embeddings.near_vectors(odd).collect()} == {(k, 0, k, True) for k in range(len(ODD))}


@pytest.mark.parametrize("cell", [8, 2048])
def test_top_by_inner_product(spark, points, monkeypatch, cell):
    monkeypatch.setattr(vectors, "CELL", cell)
    monkeypatch.setattr(vectors, "BLOCK", cell)
    monkeypatch.setattr(nearest, "GROUP", cell)
    usable = {i: v for i, v in points.items() if max(map(abs, v)) < 1e6}
    rows = [(i, v, 0) for i, v in usable.items()] + [(9000 + k, v, 0) for k, v in enumerate(ODD) if k != 1]
    rows += [(None, [1.0] * 6, 0), (7000, [2.0, 1.0], 0)] + [(i, usable[i], 0) for i in list(usable)[:40]]
    usable |= {9002: ODD[2], 7000: [2.0, 1.0]}
    got = nearest.top_by_inner_product(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int"), F.col("vec_id") % 10 == 0, k=10
    )
    whole = {i: [math.floor(1024 * x) for x in v] for i, v in usable.items()}
    want = []
    for q, a in whole.items():
        if q % 10 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in whole.items() if i != q and len(a) == len(b))
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores[:10])]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_top_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert nearest.top_by_inner_product(empty, F.col("vec_id") % 100 == 0).count() == 0
    one = spark.createDataFrame([(100, [1.0])], "vec_id long, embedding array<float>")
    assert nearest.top_by_inner_product(one, F.col("vec_id") % 100 == 0).count() == 0
    none = spark.createDataFrame([(1, [1.0]), (2, [3.0])], "vec_id long, embedding array<float>")
    assert nearest.top_by_inner_product(none, F.col("vec_id") % 100 == 0).count() == 0


def shares(nodes, weight, capacity, budget, depth, levels):
    """Budgets of leaves: fill the children that can't take their share, one after the other, then split the rest."""
    if depth == levels:
        return {nodes[0]: budget}
    children = defaultdict(list)
    for leaf in nodes:
        children[leaf[depth]].append(leaf)
    heavy = {c: sum(weight[n] for n in v) for c, v in children.items()}
    room = {c: sum(capacity[n] for n in v) for c, v in children.items()}
    given, left, rest = {}, budget, sum(heavy.values())
    for c in sorted(children, key=lambda c: (room[c] / heavy[c], room[c], c)):
        if room[c] * rest > left * heavy[c]:
            break
        given[c], left, rest = room[c], left - room[c], rest - heavy[c]
    out = {}
    for c, v in children.items():
        out |= shares(v, weight, capacity, given.get(c, left * heavy[c] // rest if rest else 0), depth + 1, levels)
    return out


@pytest.mark.parametrize(("permille", "epochs", "rows_in_range"), [(500, 2, 3), (900, 1, 10_000), (1500, 2, 5), (5000, 2, 5), (0, 1, 5)])
def test_mix(spark, monkeypatch, permille, epochs, rows_in_range):
    monkeypatch.setattr(mixing, "RANGE_ROWS", rows_in_range)
    texts = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    rows = [(i, t, ("d1", "d2", None)[i % 3], lang, s if i % 2 else "hot", "e") for i, t, lang, s in texts]
    rows += [(5000, None, "d1", "en", "hot", "e"), (5001, "", "d1", "en", "hot", "e"), (5002, "no weight", "d9", "en", "x", "e"), (5003, None, "d8", "en", "void", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, domain string, lang string, source string, epoch string")
    leaves = {(r[2] or "", r[3], r[4]) for r in rows if r[2] != "d9"}
    weight = {leaf: 1 + (len(leaf[0]) + len(leaf[2])) % 3 for leaf in leaves}
    weights = spark.createDataFrame([(d or None, la, s, w) for (d, la, s), w in weight.items()], "domain string, lang string, source string, weight long")
    got = mixing.mix(docs, weights, permille, epochs)
    assert got.columns == ["doc_id", "text", "domain", "lang", "source", "n_words", "epoch"]
    words = {r[0]: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows}
    members = defaultdict(list)
    for r in rows:
        if r[2] != "d9":
            members[r[2] or "", r[3], r[4]].append(r[0])
    capacity = {leaf: epochs * sum(words[i] for i in v) for leaf, v in members.items()}
    budget = shares(sorted(members), weight, capacity, sum(words.values()) * permille // 1000, 0, 3)
    want = []
    for leaf, ids in members.items():
        left = budget[leaf]
        for epoch in range(1, epochs + 1):
            placed = sorted(ids, key=lambda i, e=epoch: hashlib.md5(f"7:{e}:{i}".encode()).hexdigest()[:15])
            taken = []
            for i in placed:
                if words[i] > left or not capacity[leaf]:
                    break
                left -= words[i]
                taken.append((i, epoch))
            want += taken
            if len(taken) < len(ids):
                break
    assert sorted((r.doc_id, r.epoch) for r in got.collect()) == sorted(want)


def test_mix_odd_rows(spark):
    rows = [(None, "a b", "en"), (None, "c d", "en"), (1, "e f", "en"), (1, "e f", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    weights = spark.createDataFrame([("en", 2)], "lang string, weight long")
    got = mixing.mix(docs, weights, permille=1000, epochs=1, levels=("lang",))
    assert sorted(r.text for r in got.collect()) == ["a b", "c d", "e f", "e f"]
    assert mixing.mix(docs, weights.limit(0), levels=("lang",)).count() == 0
    assert mixing.mix(docs.limit(0), weights, levels=("lang",)).count() == 0


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for file in sorted(os.listdir(SMALL)):
        c.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SMALL}/{file}')")
    return c


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_agrees_with_sql(spark, con, name):
    expected = con.execute(queries.ORACLES[name])
    names = [d[0] for d in expected.description]
    df = queries.QUERIES[name](spark, SMALL)
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    got = sorted(tuple(str(r[c]) for c in order) for r in df.collect())
    assert got == sorted(tuple(str(r[names.index(c)]) for c in order) for r in expected.fetchall())


def test_native_queries_run_no_python(spark):
    for name in ("op2_mixing", "op6_chat", "op7_secrets", "op9_hosts"):
        plan = queries.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas|Cartesian|BroadcastNestedLoop", plan), name


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        docs = stage(spark, docs, SMALL)
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == columns
        after = {r.doc_id for r in docs.select("doc_id").collect()}
        assert after <= before and after
        if name == "quality classifier":
            assert not [i for i in before - after if labels.get(i) == 1]
    assert docs.columns == ["doc_id", "n_tokens", "ids", "decodes"]
    rows = docs.collect()
    assert all(r.decodes and len(r.ids) == 4 * r.n_tokens for r in rows)
    ran = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted((r.doc_id, bytes(r.ids)) for r in ran) == sorted((r.doc_id, bytes(r.ids)) for r in rows)


def test_mixing_sql_leaves_out_leaves_without_words():
    con = duckdb.connect()
    con.execute("create table documents as select * from (values (1, 'a b c d', 'en', 'x'), (2, 'e f g h', 'en', 'x'), (3, '', 'en', 'void'), (4, null, 'en', 'x')) v(doc_id, text, lang, source)")
    found = con.execute(queries.mixing_sql("documents")).fetchall()
    assert found and 3 not in {r[0] for r in found}
