"""Every registered query against its SQL, on the smallest tables; none may need a cross join or Python rows."""

import math
import os

import duckdb
import pytest

from chalkline import registry
from chalkline.registry import tables

SF = "/root/testdata/sf0.001"
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")
QUERIES, ORACLES = registry.load()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for file in sorted(os.listdir(SF)):
        c.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SF}/{file}')")
    return c


def cell(v):
    if v is None:
        return ""
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 8))
    return v.isoformat() if hasattr(v, "isoformat") else repr(v)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for word in UNWANTED:
        assert word not in plan
    expected = con.execute(ORACLES[name])
    names = [d[0] for d in expected.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    got = sorted(tuple(cell(r[c]) for c in order) for r in df.collect())
    want = sorted(tuple(cell(r[names.index(c)]) for c in order) for r in expected.fetchall())
    assert got == want


def test_least_and_most_codes_are_those_of_empty_elements(spark, tmp_path):
    name, path = "xml_elements_with_attributes", str(tmp_path / "orders.parquet")
    status = "IF(id IN (0, 999) OR id % 7 = 0, 'P', 'O')"
    spark.range(1000).selectExpr("id + 1000 AS o_orderkey", f"{status} AS o_orderstatus").coalesce(1).write.parquet(path)
    for other in os.listdir(SF):
        if other != "orders.parquet":
            os.symlink(f"{SF}/{other}", tmp_path / other)
    c = duckdb.connect()
    c.execute(f"CREATE VIEW orders AS SELECT * FROM read_parquet('{path}/*.parquet')")
    got = QUERIES[name](spark, str(tmp_path)).first()
    assert tuple(got) == c.execute(ORACLES[name]).fetchone()
    assert (got.least, got.most) == ("1000", "1999")


def test_flattened_items_are_delivered_compressed(spark, tmp_path, monkeypatch):
    lines = [(1, 7, 1, 3.0, 0.1, "N"), (2, 8, 2, 4.0, 0.0, "R")]
    names = "l_orderkey long, l_suppkey long, l_linenumber int, l_quantity double, l_tax double, l_returnflag string"
    spark.createDataFrame(lines, names).write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(tables, "scratch_path", lambda spark, name: str(tmp_path / name))
    got = QUERIES["xml_items_flattened"](spark, str(tmp_path))
    assert sorted((r.student_unique_id, r.question_number, r.standard_code) for r in got.collect()) == [("S7", "1", "STD-1"), ("S7", "2", "ITEM-N")]
    written = list((tmp_path / "items").glob("part-*"))
    assert written and all(f.name.endswith(".txt.gz") for f in written)
