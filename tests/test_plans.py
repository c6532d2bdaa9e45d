"""Shapes the physical plans must keep."""

import re

import pytest
from pyspark.sql import functions as F

from chalkline.operators import joins, mastery
from chalkline.registry.model import Model

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The plan as it was run: branches for hot groups that turned out empty are gone."""
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def model(spark):
    return Model(spark, SF)


def test_running_best_needs_one_shuffle(model):
    events = model.t["events"].select("event_id", "user_id", "event_type", "ts", "value")
    text = final_plan(mastery.running_best(events, ["user_id", "event_type"], "ts", "value", ["event_id"]))
    assert text.count("Exchange") == 1
    assert "props" not in text


def test_latest_mastery_skips_the_window(model):
    fact = model.table["fact_student_mastery_daily"]
    assert "Window" in plan(fact)
    text = plan(mastery.latest_mastery(fact, ["student_id", "standard_code"]))
    assert "Window" not in text and "partial_max" in text


def test_filters_and_columns_reach_the_scan(model):
    rows = joins.orphans(
        model.t["orders"].filter(F.col("o_totalprice") > 1000).select("o_orderkey", "o_custkey"),
        model.t["customer"],
        {"o_custkey": "c_custkey"},
        null_is_orphan=False,
    )
    text = plan(rows)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(o_totalprice,1000", text)
    assert "o_orderpriority" not in text and "c_name" not in text
    assert "LeftAnti" in text


def test_large_sides_are_not_broadcast(spark, model):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("dim_student", "fact_assessment_responses", "agg_early_warning", "agg_district_comparison"):
            text = final_plan(Model(spark, SF).table[name])
            assert "Broadcast" not in text, name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
