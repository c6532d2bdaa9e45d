"""Joins, personal data, unions, rules, checks and reports on small literal tables."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from chalkline.operators import analytics, joins, mastery, pii, quality, responses
from chalkline.operators.unify import Source, one_per_value, shared_values, unify
from chalkline.plans.queries import query
from chalkline.registry import reports
from chalkline.registry.model import Model


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [("1", "Alice", "Smith", "alice@example.com", "2015-03-14", 95), ("2", "Bob", "Jones", "bob@example.com", "2014-07-22", 88)],
        "id string, first_name string, last_name string, email string, birth_date string, score int",
    )


def test_hash_pii_columns(people):
    out = pii.hash_pii_columns(people, ["first_name", "last_name"], "email", "birth_date")
    assert out.columns == ["id", "score", "first_name_hash", "last_name_hash", "email_hash", "birth_year"]
    got = {r.id: r for r in out.collect()}
    assert (got["1"].birth_year, got["2"].birth_year) == (2015, 2014)
    assert len(got["1"].email_hash) == 64 and got["1"].email_hash != got["2"].email_hash
    again = {r.id: r for r in pii.hash_pii_columns(people, ["first_name", "last_name"], "email", "birth_date").collect()}
    assert got == again


def test_forbidden_columns_and_inventory(people, rows):
    assert rows(pii.forbidden_columns(people)) == [("birth_date",), ("email",), ("first_name",), ("last_name",)]
    masked = pii.hash_pii_columns(people, ["first_name", "last_name"], "email", "birth_date")
    assert rows(pii.forbidden_columns(masked)) == []
    hits = {(r.column_name, r["shape"]): r.hits for r in pii.pii_inventory(people).collect()}
    assert hits["email", "email"] == 2 and hits["birth_date", "birth_date"] == 2 and hits["first_name", "email"] == 0
    assert rows(pii.masking_table(masked), "field", "method")[0] == ("birth_date", "generalised to birth year")


def test_fan_out_keeps_unmatched_and_null(spark, rows):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n int")
    right = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "z")], "k string, v string")
    assert rows(joins.fan_out(left, right, "k", ["v"])) == [("a", 1, "x"), ("a", 1, "y"), ("b", 2, None), (None, 3, None)]


def test_orphans_and_null_keys(spark, rows):
    child = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("b", 4)], "k string, n int")
    parent = spark.createDataFrame([("a",), ("a",), (None,)], "id string")
    assert rows(joins.orphans(child, parent, {"k": "id"})) == [("b", 2), ("b", 4), (None, 3)]
    assert rows(joins.orphans(child, parent, {"k": "id"}, null_is_orphan=False)) == [("b", 2), ("b", 4)]
    assert joins.orphan_count(child, parent, {"k": "id"}).first()[0] == 2


def test_unify_casts_leniently(spark, rows):
    a = spark.createDataFrame([("1", "72.0"), ("2", "bad")], "id string, score string")
    b = spark.createDataFrame([("3", 5.5)], "key string, mark double")
    out = unify(
        [Source(a, {"id": "id", "score": "score", "term": None}), Source(b, {"id": "key", "score": "mark", "term": None})],
        {"score": "double"},
    )
    assert dict(out.dtypes) == {"id": "string", "score": "double", "term": "string"}
    assert rows(out) == [("1", 72.0, None), ("2", None, None), ("3", 5.5, None)]


def test_copies_across_sources(spark, rows):
    df = spark.createDataFrame(
        [("h1", "x", 1), ("h1", "y", 2), ("h1", "x", 3), ("h2", "x", 4), (None, "x", 5), (None, "y", 6)], "h string, s string, id int"
    )
    assert rows(shared_values(df, "h", "s")) == [("h1", 2, 3)]
    assert rows(one_per_value(df, "h", ["id"])) == [("h1", "x", 1), ("h2", "x", 4), (None, "x", 5), (None, "y", 6)]


def rules(parent):
    return [
        quality.Rule("known", "must be known", "k", "in parent", quality.ExistsIn(parent, "id"), "thing"),
        quality.Rule("small", "must be small", "n", "<= 2", F.col("n") > 2, "thing"),
    ]


def test_rules_route_and_log(spark, rows):
    df = spark.createDataFrame([("a", 1, "s"), ("b", 9, "s"), (None, 2, "t"), ("a", 7, "t")], "k string, n int, _source_system string")
    parent = spark.createDataFrame([("a",), ("a",)], "id string")
    passed, held = quality.route(df, rules(parent))
    assert rows(passed, "k", "n") == [("a", 1)]
    assert passed.count() + held.count() == df.count()
    log = quality.violations(df, rules(parent), F.lit("2026-01-01 00:00:00"), "k")
    assert rows(log, "source_system", "record_id", "rule_name", "field_value") == [
        ("s", "b", "known", "b"),
        ("s", "b", "small", "9"),
        ("t", "UNKNOWN", "known", None),
        ("t", "a", "small", "7"),
    ]
    totals = quality.route_totals(quality.with_failures(df, rules(parent))).first()
    assert tuple(totals) == (4, 1, 3)


def test_scorecard(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, "s", "2026-06-29T00:00:00"), ("a", 5, "s", "2026-06-01T00:00:00"), ("a", 1, "t", "2026-01-01T00:00:00")],
        "k string, n int, _source_system string, _loaded_at string",
    )
    parent = spark.createDataFrame([("a",)], "id string")
    card = quality.scorecard(quality.with_failures(df, rules(parent)), F.lit("2026-06-30"))
    assert rows(card, "_source_system", "ingested", "passed", "quarantined", "pass_rate", "freshness") == [
        ("s", 2, 1, 1, 50.0, "green"),
        ("t", 1, 1, 0, 100.0, "red"),
    ]


def test_generic_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("c", 3)], "k string, n int")
    parent = spark.createDataFrame([("a",)], "id string")
    report = quality.report(
        [
            quality.not_null(df, "t", ["k", "n"], warn=["k"]),
            quality.unique(df, "t", "k"),
            quality.accepted_values(df, "t", "k", ["a"]),
            quality.relationships(df, "t", "k", parent, "id", quality.WARN),
        ]
    )
    got = {(r.check, r.column): (r.violations, r.status) for r in report.collect()}
    assert got == {
        ("not_null", "k"): (1, "warn"),
        ("not_null", "n"): (0, "pass"),
        ("unique", "k"): (1, "fail"),
        ("accepted_values", "k"): (1, "fail"),
        ("relationships", "k"): (1, "warn"),
    }


def latest_rows(spark):
    data = [("s1", "A", 95.0), ("s1", "B", 30.0), ("s2", "A", 40.0), ("s2", "B", 20.0), ("s3", "B", 75.0)]
    df = spark.createDataFrame(data, "student_id string, standard_code string, max_score_to_date double")
    return df.withColumns({"mastery_level": mastery.x.mastery_level("max_score_to_date"), "assessment_count": F.lit(1)})


def standards(spark):
    return spark.createDataFrame(
        [("A", None, "Num", "Math"), ("B", "A", "Op", "Math"), ("C", "B", "Op", "ELA")],
        "standard_code string, prerequisite_standard_code string, domain string, subject string",
    )


def test_prerequisites(spark, rows):
    out = analytics.prerequisite_failures(latest_rows(spark), standards(spark))
    assert rows(out) == [("B", "A", 2, 1, 0.5, "Reteach the standard")]
    assert rows(analytics.ancestors(standards(spark), "standard_code", "prerequisite_standard_code")) == [
        ("B", "A", 1),
        ("C", "A", 2),
        ("C", "B", 1),
    ]


def test_prerequisite_cycle_ends(spark, rows):
    loop = spark.createDataFrame([("A", "B"), ("B", "A")], "i string, p string")
    assert rows(analytics.ancestors(loop, "i", "p")) == [("A", "B", 1), ("B", "A", 1)]


def test_matrix_share_histogram(spark, rows):
    latest = latest_rows(spark)
    assert rows(analytics.level_matrix(latest, "standard_code")) == [("A", 1, 0, 0, 1), ("B", 0, 1, 0, 2)]
    assert rows(analytics.level_share(latest)) == [("Exceeding", 1, 0.2), ("Meeting", 1, 0.2), ("Needs Intervention", 3, 0.6)]
    assert rows(analytics.score_histogram(latest, "max_score_to_date", 50)) == [(0.0, 3), (50.0, 2)]
    assert rows(analytics.heatmap(latest, "student_id", "standard_code", ["A", "B"])) == [
        ("s1", 95.0, 30.0),
        ("s2", 40.0, 20.0),
        ("s3", None, 75.0),
    ]
    assert analytics.hardest_item(latest, "standard_code").first()[0] == "B"


def test_gap_and_leaders(spark, rows):
    df = spark.createDataFrame(
        [("A", "d1", 0.9), ("A", "d2", 0.5), ("B", "d1", 0.4), ("B", "d2", 0.45), ("C", "d1", 0.3)],
        "standard_code string, district_id string, mastery_pct double",
    )
    gaps = analytics.group_gap(df, "standard_code", "district_id")
    assert rows(gaps, "standard_code", "leader", "trailer", "flagged") == [
        ("A", "d1", "d2", True),
        ("B", "d2", "d1", False),
        ("C", "d1", "d1", False),
    ]
    assert rows(analytics.leaders(gaps)) == [("d1", 1), ("d2", 1)]


def test_version_lift_counts_a_student_once(spark, rows):
    sections = spark.createDataFrame(
        [("x1", "Math", "A"), ("x2", "Math", "A"), ("x3", "Math", "B"), ("x4", "ELA", "B")],
        "section_id string, subject string, curriculum_version string",
    )
    memberships = spark.createDataFrame(
        [("s1", "x1"), ("s1", "x2"), ("s1", "x4"), ("s2", "x3")], "student_id string, section_id string"
    )
    lift = analytics.version_lift(latest_rows(spark), sections, memberships, standards(spark))
    assert rows(lift) == [("A", 1, 1.0, 1, 0.0, 1.0), ("B", 1, 0.0, 1, 0.0, 0.0)]


def test_instructional_groups(spark, rows):
    warning = spark.createDataFrame(
        [("s1", "Low", 1.0, 62.5), ("s9", "High", 0.5, 10.0)],
        "student_id string, risk_level string, attendance_rate double, avg_mastery_score double",
    )
    out = analytics.instructional_groups(warning, latest_rows(spark), standards(spark))
    assert rows(out, "student_id", "primary_weakness") == [("s1", "Op"), ("s9", None)]


def test_clusters_and_wrong_answers(spark, rows):
    tagged = spark.createDataFrame(
        [("s1", "A", "4", "5", False, "swap"), ("s1", "A", "4", "5", False, "swap"), ("s2", "A", "4", "4", True, None),
         ("s3", "A", "4", None, None, None), ("s3", "B", "1", "2", False, None)],
        "student_id string, standard_code string, correct_answer string, student_answer string, is_correct boolean, misconception_tag string",
    )
    assert rows(responses.misconception_clusters(tagged)) == [("A", "swap", 1, 2)]
    assert rows(responses.accuracy(tagged)) == [("A", 3, 1 / 3), ("B", 1, 0.0)]
    assert rows(responses.wrong_answers(tagged)) == [("A", "4", "5", 2, 2), ("B", "1", "2", 1, 0)]


def test_filters_options_drilldown(spark, rows):
    df = spark.createDataFrame(
        [("North", "x", 1, "s1"), ("North", "y", 2, "s2"), ("South", "z", 1, "s3"), (None, "w", 1, "s4")],
        "district_name string, school_id string, grade_level int, student_id string",
    )
    assert rows(analytics.options(df, "district_name")) == [("North",), ("South",)]
    assert rows(analytics.options(df, "school_id", district_name="North")) == [("x",), ("y",)]
    assert analytics.filtered(df, district_name="All", school_id=None).count() == 4
    injected = "North' OR '1'='1"
    assert analytics.filtered(df, district_name=injected).count() == 0
    n = {"students": F.count_distinct("student_id")}
    assert rows(analytics.drilldown(df, "school", n, district="North")) == [("x", 1), ("y", 1)]
    assert rows(analytics.drilldown(df, "student", n, district="South", grade=1)) == [("s3", 1)]


def test_ends_trend(spark, rows):
    df = spark.createDataFrame([("s", i, float(i * 10)) for i in range(1, 6)], "student_id string, assessment_count int, max_score_to_date double")
    assert rows(mastery.ends_trend(df, "student_id")) == [("s", 20.0, 40.0)]


def test_latest_per_key_nulls_first(spark, rows):
    df = spark.createDataFrame([("a", None, 1), ("a", "2025-01-01", 2), ("b", None, 3)], "k string, d string, v int")
    assert rows(mastery.latest_per_key(df, ["k"], ["d"])) == [("a", "2025-01-01", 2), ("b", None, 3)]


def test_parameterised_sql(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 5)], "k string, n int")
    assert rows(query(spark, "SELECT k FROM {t} WHERE n > :low", {"low": 2}, t=df)) == [("b",)]


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_fan_out_of_hot_keys(spark, rows, threshold):
    """Hot keys on either side, NULL keys, keys without a match, copies."""
    left = [("hot", 1), ("hot", 2), (None, 3), (None, 4), ("none", 5), ("none", 6), ("b", 7), ("b", 7)]
    right = [("hot", i) for i in range(300)] + [("b", 1), ("b", 1), (None, 2), ("c", 3)]
    want = sorted([(k, x, v) for k, x in left for q, v in right if k == q] + [(k, x, None) for k, x in left if k not in ("hot", "b")], key=str)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        out = joins.fan_out(spark.createDataFrame(left, "k string, x int"), spark.createDataFrame(right, "k string, v int"), "k", ["v"])
        assert sorted((tuple(r) for r in out.collect()), key=str) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_fan_out_reads_each_side_once(spark):
    t = {n: spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet") for n in ("customer", "orders")}
    out = joins.fan_out(t["customer"].select("c_custkey", "c_name"), t["orders"], {"c_custkey": "o_custkey"}, ["o_orderkey", "o_orderdate"])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 2


def test_routed_in_one_pass(spark, tmp_path):
    rules = [
        quality.Rule("positive", "Must be positive", "v", "> 0", F.col("v") <= 0),
        quality.Rule("even", "Must be even", "v", "even", F.col("v") % 2 != 0),
    ]
    df = spark.createDataFrame([(i, i - 3, "s") for i in range(10)], "id int, v int, _source_system string")
    done = quality.routed(df, rules, str(tmp_path / "routed"), F.lit("2026-01-05").cast("timestamp"), "id")
    assert done.totals == {"ingested": 10, "passed": 3, "quarantined": 7, "failures": 9}
    assert sorted(r.v for r in done.passed.collect()) == [2, 4, 6]
    assert done.quarantined.columns == df.columns and done.quarantined.count() == 7
    assert done.log.count() == 9


def test_drilldown_levels_count_entities_once(spark):
    members = [("s1", "D", "A", 1, "x"), ("s1", "D", "A", 1, "y"), ("s2", "D", "B", 1, "x"), ("s3", None, "B", 2, None), ("s4", "D", "A", 1, "x")]
    facts = [("s1", 10.0), ("s1", 20.0), ("s2", 40.0), ("s3", 50.0), ("s9", 1.0)]
    names = "student_id string, district_name string, school_id string, grade_level int, section_id string"
    out = analytics.drilldown_levels(spark.createDataFrame(facts, "student_id string, max_score_to_date double"), spark.createDataFrame(members, names))
    got = {(r.level, r.district_name, r.school_id, r.grade_level, r.section_id, r.student_id): (r.students, r.avg_score) for r in out.collect()}
    assert got["district", "D", None, None, None, None] == (2, 20.0)
    assert got["district", None, None, None, None, None] == (1, 50.0)
    assert got["school", "D", "A", None, None, None] == (1, 15.0)
    assert got["section", None, "B", 2, None, None] == (1, 50.0)
    assert got["student", None, None, None, None, "s1"] == (1, 15.0)
    assert len(got) == 2 + 3 + 3 + 4 + 3


def test_drilldown_levels_of_pairs(spark):
    """Places and sections of a student given apart make the same levels as their pairs, which are never joined."""
    draw = random.Random(5)
    facts = [(f"s{k}", v) for k in range(12) for v in draw.sample([None, 10.0, 20.0, 35.0, 50.0], 3)]
    places = [(draw.choice([None, *(f"s{k}" for k in range(14))]), draw.choice([None, "D", "E"]), draw.choice([None, "A", "B"]), draw.choice([None, 1, 2])) for _ in range(90)]
    sections = [(draw.choice([None, *(f"s{k}" for k in range(1, 15))]), draw.choice([None, "x", "y", "z"])) for _ in range(60)]
    members = [(s, d, a, g, x) for s, d, a, g in places for t, x in sections if s == t]
    outer, kind = "student_id string, district_name string, school_id string, grade_level int", "student_id string, max_score_to_date double"
    values = spark.createDataFrame(facts, kind)
    inner = spark.createDataFrame(sections, "student_id string, section_id string")
    want = analytics.drilldown_levels(values, spark.createDataFrame(members, f"{outer}, section_id string"))
    got = analytics.drilldown_levels(values, spark.createDataFrame(places, outer), inner=inner)
    assert got.columns == want.columns
    flat = lambda df: sorted(([*map(str, r[:7]), r[7] and round(r[7], 9)] for r in df.collect()), key=str)
    assert flat(got) == flat(want) and len(flat(got)) > 100
    plan = got._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
    assert "__place" in plan and plan.count("hashpartitioning(__slice") <= 1  # the pairs are counted where they are made


def test_checks_are_settled_some_at_a_time(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    shuffles = lambda: {f.name for folder in folders for f in Path(folder).rglob("shuffle_*.data")}
    df = spark.range(1000).selectExpr("id % 400 AS a", "if(id % 3 = 0, NULL, id) AS b")
    checks = [quality.not_null(df, "t", ["a", "b"]), *(quality.unique(df, "t", c) for c in "abab"), quality.accepted_values(df, "t", "a", [1, 2])]
    before = shuffles()
    parts = quality.settled(checks, at_once=4)
    assert not shuffles() - before and len(parts) == 2
    assert sorted(quality.report(parts).collect()) == sorted(quality.report(checks).collect())


def test_checked_projections_are_not_written(spark, monkeypatch):
    written = []
    monkeypatch.setattr(reports, "materialized", lambda df, name: written.append(df) or df)
    found = reports._checked_tables(Model(spark, "/root/testdata/sf0.001"))
    assert set(found) == set(reports._CHECKED) and len(written) == len(reports._WRITTEN)
