"""Files to published tables on the hand-written data set."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

import k12_files
from chalkline import session
from chalkline.operators import analytics, quality
from chalkline.operators.analytics import row_counts
from chalkline.plans import checks, k12, pipeline
from chalkline.plans.staging import stage
from chalkline.sources import readers

LOADED = "2026-01-05T06:00:00"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def out(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    xml, csv, seeds = k12_files.write(root)
    tables = pipeline.run(
        spark,
        xml,
        csv,
        seeds,
        str(root / "out"),
        as_of=F.lit("2026-06-30").cast("date"),
        run_ts=F.lit("2026-01-05 06:30:00").cast("timestamp"),
        loaded_at=LOADED,
    )
    return tables, str(root / "out")


def test_no_raw_student_data_is_ever_written(spark, out):
    for path, gone in (("edfi/students", ["first_name", "birth_date"]), ("oneroster/users", ["given_name", "email"])):
        assert not set(gone) & set(spark.read.parquet(f"{out[1]}/{path}").columns)


def test_students(out, rows):
    got = rows(out[0]["int_students"])
    assert got == [
        ("S1", sha("Ann"), sha("Lee"), sha("ann@example.com"), 2015, "edfi"),
        ("S3", sha("Cy & Co"), sha("Wu"), sha("cy@example.com"), 2014, "edfi"),
        ("u1", sha("Eve"), sha("Ray"), sha("eve@example.org"), 2013, "oneroster"),
        (None, sha("Bob"), sha(""), None, None, "edfi"),
    ]


def test_staff_hashes_differ_by_source(out, rows):
    assert rows(out[0]["int_staff"]) == [
        ("T1", sha("dee"), sha("fox"), sha("dee@example.com"), "edfi"),
        ("u2", sha("Flo"), sha("Day"), None, "oneroster"),
    ]


def test_schools(out, rows):
    assert rows(out[0]["dim_school"]) == [
        ("SCH-1", "First", "Elementary", "D1", "North", 2, 5, "edfi"),
        ("SCH-2", "Second", "Elementary", "D1", "North", 0, 5, "edfi"),
        ("o1", "Hill School", "High", "od1", "South", None, None, "oneroster"),
    ]


def test_sections(out, rows):
    assert rows(out[0]["dim_section"]) == [
        ("SEC-1", "SCH-1", "Kindergarten Math", "A", None, "Math", 0, "edfi"),
        ("SEC-2", "SCH-1", "ELA 3", None, None, "ELA", 3, "edfi"),
        ("c1", "o1", "Math 3", "B", None, "Math", 3, "oneroster"),
        ("c2", "o1", None, "", None, "Unknown", None, "oneroster"),
    ]


def test_enrollments(out, rows):
    assert rows(out[0]["int_enrollments"]) == [
        ("S1", "SCH-1", "2025-08-15", 1, "edfi"),
        ("S3", "INVALID-SCH-999", "2027-09-01", None, "edfi"),
        ("u1", "o1", "2025-08-20", 3, "oneroster"),
        ("u1", "o1", "2025-08-20", None, "oneroster"),
        (None, "SCH-2", "2025-08-15", 0, "edfi"),
    ]


def test_student_dimension_fans_out(out, rows):
    assert rows(out[0]["dim_student"], "student_id", "birth_year", "school_id", "grade_level") == [
        ("S1", 2015, "SCH-1", 1),
        ("S3", 2014, "INVALID-SCH-999", None),
        ("u1", 2013, "o1", 3),
        ("u1", 2013, "o1", None),
        (None, None, None, None),
    ]


def test_mastery_fact(out, rows):
    got = rows(out[0]["fact_student_mastery_daily"])
    assert got == [
        ("S1", "STD-1", None, 40.0, "edfi", 72.5, 2, "Meeting"),
        ("S1", "STD-1", None, 72.5, "edfi", 72.5, 1, "Meeting"),
        ("S1", "STD-2", None, 72.5, "edfi", 72.5, 1, "Meeting"),
        ("S3", "STD-1", None, 49.9, "edfi", 49.9, 1, "Needs Intervention"),
        ("S3", "STD-2", None, 20.0, "edfi", 20.0, 1, "Needs Intervention"),
        ("u1", "STD-1", "2025-09-02", 60.0, "oneroster", 60.0, 1, "Developing"),
        ("u1", "STD-1", "2025-09-09", 55.0, "oneroster", 60.0, 2, "Developing"),
        ("u1", "STD-2", "2025-09-05", 91.0, "oneroster", 91.0, 1, "Exceeding"),
    ]


def test_responses(out, rows):
    got = rows(
        out[0]["fact_assessment_responses"], "assessment_id", "question_number", "standard_code", "is_correct",
        "misconception_tag", "suggested_reteach", "score",
    )
    assert got == [
        ("A1", "1", "STD-1", True, None, None, 72.5),
        ("A1", "2", "STD-2", False, "swap", "Lesson 2", 72.5),
        ("A2", "1", "STD-1", False, "swap", "Lesson 1", 40.0),
        ("A4", "1", "STD-1", None, None, None, None),
        ("A5", "1", "STD-1", True, None, None, 49.9),
        ("A7", "1", "STD-2", False, None, None, 20.0),
        ("l1", "1", "STD-1", False, "swap", "Lesson 1", 60.0),
        ("l1", "1", "STD-1", True, None, None, 55.0),
        ("l1", "1", "STD-2", True, None, None, 91.0),
    ]


def test_early_warning(out, rows):
    """S3: two standards below 50 and half the days present; u1 has no attendance and a falling second half."""
    assert rows(out[0]["agg_early_warning"]) == [
        ("S1", 72.5, 0.9, 0, 2, False, "Low"),
        ("S3", 34.95, 0.5, 2, 2, True, "Medium"),
        ("u1", 75.5, 1.0, 0, 2, False, "Low"),
    ]


def test_district_comparison_weights_enrolments(out, rows):
    """u1 has two enrolments in the district; S3's school is unknown."""
    assert rows(out[0]["agg_district_comparison"]) == [
        ("STD-1", "Math", "D1", "North", 1, 72.5, 1.0),
        ("STD-1", "Math", "od1", "South", 1, 60.0, 0.0),
        ("STD-2", "Math", "D1", "North", 1, 72.5, 1.0),
        ("STD-2", "Math", "od1", "South", 1, 91.0, 1.0),
    ]


def test_quarantine_log(out, rows):
    log = out[0]["fact_dq_quarantine_log"]
    assert log.columns == list(quality.LOG_COLUMNS)
    assert rows(log, "source_system", "entity_type", "record_id", "rule_name", "field_value") == [
        ("edfi", "enrollment", "S3", "enrollment_date_not_future", "2027-09-01"),
        ("edfi", "enrollment", "S3", "valid_school_id", "INVALID-SCH-999"),
        ("edfi", "student", "UNKNOWN", "student_id_not_null", "NULL"),
    ]


def test_broken_elements_are_logged_without_their_text(spark, out, rows):
    log = spark.read.parquet(f"{out[1]}/malformed")
    assert rows(log, "source_system", "entity_type", "record_id", "rule_name") == [
        ("edfi", "assessment_results", "UNKNOWN", "malformed_xml")
    ]
    assert "A6" not in log.first().field_value


def test_gates(out, rows):
    as_of = F.lit("2026-06-30").cast("date")
    found = {name: rows(df) for name, df in checks.gates(out[0], as_of).items()}
    assert found["valid_school_id"] == [("S3", "INVALID-SCH-999", "edfi")]
    assert found["grade_level_course_match"] == [("S1", 1, "First", 2, 5, "edfi")]
    assert found["enrollment_date_not_future"] == [("S3", "2027-09-01", "edfi")]
    assert found["section_exists_for_enrollment"] == [("INVALID-SCH-999", "edfi"), ("SCH-2", "edfi")]
    assert found["student_id_not_null"] == [("edfi", 1)]
    assert found["answer_exists_for_scored_assessment"] == []
    for name in ("pii_masked_in_gold", "attendance_rate_bounds", "max_value_mastery", "no_duplicate_students"):
        assert found[name] == []


def test_check_report(out):
    report = checks.check_report(out[0], F.lit("2026-06-30").cast("date")).collect()
    assert len(report) == 147 + 21 + 14 + 2 + 10
    status = {(r.check, r.table, r.column): (r.status, r.violations) for r in report}
    assert status["not_null", "int_students", "student_id"] == ("warn", 1)
    assert status["not_null", "edfi.students", "student_id"] == ("fail", 1)
    assert status["relationships", "int_enrollments", "school_id"] == ("warn", 1)
    assert status["relationships", "dim_section", "school_id"] == ("pass", 0)
    assert status["accepted_values", "agg_early_warning", "risk_level"] == ("pass", 0)
    assert status["valid_school_id", "gate", ""] == ("fail", 1)


def test_section_rules_and_grade_rule(spark, out, tmp_path, rows):
    tables = out[0]
    xml = {k.split(".")[1]: v for k, v in tables.items() if k.startswith("edfi.")}
    csv = {k.split(".")[1]: v for k, v in tables.items() if k.startswith("oneroster.")}
    run_ts = F.lit("2026-01-05 06:30:00")
    memberships = k12.section_memberships(xml, csv)
    assert rows(checks.dangling_sections(memberships, tables["int_sections"])) == [("S3", "DANGLING-SEC-999", "edfi")]
    log = quality.violations(memberships, k12.section_rules(tables["dim_section"]), run_ts, "student_id")
    assert rows(log, "record_id", "field_value") == [("S3", "DANGLING-SEC-999")]
    grade = k12.grade_course_violations(
        k12.section_enrollments(xml, csv), tables["dim_section"], tables["dim_school"], run_ts
    )
    assert rows(grade, "record_id", "field_value") == [("u1", "3 in Math 3")]


def test_wide_student(out, rows):
    tables = out[0]
    wide = k12.wide_student(
        tables["int_students"], tables["int_enrollments"], tables["dim_school"], F.lit("2026-06-30").cast("date")
    )
    assert rows(wide.select("student_id", "district_id", F.col("enrollment_start_date").cast("string"), "is_active")) == [
        ("S1", "D1", "2025-08-15", True),
        ("S3", None, "2027-09-01", False),
        ("u1", "od1", "2025-08-20", True),
        ("u1", "od1", "2025-08-20", True),
        (None, None, None, False),
    ]


def test_mastery_with_school(out, rows):
    got = k12.mastery_with_school(out[0]["fact_student_mastery_daily"], out[0]["int_enrollments"])
    assert rows(got, "student_id", "school_id", "standard_code", "assessment_count")[-3:] == [
        ("u1", "o1", "STD-1", 1),
        ("u1", "o1", "STD-1", 2),
        ("u1", "o1", "STD-2", 1),
    ]


def test_overview(out):
    t = out[0]
    row = analytics.overview(
        t["dim_student"], t["dim_school"], t["dim_standard"], t["fact_dq_quarantine_log"], t["agg_early_warning"]
    ).first()
    assert (row.students, row.schools, row.standards, row.quarantined, row.at_risk) == (5, 3, 2, 3, 1)
    assert (row.pass_rate, row.at_risk_pct) == (62.5, 20.0)


def test_one_source_can_be_skipped(spark, tmp_path):
    xml, csv, _ = k12_files.write(tmp_path)
    out = pipeline.bronze_to_silver(spark, None, csv, str(tmp_path / "o1"))
    assert list(out) == ["oneroster"]
    out = pipeline.bronze_to_silver(spark, xml, None, str(tmp_path / "o2"), register=True)
    assert list(out) == ["edfi"]
    assert spark.table("silver_edfi.students").count() == 3
    spark.sql("DROP DATABASE silver_edfi CASCADE")


def test_published_tables_in_a_database(spark, tmp_path):
    xml, csv, seeds = k12_files.write(tmp_path)
    pipeline.run(
        spark, xml, csv, seeds, str(tmp_path / "out"), F.lit("2026-06-30").cast("date"), F.lit("2026-01-05 06:30:00"),
        database="gold_test",
    )
    names = {r.tableName for r in spark.sql("SHOW TABLES IN gold_test").collect()}
    assert len(names) == 11 and "agg_early_warning" in names
    facts, students = spark.table("gold_test.fact_student_mastery_daily"), spark.table("gold_test.dim_student")
    attended = spark.table("gold_test.fact_attendance_daily")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = facts.join(students, "student_id").join(attended.groupBy("student_id").count(), "student_id", "left")
        assert joined.count() > 0
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
    counted = row_counts({n: spark.table(f"gold_test.{n}") for n in sorted(names)})
    read = re.findall(r"ReadSchema: (\S+)", counted._jdf.queryExecution().executedPlan().toString())
    assert len(read) == 11 and set(read) == {"struct<>"}
    spark.sql("DROP DATABASE gold_test CASCADE")


def test_input_may_go_when_silver_is_written(spark, tmp_path):
    xml, csv, seeds = k12_files.write(tmp_path)

    def gone():
        assert (tmp_path / "out" / "malformed").exists() and not (tmp_path / "out" / "gold").exists()
        for source in (xml, csv):
            session.remove(spark, source)

    day, now = F.lit("2026-06-30").cast("date"), F.lit("2026-01-05 06:30:00").cast("timestamp")
    tables = pipeline.run(spark, xml, csv, seeds, str(tmp_path / "out"), day, now, LOADED, silver_written=gone)
    assert all(tables[name].count() for name in pipeline.GOLD)


def test_staging_renames(spark, tmp_path):
    xml, csv, _ = k12_files.write(tmp_path)
    staged = stage("edfi", readers.read_all_xml(spark, xml) | {"students": pipeline.xml_silver(spark, xml)["students"]})
    assert staged["enrollments"].columns[:4] == ["student_id", "school_id", "enrollment_start_date", "grade_level_raw"]
    assert staged["staff"].columns[0] == "staff_id"
    assert "first_name" not in staged["students"].columns
    orgs = stage("oneroster", {"orgs": readers.read_csv(spark, csv, "orgs")})["orgs"]
    assert orgs.columns[:3] == ["org_id", "org_name", "org_type"]


def test_command_line(spark, tmp_path, capsys):
    xml, csv, seeds = k12_files.write(tmp_path)
    pipeline.main(["--xml", xml, "--csv", csv, "--seeds", seeds, "--out", str(tmp_path / "out"), "--as-of", "2026-06-30"])
    shown = capsys.readouterr().out
    assert all(name in shown for name in pipeline.GOLD)
    assert spark.read.parquet(str(tmp_path / "out" / "gold" / "fact_dq_quarantine_log")).count() == 3
    pipeline.main(["--csv", csv, "--out", str(tmp_path / "silver_only")])
    assert "oneroster.users" in capsys.readouterr().out
