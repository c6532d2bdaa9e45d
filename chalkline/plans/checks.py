"""Gates and declared checks on the K-12 tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chalkline.functions import exprs as x
from chalkline.operators import joins, mastery, pii, quality
from chalkline.sources.specs import CSV_SOURCE, XML_SOURCE

Frames = dict[str, DataFrame]
SRC = "_source_system"


# --- gates: violating rows, empty means the gate passes ----------------------


def valid_school_id(enrollments: DataFrame, school_dim: DataFrame) -> DataFrame:
    rows = enrollments.select("student_id", "school_id", SRC)
    return joins.orphans(rows, school_dim, "school_id")


def grade_level_course_match(enrollments: DataFrame, school_dim: DataFrame) -> DataFrame:
    rows = enrollments.select("student_id", "grade_level", "school_id", SRC)
    found = joins.below_band(rows, school_dim, "school_id", "grade_level", "grade_band_low", ["school_name", "grade_band_high"])
    return found.select("student_id", "grade_level", "school_name", "grade_band_low", "grade_band_high", SRC)


def enrollment_date_not_future(enrollments: DataFrame, as_of: Column) -> DataFrame:
    rows = enrollments.select("student_id", "enrollment_start_date", SRC)
    return rows.filter(F.col("enrollment_start_date").try_cast("date") > as_of.cast("date"))


def section_exists_for_enrollment(enrollments: DataFrame, sections: DataFrame) -> DataFrame:
    """Schools with enrolments but no section; enrolments shrink to distinct schools first."""
    seen = enrollments.select("school_id", SRC).distinct()
    return joins.orphans(seen, sections, "school_id", null_is_orphan=False)


def student_id_not_null(students: DataFrame) -> DataFrame:
    return students.filter(F.col("student_id").isNull()).groupBy(SRC).agg(F.count(F.lit(1)).alias("null_count"))


def pii_masked(table: DataFrame) -> DataFrame:
    return pii.forbidden_columns(table)


def attendance_rate_bounds(attendance_fact: DataFrame) -> DataFrame:
    rates = mastery.attendance_rate(attendance_fact, "student_id").withColumnRenamed("attendance_rate", "rate")
    return rates.filter(~F.col("rate").between(0.0, 1.0))


def max_value_mastery(mastery_fact: DataFrame, **options) -> DataFrame:
    keys = ["student_id", "standard_code"]
    rows = mastery_fact.select(*keys, "date_key", "max_score_to_date", "assessment_count")
    return mastery.falling_best(rows, keys, ["date_key", "assessment_count"], **options).drop("assessment_count")


def no_duplicate_students(students: DataFrame) -> DataFrame:
    return quality.duplicates(students, ["student_id", SRC], required=["student_id"])


def answer_exists_for_scored_assessment(responses: DataFrame) -> DataFrame:
    unanswered = F.col("correct_answer").isNull() | F.col("student_answer").isNull()
    return responses.filter(F.col("score").isNotNull() & unanswered).select(
        "student_id", "assessment_id", "question_number", "score", SRC
    )


def dangling_sections(memberships: DataFrame, sections: DataFrame) -> DataFrame:
    return joins.orphans(memberships, sections, "section_id", null_is_orphan=False)


def gates(tables: Frames, as_of: Column) -> Frames:
    """All ten gates on a full set of tables."""
    return {
        "valid_school_id": valid_school_id(tables["int_enrollments"], tables["dim_school"]),
        "grade_level_course_match": grade_level_course_match(tables["int_enrollments"], tables["dim_school"]),
        "enrollment_date_not_future": enrollment_date_not_future(tables["int_enrollments"], as_of),
        "section_exists_for_enrollment": section_exists_for_enrollment(tables["int_enrollments"], tables["int_sections"]),
        "student_id_not_null": student_id_not_null(tables["int_students"]),
        "pii_masked_in_gold": pii_masked(tables["dim_student"]),
        "attendance_rate_bounds": attendance_rate_bounds(tables["fact_attendance_daily"]),
        "max_value_mastery": max_value_mastery(tables["fact_student_mastery_daily"]),
        "no_duplicate_students": no_duplicate_students(tables["int_students"]),
        "answer_exists_for_scored_assessment": answer_exists_for_scored_assessment(tables["fact_assessment_responses"]),
    }


# --- declared checks --------------------------------------------------------

# Fixed values: (table, column, severity) of columns that must not be NULL.
NOT_NULL = (
    (f"{XML_SOURCE}.students", "student_id", quality.ERROR),
    (f"{XML_SOURCE}.students", "_source_system", quality.ERROR),
    (f"{XML_SOURCE}.students", "_loaded_at", quality.ERROR),
    (f"{XML_SOURCE}.schools", "school_id", quality.ERROR),
    (f"{XML_SOURCE}.schools", "school_name", quality.ERROR),
    (f"{XML_SOURCE}.schools", "_source_system", quality.ERROR),
    (f"{XML_SOURCE}.schools", "_loaded_at", quality.ERROR),
    (f"{XML_SOURCE}.enrollments", "student_id", quality.ERROR),
    (f"{XML_SOURCE}.enrollments", "school_id", quality.ERROR),
    (f"{XML_SOURCE}.enrollments", "_source_system", quality.ERROR),
    (f"{XML_SOURCE}.enrollments", "_loaded_at", quality.ERROR),
    (f"{XML_SOURCE}.sections", "section_id", quality.ERROR),
    (f"{XML_SOURCE}.sections", "school_id", quality.ERROR),
    (f"{XML_SOURCE}.sections", "course_name", quality.ERROR),
    (f"{XML_SOURCE}.sections", "_source_system", quality.ERROR),
    (f"{XML_SOURCE}.sections", "_loaded_at", quality.ERROR),
    (f"{XML_SOURCE}.section_associations", "student_id", quality.ERROR),
    (f"{XML_SOURCE}.section_associations", "section_id", quality.ERROR),
    (f"{XML_SOURCE}.section_associations", "_source_system", quality.ERROR),
    (f"{XML_SOURCE}.section_associations", "_loaded_at", quality.ERROR),
    (f"{XML_SOURCE}.staff", "staff_id", quality.ERROR),
    (f"{XML_SOURCE}.staff", "_source_system", quality.ERROR),
    (f"{XML_SOURCE}.staff", "_loaded_at", quality.ERROR),
    (f"{XML_SOURCE}.grades", "student_id", quality.ERROR),
    (f"{XML_SOURCE}.grades", "section_id", quality.ERROR),
    (f"{XML_SOURCE}.grades", "_source_system", quality.ERROR),
    (f"{XML_SOURCE}.grades", "_loaded_at", quality.ERROR),
    (f"{XML_SOURCE}.assessment_results", "student_id", quality.ERROR),
    (f"{XML_SOURCE}.assessment_results", "assessment_id", quality.ERROR),
    (f"{XML_SOURCE}.assessment_results", "_source_system", quality.ERROR),
    (f"{XML_SOURCE}.assessment_results", "_loaded_at", quality.ERROR),
    (f"{XML_SOURCE}.attendance", "student_id", quality.ERROR),
    (f"{XML_SOURCE}.attendance", "school_id", quality.ERROR),
    (f"{XML_SOURCE}.attendance", "event_date", quality.ERROR),
    (f"{XML_SOURCE}.attendance", "_source_system", quality.ERROR),
    (f"{XML_SOURCE}.attendance", "_loaded_at", quality.ERROR),
    (f"{XML_SOURCE}.standards", "standard_code", quality.ERROR),
    (f"{XML_SOURCE}.standards", "_source_system", quality.ERROR),
    (f"{XML_SOURCE}.standards", "_loaded_at", quality.ERROR),
    (f"{CSV_SOURCE}.users", "sourced_id", quality.ERROR),
    (f"{CSV_SOURCE}.users", "role", quality.ERROR),
    (f"{CSV_SOURCE}.users", "_source_system", quality.ERROR),
    (f"{CSV_SOURCE}.users", "_loaded_at", quality.ERROR),
    (f"{CSV_SOURCE}.orgs", "org_id", quality.ERROR),
    (f"{CSV_SOURCE}.orgs", "org_name", quality.ERROR),
    (f"{CSV_SOURCE}.orgs", "org_type", quality.ERROR),
    (f"{CSV_SOURCE}.orgs", "_source_system", quality.ERROR),
    (f"{CSV_SOURCE}.orgs", "_loaded_at", quality.ERROR),
    (f"{CSV_SOURCE}.enrollments", "sourced_id", quality.ERROR),
    (f"{CSV_SOURCE}.enrollments", "class_sourced_id", quality.ERROR),
    (f"{CSV_SOURCE}.enrollments", "user_sourced_id", quality.ERROR),
    (f"{CSV_SOURCE}.enrollments", "role", quality.ERROR),
    (f"{CSV_SOURCE}.enrollments", "_source_system", quality.ERROR),
    (f"{CSV_SOURCE}.enrollments", "_loaded_at", quality.ERROR),
    (f"{CSV_SOURCE}.classes", "sourced_id", quality.ERROR),
    (f"{CSV_SOURCE}.classes", "title", quality.ERROR),
    (f"{CSV_SOURCE}.classes", "school_sourced_id", quality.ERROR),
    (f"{CSV_SOURCE}.classes", "_source_system", quality.ERROR),
    (f"{CSV_SOURCE}.classes", "_loaded_at", quality.ERROR),
    (f"{CSV_SOURCE}.courses", "sourced_id", quality.ERROR),
    (f"{CSV_SOURCE}.courses", "title", quality.ERROR),
    (f"{CSV_SOURCE}.courses", "_source_system", quality.ERROR),
    (f"{CSV_SOURCE}.courses", "_loaded_at", quality.ERROR),
    (f"{CSV_SOURCE}.results", "sourced_id", quality.ERROR),
    (f"{CSV_SOURCE}.results", "line_item_sourced_id", quality.ERROR),
    (f"{CSV_SOURCE}.results", "student_sourced_id", quality.ERROR),
    (f"{CSV_SOURCE}.results", "_source_system", quality.ERROR),
    (f"{CSV_SOURCE}.results", "_loaded_at", quality.ERROR),
    (f"{CSV_SOURCE}.line_items", "sourced_id", quality.ERROR),
    (f"{CSV_SOURCE}.line_items", "title", quality.ERROR),
    (f"{CSV_SOURCE}.line_items", "class_sourced_id", quality.ERROR),
    (f"{CSV_SOURCE}.line_items", "_source_system", quality.ERROR),
    (f"{CSV_SOURCE}.line_items", "_loaded_at", quality.ERROR),
    (f"{CSV_SOURCE}.academic_sessions", "sourced_id", quality.ERROR),
    (f"{CSV_SOURCE}.academic_sessions", "title", quality.ERROR),
    (f"{CSV_SOURCE}.academic_sessions", "type", quality.ERROR),
    (f"{CSV_SOURCE}.academic_sessions", "_source_system", quality.ERROR),
    (f"{CSV_SOURCE}.academic_sessions", "_loaded_at", quality.ERROR),
    (f"{CSV_SOURCE}.demographics", "sourced_id", quality.ERROR),
    (f"{CSV_SOURCE}.demographics", "_source_system", quality.ERROR),
    (f"{CSV_SOURCE}.demographics", "_loaded_at", quality.ERROR),
    ("int_students", "student_id", quality.WARN),
    ("int_students", "_source_system", quality.ERROR),
    ("int_schools", "school_id", quality.ERROR),
    ("int_schools", "school_name", quality.ERROR),
    ("int_schools", "_source_system", quality.ERROR),
    ("int_enrollments", "student_id", quality.WARN),
    ("int_enrollments", "school_id", quality.ERROR),
    ("int_enrollments", "_source_system", quality.ERROR),
    ("int_sections", "section_id", quality.ERROR),
    ("int_sections", "school_id", quality.ERROR),
    ("int_sections", "_source_system", quality.ERROR),
    ("int_staff", "staff_id", quality.ERROR),
    ("int_staff", "_source_system", quality.ERROR),
    ("int_grades", "student_id", quality.WARN),
    ("int_grades", "section_id", quality.ERROR),
    ("int_grades", "grading_period", quality.ERROR),
    ("int_grades", "_source_system", quality.ERROR),
    ("int_assessments", "student_id", quality.ERROR),
    ("int_assessments", "assessment_id", quality.ERROR),
    ("int_assessments", "_source_system", quality.ERROR),
    ("int_attendance", "student_id", quality.ERROR),
    ("int_attendance", "school_id", quality.ERROR),
    ("int_attendance", "event_date", quality.ERROR),
    ("int_attendance", "attendance_status", quality.ERROR),
    ("int_attendance", "_source_system", quality.ERROR),
    ("int_standards", "standard_code", quality.ERROR),
    ("dim_student", "student_id", quality.WARN),
    ("dim_student", "_source_system", quality.ERROR),
    ("dim_school", "school_id", quality.ERROR),
    ("dim_school", "school_name", quality.ERROR),
    ("dim_school", "_source_system", quality.ERROR),
    ("dim_standard", "standard_code", quality.ERROR),
    ("dim_standard", "standard_description", quality.ERROR),
    ("dim_section", "section_id", quality.ERROR),
    ("dim_section", "school_id", quality.ERROR),
    ("dim_section", "_source_system", quality.ERROR),
    ("dim_misconception_pattern", "misconception_id", quality.ERROR),
    ("dim_misconception_pattern", "standard_code", quality.ERROR),
    ("dim_misconception_pattern", "pattern_label", quality.ERROR),
    ("fact_student_mastery_daily", "student_id", quality.ERROR),
    ("fact_student_mastery_daily", "standard_code", quality.ERROR),
    ("fact_student_mastery_daily", "date_key", quality.WARN),
    ("fact_student_mastery_daily", "_source_system", quality.ERROR),
    ("fact_student_mastery_daily", "max_score_to_date", quality.ERROR),
    ("fact_student_mastery_daily", "mastery_level", quality.ERROR),
    ("fact_assessment_responses", "student_id", quality.ERROR),
    ("fact_assessment_responses", "assessment_id", quality.ERROR),
    ("fact_assessment_responses", "question_number", quality.ERROR),
    ("fact_assessment_responses", "standard_code", quality.ERROR),
    ("fact_assessment_responses", "assessment_date", quality.WARN),
    ("fact_assessment_responses", "is_correct", quality.ERROR),
    ("fact_assessment_responses", "_source_system", quality.ERROR),
    ("fact_attendance_daily", "student_id", quality.ERROR),
    ("fact_attendance_daily", "school_id", quality.ERROR),
    ("fact_attendance_daily", "event_date", quality.ERROR),
    ("fact_attendance_daily", "status", quality.ERROR),
    ("fact_attendance_daily", "_source_system", quality.ERROR),
    ("fact_dq_quarantine_log", "source_system", quality.ERROR),
    ("fact_dq_quarantine_log", "entity_type", quality.ERROR),
    ("fact_dq_quarantine_log", "record_id", quality.ERROR),
    ("fact_dq_quarantine_log", "rule_name", quality.ERROR),
    ("fact_dq_quarantine_log", "quarantined_at", quality.ERROR),
    ("agg_early_warning", "student_id", quality.ERROR),
    ("agg_early_warning", "risk_level", quality.ERROR),
    ("agg_district_comparison", "standard_code", quality.ERROR),
    ("agg_district_comparison", "student_count", quality.ERROR),
)

# Columns whose values must not repeat.
UNIQUE = {
    f"{XML_SOURCE}.students": "student_id",
    f"{XML_SOURCE}.schools": "school_id",
    f"{XML_SOURCE}.sections": "section_id",
    f"{XML_SOURCE}.staff": "staff_id",
    f"{XML_SOURCE}.standards": "standard_code",
    f"{CSV_SOURCE}.users": "sourced_id",
    f"{CSV_SOURCE}.orgs": "org_id",
    f"{CSV_SOURCE}.enrollments": "sourced_id",
    f"{CSV_SOURCE}.classes": "sourced_id",
    f"{CSV_SOURCE}.courses": "sourced_id",
    f"{CSV_SOURCE}.results": "sourced_id",
    f"{CSV_SOURCE}.line_items": "sourced_id",
    f"{CSV_SOURCE}.academic_sessions": "sourced_id",
    f"{CSV_SOURCE}.demographics": "sourced_id",
    "int_schools": "school_id",
    "int_standards": "standard_code",
    "dim_school": "school_id",
    "dim_standard": "standard_code",
    "dim_section": "section_id",
    "dim_misconception_pattern": "misconception_id",
    "agg_early_warning": "student_id",
}

# Fixed values: (table, column, parent table, parent column, severity).
RELATIONSHIPS = (
    ("int_enrollments", "student_id", "int_students", "student_id", quality.ERROR),
    ("int_enrollments", "school_id", "int_schools", "school_id", quality.WARN),
    ("int_sections", "school_id", "int_schools", "school_id", quality.ERROR),
    ("int_grades", "student_id", "int_students", "student_id", quality.ERROR),
    ("int_grades", "section_id", "int_sections", "section_id", quality.ERROR),
    ("int_assessments", "student_id", "int_students", "student_id", quality.ERROR),
    ("int_attendance", "student_id", "int_students", "student_id", quality.ERROR),
    ("int_attendance", "school_id", "int_schools", "school_id", quality.ERROR),
    ("dim_student", "school_id", "dim_school", "school_id", quality.WARN),
    ("dim_section", "school_id", "dim_school", "school_id", quality.ERROR),
    ("dim_misconception_pattern", "standard_code", "dim_standard", "standard_code", quality.ERROR),
    ("fact_student_mastery_daily", "student_id", "dim_student", "student_id", quality.ERROR),
    ("fact_student_mastery_daily", "standard_code", "dim_standard", "standard_code", quality.ERROR),
    ("agg_early_warning", "student_id", "dim_student", "student_id", quality.ERROR),
)

# Columns with a closed value list.
ACCEPTED = {
    ("fact_student_mastery_daily", "mastery_level"): x.MASTERY_LEVELS,
    ("agg_early_warning", "risk_level"): x.RISK_LEVELS,
}


def declared_checks(tables: Frames) -> list[DataFrame]:
    """Report rows of every declared check whose tables are at hand."""
    rows = []
    for table in dict.fromkeys(t for t, _, _ in NOT_NULL):
        if table in tables:  # all columns of a table in one pass
            names = [c for t, c, _ in NOT_NULL if t == table]
            warn = [c for t, c, severity in NOT_NULL if t == table and severity == quality.WARN]
            rows.append(quality.not_null(tables[table], table, names, warn))
    rows += [quality.unique(tables[t], t, c) for t, c in UNIQUE.items() if t in tables]
    rows += [
        quality.relationships(tables[t], t, fk, tables[parent], pk, severity)
        for t, fk, parent, pk, severity in RELATIONSHIPS
        if t in tables and parent in tables
    ]
    rows += [quality.accepted_values(tables[t], t, c, values) for (t, c), values in ACCEPTED.items() if t in tables]
    return rows


def check_report(tables: Frames, as_of: Column) -> DataFrame:
    """All declared checks and gates with their outcome."""
    gate_rows = [quality.counted(rows, name, "gate") for name, rows in gates(tables, as_of).items()]
    return quality.report([*declared_checks(tables), *gate_rows])
