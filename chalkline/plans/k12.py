"""Unified and published K-12 tables.

Inputs are staging frames by entity name (``xml`` and ``csv``) and the seeds;
every function returns a lazy frame.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chalkline.functions import exprs as x
from chalkline.operators import joins, mastery, quality, responses
from chalkline.operators.ordered import HOT_ROWS
from chalkline.operators.unify import Source, project, unify

Frames = dict[str, DataFrame]
SRC = "_source_system"


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


# --- unified tables ---------------------------------------------------------


def students(xml: Frames, csv: Frames) -> DataFrame:
    hashes = {"first_name_hash": "given_name_hash", "last_name_hash": "family_name_hash"}
    tail = _same("email_hash", "birth_year", SRC)
    return unify(
        [
            Source(xml["students"], _same("student_id", *hashes) | tail),
            Source(csv["users"], {"student_id": "sourced_id"} | hashes | tail, F.col("role") == "student"),
        ]
    )


def staff(xml: Frames, csv: Frames) -> DataFrame:
    """XML staff arrives raw and is hashed here, in canonical form; CSV staff was hashed as is."""
    raw = {f"{c}_hash": x.hashed(c, canonical=True) for c in ("first_name", "last_name", "email")}
    ready = {"first_name_hash": "given_name_hash", "last_name_hash": "family_name_hash", "email_hash": "email_hash"}
    return unify(
        [
            Source(xml["staff"], {"staff_id": "staff_id"} | raw | _same(SRC)),
            Source(csv["users"], {"staff_id": "sourced_id"} | ready | _same(SRC), F.col("role") == "teacher"),
        ]
    )


def schools(xml: Frames, csv: Frames, registry: DataFrame) -> DataFrame:
    listed = csv["orgs"].filter(F.col("org_type") == "school")
    known = joins.lookup(listed, registry, {"identifier": "school_id"}, ["school_type", "district_name"])
    return unify(
        [
            Source(xml["schools"], _same("school_id", "school_name", "school_type", "district_id", "district_name", SRC)),
            Source(
                known,
                {
                    "school_id": "org_id",
                    "school_name": "org_name",
                    "school_type": "school_type",
                    "district_id": "parent_sourced_id",
                    "district_name": "district_name",
                    SRC: SRC,
                },
            ),
        ]
    )


def sections(xml: Frames, csv: Frames) -> DataFrame:
    taught = joins.lookup(csv["classes"], csv["courses"], {"course_sourced_id": "sourced_id"}, {"course_name": "title"})
    both = unify(
        [
            Source(xml["sections"], _same("section_id", "school_id", "course_name", "curriculum_version", "term_name", SRC)),
            Source(
                taught,
                {
                    "section_id": "sourced_id",
                    "school_id": "school_sourced_id",
                    "course_name": "course_name",
                    "curriculum_version": x.code_part("class_code", 3),
                    "term_name": None,
                    SRC: SRC,
                },
            ),
        ]
    )
    return both.withColumns({"subject": x.subject_of("course_name"), "grade_level": x.course_grade("course_name")})


def enrollments(xml: Frames, csv: Frames) -> DataFrame:
    attending = csv["enrollments"].filter(F.col("role") == "student")
    graded = joins.lookup(attending, csv["classes"], {"class_sourced_id": "sourced_id"}, {"class_grades": "grades"})
    return unify(
        [
            Source(
                xml["enrollments"],
                _same("student_id", "school_id", "enrollment_start_date")
                | {"grade_level": x.normalize_grade("grade_level_raw"), SRC: SRC},
            ),
            Source(
                graded,
                {
                    "student_id": "user_sourced_id",
                    "school_id": "school_sourced_id",
                    "enrollment_start_date": "begin_date",
                    "grade_level": x.normalize_grade("class_grades"),
                    SRC: SRC,
                },
            ),
        ]
    )


def section_memberships(xml: Frames, csv: Frames) -> DataFrame:
    """Which student attends which section, from both sources."""
    return unify(
        [
            Source(xml["section_associations"], _same("student_id", "section_id", SRC)),
            Source(
                csv["enrollments"],
                {"student_id": "user_sourced_id", "section_id": "class_sourced_id", SRC: SRC},
                F.col("role") == "student",
            ),
        ]
    )


def section_enrollments(xml: Frames, csv: Frames) -> DataFrame:
    """Student-section rows with the grade of the enrolment (XML) or of the class (CSV)."""
    placed = joins.fan_out(xml["section_associations"], xml["enrollments"], "student_id", ["grade_level_raw"])
    attending = csv["enrollments"].filter(F.col("role") == "student")
    graded = joins.lookup(attending, csv["classes"], {"class_sourced_id": "sourced_id"}, {"class_grades": "grades"})
    return unify(
        [
            Source(
                placed,
                _same("student_id", "section_id") | {"grade_level": x.normalize_grade("grade_level_raw"), SRC: SRC},
            ),
            Source(
                graded,
                {
                    "student_id": "user_sourced_id",
                    "section_id": "class_sourced_id",
                    "grade_level": x.normalize_grade("class_grades"),
                    SRC: SRC,
                },
            ),
        ]
    )


def assessments(xml: Frames, csv: Frames) -> DataFrame:
    """Scores become doubles on both sides before the union, so text cannot break it."""
    answers = ("question_number", "standard_code", "correct_answer", "student_answer")
    return unify(
        [
            Source(
                xml["assessment_results"],
                _same("student_id", "assessment_id", *answers, "score", "assessment_date", "misconception_indicator", SRC),
            ),
            Source(
                csv["results"],
                {"student_id": "student_sourced_id", "assessment_id": "line_item_sourced_id"}
                | _same(*answers, "score")
                | {"assessment_date": "score_date"}
                | _same("misconception_indicator", SRC),
            ),
        ],
        types={"score": "double"},
    )


def grades(xml: Frames) -> DataFrame:
    return project(xml["grades"], _same("student_id", "section_id", "grading_period", "numeric_grade", SRC))


def attendance(xml: Frames) -> DataFrame:
    return project(xml["attendance"], _same("student_id", "school_id", "event_date", "attendance_status", SRC))


def standards(seed: DataFrame) -> DataFrame:
    return project(
        seed,
        _same("standard_code", "standard_description", "domain", "grade_level", "prerequisite_standard_code", "subject"),
    )


def unified(xml: Frames, csv: Frames, seeds: Frames) -> Frames:
    return {
        "int_students": students(xml, csv),
        "int_schools": schools(xml, csv, seeds["seed_school_registry"]),
        "int_enrollments": enrollments(xml, csv),
        "int_sections": sections(xml, csv),
        "int_staff": staff(xml, csv),
        "int_grades": grades(xml),
        "int_assessments": assessments(xml, csv),
        "int_attendance": attendance(xml),
        "int_standards": standards(seeds["seed_learning_standards"]),
    }


# --- published tables -------------------------------------------------------


def dim_school(schools: DataFrame, registry: DataFrame) -> DataFrame:
    filled = joins.enrich(
        schools,
        registry,
        "school_id",
        ["grade_band_low", "grade_band_high"],
        fill=["school_type", "district_id", "district_name"],
    )
    return filled.select(
        "school_id",
        "school_name",
        "school_type",
        "district_id",
        "district_name",
        "grade_band_low",
        "grade_band_high",
        SRC,
    )


def dim_student(students: DataFrame, enrollments: DataFrame) -> DataFrame:
    """One row per student and enrolment; students without one keep a row."""
    return joins.fan_out(students, enrollments, "student_id", ["school_id", "grade_level"]).select(
        "student_id",
        "first_name_hash",
        "last_name_hash",
        "email_hash",
        "birth_year",
        "school_id",
        "grade_level",
        SRC,
    )


def wide_student(students: DataFrame, enrollments: DataFrame, schools: DataFrame, as_of: Column, end_date: str | None = None) -> DataFrame:
    """``dim_student`` with district, start date and whether the enrolment is running."""
    take = ["school_id", "grade_level", "enrollment_start_date", *([end_date] if end_date else [])]
    joined = joins.fan_out(students, enrollments, "student_id", take)
    joined = joins.lookup(joined, schools, "school_id", ["district_id"])
    start = F.col("enrollment_start_date").try_cast("date")
    running = start <= as_of
    if end_date:
        running = running & (F.col(end_date).isNull() | (as_of <= F.col(end_date).try_cast("date")))
    return joined.select(
        *[c for c in students.columns if c != SRC],
        "school_id",
        "grade_level",
        "district_id",
        start.alias("enrollment_start_date"),
        F.coalesce(running, F.lit(False)).alias("is_active"),
        SRC,
    )


def dim_section(sections: DataFrame) -> DataFrame:
    return sections.select(
        "section_id", "school_id", "course_name", "curriculum_version", "term_name", "subject", "grade_level", SRC
    )


def dim_standard(standards: DataFrame) -> DataFrame:
    return standards.select(
        "standard_code", "standard_description", "domain", "grade_level", "prerequisite_standard_code", "subject"
    )


def dim_misconception_pattern(seed: DataFrame) -> DataFrame:
    return seed.select(
        "misconception_id", "standard_code", "pattern_label", "description", "suggested_reteach", "wrong_answer_pattern"
    )


MASTERY_KEYS = ("student_id", "standard_code")


def fact_student_mastery_daily(assessments: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Best score so far; rows of one date are taken by assessment and question."""
    scores = assessments.select(
        *MASTERY_KEYS, F.col("assessment_date").alias("date_key"), "score", SRC, "assessment_id", "question_number"
    )
    best = mastery.running_best(
        scores, MASTERY_KEYS, "date_key", "score", ["assessment_id", "question_number"], hot_rows=hot_rows
    )
    return best.select(
        *MASTERY_KEYS, "date_key", "score", SRC, "max_score_to_date", "assessment_count", "mastery_level"
    )


def mastery_with_school(mastery_fact: DataFrame, enrollments: DataFrame) -> DataFrame:
    """The mastery fact once per school the student is enrolled in.

    The running best is taken before this join, so several enrolments neither
    repeat scores nor raise the count.
    """
    places = enrollments.select(F.col("student_id").alias("__student"), "school_id").distinct()
    return mastery_fact.join(places, F.col("student_id") == F.col("__student"), "inner").select(
        *MASTERY_KEYS, "school_id", "date_key", "max_score_to_date", "assessment_count", "mastery_level"
    )


def fact_assessment_responses(assessments: DataFrame, patterns: DataFrame) -> DataFrame:
    tagged = responses.tag_with_patterns(
        assessments, patterns, {"standard_code": "standard_code", "misconception_indicator": "pattern_label"}
    )
    return tagged.select(
        "student_id",
        "assessment_id",
        "question_number",
        "standard_code",
        "correct_answer",
        "student_answer",
        "score",
        "assessment_date",
        "is_correct",
        "misconception_indicator",
        "misconception_tag",
        "misconception_description",
        "suggested_reteach",
        SRC,
    )


def fact_attendance_daily(attendance: DataFrame) -> DataFrame:
    return attendance.select("student_id", "school_id", "event_date", F.col("attendance_status").alias("status"), SRC)


def agg_early_warning(mastery_fact: DataFrame, attendance_fact: DataFrame, **options) -> DataFrame:
    return mastery.early_warning(mastery_fact, attendance_fact, **options)


def members(student_dim: DataFrame, school_dim: DataFrame) -> DataFrame:
    """Student rows with the district of their school; rows without a known school are left out."""
    places = school_dim.select(F.col("school_id").alias("__school"), "district_id", "district_name")
    return student_dim.join(places, F.col("school_id") == F.col("__school"), "inner").drop("__school")


def agg_district_comparison(
    mastery_fact: DataFrame, student_dim: DataFrame, school_dim: DataFrame, standard_dim: DataFrame, dedupe: bool = False
) -> DataFrame:
    """``mastery_fact`` may be any frame of student, standard and score."""
    latest = mastery.latest_mastery(mastery_fact, MASTERY_KEYS)
    return mastery.group_comparison(latest, members(student_dim, school_dim), standard_dim, dedupe=dedupe)


# --- quality rules ----------------------------------------------------------
# The names and texts of the rules below.


def enrollment_rules(school_dim: DataFrame, as_of: Column) -> list[quality.Rule]:
    return [
        quality.Rule(
            "valid_school_id",
            "SchoolID not found in district registry",
            "school_id",
            "Must match a school in seed_school_registry",
            quality.ExistsIn(school_dim, "school_id"),
            "enrollment",
        ),
        quality.Rule(
            "enrollment_date_not_future",
            "Enrollment start date cannot be in the future",
            "enrollment_start_date",
            "Must be <= current_date",
            F.col("enrollment_start_date").try_cast("date") > as_of.cast("date"),
            "enrollment",
        ),
    ]


def student_rules() -> list[quality.Rule]:
    return [
        quality.Rule(
            "student_id_not_null",
            "Student ID is required",
            "student_id",
            "Must be non-null",
            F.col("student_id").isNull(),
            "student",
            F.lit("NULL"),
        )
    ]


def fact_dq_quarantine_log(
    enrollments: DataFrame, students: DataFrame, school_dim: DataFrame, as_of: Column, run_ts: datetime | Column
) -> DataFrame:
    """All violations; the violating rows also stay in the tables."""
    return quality.union_logs(
        [
            quality.violations(enrollments, enrollment_rules(school_dim, as_of), run_ts, "student_id"),
            quality.violations(students, student_rules(), run_ts, "student_id"),
        ]
    )


def section_rules(section_dim: DataFrame) -> list[quality.Rule]:
    """Rules on student-section rows."""
    return [
        quality.Rule(
            "section_exists_for_enrollment",
            "Enrollment references non-existent section",
            "section_id",
            "Must reference existing section in int_sections",
            quality.ExistsIn(section_dim, "section_id", null_ok=True),
            "enrollment",
        )
    ]


def grade_course_violations(enrolled: DataFrame, section_dim: DataFrame, school_dim: DataFrame, run_ts: datetime | Column) -> DataFrame:
    """Elementary students (K-5) in an AP course or in a high school, as log rows.

    ``enrolled`` carries student_id, section_id and grade_level.
    """
    young = enrolled.filter(F.col("grade_level").between(0, 5))
    offered = section_dim.select("section_id", "course_name", F.col("school_id").alias("__school"))
    placed = school_dim.select(F.col("school_id").alias("__place"), "school_type")
    joined = young.join(offered, "section_id", "inner").join(placed, F.col("__school") == F.col("__place"), "inner")
    rule = quality.Rule(
        "grade_level_course_match",
        "Student grade level incompatible with course grade band",
        "grade_level",
        "Elementary students (K-5) cannot enroll in High School courses",
        F.coalesce(F.col("course_name").ilike("%AP %"), F.lit(False)) | F.coalesce(F.col("school_type") == "High", F.lit(False)),
        "enrollment",
        F.concat_ws(" in ", F.col("grade_level").cast("string"), F.col("course_name")),
    )
    return quality.violations(joined, [rule], run_ts, "student_id")
