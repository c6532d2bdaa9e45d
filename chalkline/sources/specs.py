"""What each source entity looks like.

All names below are fixed values given by the two exchange formats and by the
tables made from them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

XML_SOURCE = "edfi"
CSV_SOURCE = "oneroster"


@dataclass(frozen=True)
class XmlEntity:
    """One element per row: output column -> path below the row element.

    A path of None is a column the format does not carry; the attribute ``id``
    of the row element has the path ``_id``.  With ``items`` every
    repeated child becomes a row and ``item_fields`` are read from the child;
    a column in both falls back to the row element when the child leaves it out.
    """

    file: str
    row_tag: str
    fields: dict[str, str | None]
    items: str | None = None
    item_fields: dict[str, str] = field(default_factory=dict)
    columns: tuple[str, ...] = ()

    @property
    def output(self) -> tuple[str, ...]:
        return self.columns or tuple(self.fields)


XML_ENTITIES = {
    "students": XmlEntity(
        "Students.xml",
        "Student",
        {
            "student_unique_id": "StudentUniqueId",
            "first_name": "FirstName",
            "last_name": "LastSurname",
            "birth_date": "BirthDate",
            "email": "Email",
        },
    ),
    "schools": XmlEntity(
        "Schools.xml",
        "School",
        {
            "school_id": "SchoolId",
            "school_name": "SchoolName",
            "school_type": "SchoolType",
            "district_id": "DistrictId",
            "district_name": "DistrictName",
        },
    ),
    "staff": XmlEntity(
        "Staff.xml",
        "Staff",
        {
            "staff_unique_id": "StaffUniqueId",
            "first_name": "FirstName",
            "last_name": "LastSurname",
            "email": "Email",
        },
    ),
    "sections": XmlEntity(
        "Sections.xml",
        "Section",
        {
            "section_identifier": "SectionIdentifier",
            "school_id": "SchoolReference.SchoolId",
            "course_name": "CourseOfferingReference.CourseName",
            "curriculum_version": "CurriculumVersion",
            "term_name": None,
        },
    ),
    "enrollments": XmlEntity(
        "StudentSchoolAssociations.xml",
        "StudentSchoolAssociation",
        {
            "student_unique_id": "StudentReference.StudentUniqueId",
            "school_id": "SchoolReference.SchoolId",
            "entry_date": "EntryDate",
            "grade_level_descriptor": "EntryGradeLevelDescriptor",
        },
    ),
    "section_associations": XmlEntity(
        "StudentSectionAssociations.xml",
        "StudentSectionAssociation",
        {
            "student_unique_id": "StudentReference.StudentUniqueId",
            "section_identifier": "SectionReference.SectionIdentifier",
            "begin_date": None,
        },
    ),
    "grades": XmlEntity(
        "Grades.xml",
        "Grade",
        {
            "student_unique_id": "StudentReference.StudentUniqueId",
            "section_identifier": "SectionReference.SectionIdentifier",
            "grading_period": "GradingPeriod",
            "numeric_grade": "NumericGrade",
        },
    ),
    "assessment_results": XmlEntity(
        "StudentAssessments.xml",
        "StudentAssessment",
        {
            "student_unique_id": "StudentReference.StudentUniqueId",
            "assessment_id": "AssessmentIdentifier",
            "standard_code": "StandardCode",
            "score": "ScoreResult",
            "assessment_date": None,
        },
        items="StudentAssessmentItem",
        item_fields={
            "question_number": "QuestionNumber",
            "standard_code": "LearningStandardCode",
            "correct_answer": "CorrectAnswer",
            "student_answer": "StudentAnswer",
            "misconception_indicator": "MisconceptionIndicator",
        },
        columns=(
            "student_unique_id",
            "assessment_id",
            "question_number",
            "standard_code",
            "correct_answer",
            "student_answer",
            "score",
            "assessment_date",
            "misconception_indicator",
        ),
    ),
    "attendance": XmlEntity(
        "StudentSchoolAttendanceEvents.xml",
        "StudentSchoolAttendanceEvent",
        {
            "student_unique_id": "StudentReference.StudentUniqueId",
            "school_id": "SchoolReference.SchoolId",
            "event_date": "EventDate",
            "attendance_status": "AttendanceEventCategory",
        },
    ),
    "standards": XmlEntity(
        "LearningStandards.xml",
        "LearningStandard",
        {"standard_code": "StandardCode", "standard_description": "StandardDescription"},
    ),
}


@dataclass(frozen=True)
class CsvEntity:
    """A header file; output columns are header names in snake case, in this order."""

    file: str
    columns: tuple[str, ...]


CSV_ENTITIES = {
    "users": CsvEntity("users.csv", ("sourced_id", "given_name", "family_name", "email", "role", "grades")),
    "orgs": CsvEntity("orgs.csv", ("sourced_id", "name", "type", "identifier", "parent_sourced_id")),
    "classes": CsvEntity(
        "classes.csv",
        (
            "sourced_id",
            "title",
            "grades",
            "course_sourced_id",
            "class_code",
            "class_type",
            "school_sourced_id",
            "term_sourced_ids",
        ),
    ),
    "courses": CsvEntity("courses.csv", ("sourced_id", "title", "course_code", "grades", "org_sourced_id")),
    "enrollments": CsvEntity(
        "enrollments.csv",
        (
            "sourced_id",
            "class_sourced_id",
            "school_sourced_id",
            "user_sourced_id",
            "role",
            "begin_date",
            "end_date",
        ),
    ),
    "academic_sessions": CsvEntity(
        "academicSessions.csv",
        ("sourced_id", "title", "type", "start_date", "end_date", "parent_sourced_id", "school_year"),
    ),
    "line_items": CsvEntity(
        "lineItems.csv",
        (
            "sourced_id",
            "title",
            "assign_date",
            "due_date",
            "class_sourced_id",
            "result_value_min",
            "result_value_max",
        ),
    ),
    "results": CsvEntity(
        "results.csv",
        (
            "sourced_id",
            "line_item_sourced_id",
            "student_sourced_id",
            "score",
            "score_date",
            "question_number",
            "standard_code",
            "correct_answer",
            "student_answer",
            "misconception_indicator",
        ),
    ),
    "demographics": CsvEntity(
        "demographics.csv",
        (
            "sourced_id",
            "birth_date",
            "sex",
            "american_indian_or_alaska_native",
            "asian",
            "black_or_african_american",
            "native_hawaiian_or_other_pacific_islander",
            "white",
            "demographic_race_two_or_more_races",
            "hispanic_or_latino_ethnicity",
        ),
    ),
}

SEEDS = {
    "seed_school_registry": (
        "school_id string, school_name string, school_type string, grade_band_low int, grade_band_high int, "
        "district_id string, district_name string, source_system string"
    ),
    "seed_learning_standards": (
        "standard_code string, standard_description string, domain string, grade_level int, "
        "prerequisite_standard_code string, subject string"
    ),
    "seed_misconception_patterns": (
        "misconception_id string, standard_code string, pattern_label string, description string, "
        "suggested_reteach string, wrong_answer_pattern string"
    ),
}
