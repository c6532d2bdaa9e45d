"""Silver tables under their common names: pure projections."""

from __future__ import annotations

from pyspark.sql import DataFrame

from chalkline.operators.unify import project
from chalkline.sources.specs import CSV_ENTITIES, CSV_SOURCE, XML_ENTITIES, XML_SOURCE

META = ("_source_system", "_loaded_at")

# Silver name -> staged name, by entity.
XML_RENAMES = {
    "students": {"student_unique_id": "student_id"},
    "staff": {"staff_unique_id": "staff_id"},
    "sections": {"section_identifier": "section_id"},
    "enrollments": {
        "student_unique_id": "student_id",
        "entry_date": "enrollment_start_date",
        "grade_level_descriptor": "grade_level_raw",
    },
    "section_associations": {"student_unique_id": "student_id", "section_identifier": "section_id"},
    "grades": {"student_unique_id": "student_id", "section_identifier": "section_id"},
    "assessment_results": {"student_unique_id": "student_id"},
    "attendance": {"student_unique_id": "student_id"},
}
CSV_RENAMES = {"orgs": {"sourced_id": "org_id", "name": "org_name", "type": "org_type"}}
HASHED = {
    (XML_SOURCE, "students"): ("student_unique_id", "first_name_hash", "last_name_hash", "email_hash", "birth_year"),
    (CSV_SOURCE, "users"): (
        "sourced_id",
        "role",
        "grades",
        "given_name_hash",
        "family_name_hash",
        "email_hash",
        "birth_year",
    ),
}


def staged_columns(source: str, name: str) -> dict[str, str]:
    """Staged name -> silver name."""
    if source == XML_SOURCE:
        columns, renames = XML_ENTITIES[name].output, XML_RENAMES.get(name, {})
    else:
        columns, renames = CSV_ENTITIES[name].columns, CSV_RENAMES.get(name, {})
    columns = (*HASHED.get((source, name), columns), *META)
    return {renames.get(c, c): c for c in columns}


def stage(source: str, silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every silver table of one source as its staging view."""
    return {name: project(df, staged_columns(source, name)) for name, df in silver.items()}
