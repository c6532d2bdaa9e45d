"""All K-12 tables on top of the bindings, built on demand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chalkline.plans import k12, pipeline
from chalkline.plans.staging import staged_columns
from chalkline.operators.unify import project
from chalkline.registry import bindings as b
from chalkline.sources.readers import stamp
from chalkline.sources.specs import CSV_SOURCE, XML_SOURCE


class Model:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.t = b.tables(spark, sf_dir)
        self.raw_xml = b.bound_all(spark, self.t, b.XML_RAW)
        self.raw_csv = b.bound_all(spark, self.t, b.CSV_RAW)
        self.seeds = b.bound_all(spark, self.t, b.SEEDS)
        self.xml = b._Lazy(lambda name: self.staged(XML_SOURCE, name))
        self.csv = b._Lazy(lambda name: self.staged(CSV_SOURCE, name))
        self.table = b._Lazy(lambda name: getattr(self, f"_{name}")())

    @property
    def as_of(self):
        return F.lit(b.AS_OF).cast("date")

    @property
    def run_ts(self):
        return F.lit(b.RUN_TS).cast("timestamp")

    def table_set(self) -> dict[str, DataFrame]:
        """Every table, built now."""
        names = [n[1:] for n in vars(Model) if n.startswith("_") and not n.startswith("__")]
        return {n: self.table[n] for n in names}

    def silver(self, source: str, name: str) -> DataFrame:
        raw = (self.raw_xml if source == XML_SOURCE else self.raw_csv)[name]
        raw = stamp(raw, source, b.LOADED_AT)
        if (source, name) == (XML_SOURCE, "students"):
            return pipeline.masked_students(raw)
        if (source, name) == (CSV_SOURCE, "users"):
            return pipeline.masked_users(raw, self.raw_csv["demographics"])
        return raw

    def staged(self, source: str, name: str) -> DataFrame:
        return project(self.silver(source, name), staged_columns(source, name))

    # unified
    def _int_students(self):
        return k12.students(self.xml, self.csv)

    def _int_staff(self):
        return k12.staff(self.xml, self.csv)

    def _int_schools(self):
        return k12.schools(self.xml, self.csv, self.seeds["seed_school_registry"])

    def _int_sections(self):
        return k12.sections(self.xml, self.csv)

    def _int_enrollments(self):
        return k12.enrollments(self.xml, self.csv)

    def _int_assessments(self):
        return k12.assessments(self.xml, self.csv)

    def _int_grades(self):
        return k12.grades(self.xml)

    def _int_attendance(self):
        return k12.attendance(self.xml)

    def _int_standards(self):
        return k12.standards(self.seeds["seed_learning_standards"])

    def _section_memberships(self):
        return k12.section_memberships(self.xml, self.csv)

    # published
    def _dim_school(self):
        return k12.dim_school(self.table["int_schools"], self.seeds["seed_school_registry"])

    def _dim_student(self):
        return k12.dim_student(self.table["int_students"], self.table["int_enrollments"])

    def _dim_section(self):
        return k12.dim_section(self.table["int_sections"])

    def _dim_standard(self):
        return k12.dim_standard(self.table["int_standards"])

    def _dim_misconception_pattern(self):
        return k12.dim_misconception_pattern(self.seeds["seed_misconception_patterns"])

    def _fact_student_mastery_daily(self):
        return k12.fact_student_mastery_daily(self.table["int_assessments"])

    def _scores(self):
        """Scored rows: all that the last state of a key needs, so no running column is computed for it."""
        return self.table["int_assessments"].filter(F.col("score").isNotNull())

    def _fact_assessment_responses(self):
        return k12.fact_assessment_responses(self.table["int_assessments"], self.table["dim_misconception_pattern"])

    def _fact_attendance_daily(self):
        return k12.fact_attendance_daily(self.table["int_attendance"])

    def _fact_dq_quarantine_log(self):
        return k12.fact_dq_quarantine_log(
            self.table["int_enrollments"], self.table["int_students"], self.table["dim_school"], self.as_of, self.run_ts
        )

    def _agg_early_warning(self):
        return k12.agg_early_warning(self.table["fact_student_mastery_daily"], self.table["fact_attendance_daily"])

    def _agg_district_comparison(self):
        return k12.agg_district_comparison(
            self.table["scores"],
            self.table["dim_student"],
            self.table["dim_school"],
            self.table["dim_standard"],
        )
