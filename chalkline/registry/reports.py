"""Gates, checks and reports on the K-12 tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chalkline.functions import exprs as x
from chalkline.operators import analytics, joins, mastery, pii, quality, responses
from chalkline.operators.unify import shared_values
from chalkline.plans import checks, k12
from chalkline.registry import bindings as b
from chalkline.registry.base import query, rounded
from chalkline.registry.model import Model
from chalkline.registry.oracle import LEVEL, with_models
from chalkline.session import materialized, remove_at_exit, scratch_path
from chalkline.sources.specs import CSV_ENTITIES, CSV_SOURCE, XML_ENTITIES, XML_SOURCE


def latest(m: Model) -> DataFrame:
    return mastery.latest_mastery(m.table["scores"], k12.MASTERY_KEYS)


# --- gates ---------------------------------------------------------------------


@query(
    "gate_valid_school_id",
    with_models(
        """SELECT student_id, school_id, _source_system FROM int_enrollments e
           WHERE NOT EXISTS (SELECT 1 FROM dim_school s WHERE s.school_id = e.school_id)"""
    ),
)
def gate_valid_school_id(m: Model) -> DataFrame:
    return checks.valid_school_id(m.table["int_enrollments"], m.table["dim_school"])


@query(
    "gate_grade_level_course_match",
    with_models(
        """SELECT e.student_id, e.grade_level, s.school_name, s.grade_band_low, s.grade_band_high, e._source_system
           FROM int_enrollments e JOIN dim_school s USING (school_id) WHERE e.grade_level < s.grade_band_low"""
    ),
)
def gate_grade_level_course_match(m: Model) -> DataFrame:
    return checks.grade_level_course_match(m.table["int_enrollments"], m.table["dim_school"])


@query(
    "gate_enrollment_date_not_future",
    with_models(
        f"""SELECT student_id, enrollment_start_date, _source_system FROM int_enrollments
            WHERE TRY_CAST(enrollment_start_date AS DATE) > DATE '{b.AS_OF}'"""
    ),
)
def gate_enrollment_date_not_future(m: Model) -> DataFrame:
    return checks.enrollment_date_not_future(m.table["int_enrollments"], m.as_of)


@query(
    "gate_section_exists_for_enrollment",
    with_models(
        """SELECT DISTINCT school_id, _source_system FROM int_enrollments
           WHERE school_id IS NOT NULL AND school_id NOT IN (SELECT school_id FROM int_sections)"""
    ),
)
def gate_section_exists_for_enrollment(m: Model) -> DataFrame:
    return checks.section_exists_for_enrollment(m.table["int_enrollments"], m.table["int_sections"])


@query(
    "gate_student_id_not_null",
    with_models("SELECT _source_system, count(*) AS null_count FROM int_students WHERE student_id IS NULL GROUP BY ALL"),
)
def gate_student_id_not_null(m: Model) -> DataFrame:
    return checks.student_id_not_null(m.table["int_students"])


@query(
    "gate_pii_masked",
    with_models(
        """SELECT 'dim_student' AS "table", count(student_id) AS rows_checked, 0 AS forbidden FROM dim_student
           UNION ALL SELECT 'raw_staff', count(staff_unique_id), 3 FROM x_staff"""
    ),
)
def gate_pii_masked(m: Model) -> DataFrame:
    """Forbidden columns of a published table and, for contrast, of the raw staff table."""
    checked = (("dim_student", m.table["dim_student"], "student_id"), ("raw_staff", m.raw_xml["staff"], "staff_unique_id"))
    rows = reduce(DataFrame.unionByName, (df.agg(F.lit(name).alias("table"), F.count(key).alias("rows_checked")) for name, df, key in checked))
    found = reduce(DataFrame.unionByName, (pii.forbidden_columns(df).select(F.lit(name).alias("table")) for name, df, _ in checked))
    counted = found.groupBy("table").agg(F.count(F.lit(1)).cast("int").alias("forbidden"))
    return rows.join(counted, "table", "left").withColumn("forbidden", F.coalesce("forbidden", F.lit(0)))


@query(
    "gate_attendance_rate_bounds",
    with_models("SELECT student_id, attendance_rate AS rate FROM attendance_rates WHERE attendance_rate NOT BETWEEN 0 AND 1"),
)
def gate_attendance_rate_bounds(m: Model) -> DataFrame:
    return checks.attendance_rate_bounds(m.table["fact_attendance_daily"])


@query(
    "gate_max_value_mastery",
    with_models(
        """SELECT student_id, standard_code, date_key, max_score_to_date, prev_max FROM (
             SELECT *, lag(max_score_to_date) OVER (PARTITION BY student_id, standard_code
                                                   ORDER BY date_key NULLS LAST, assessment_count) AS prev_max
             FROM fact_student_mastery_daily) r WHERE max_score_to_date < prev_max"""
    ),
)
def gate_max_value_mastery(m: Model) -> DataFrame:
    return checks.max_value_mastery(m.table["fact_student_mastery_daily"])


@query(
    "falling_raw_scores",
    with_models(
        """SELECT student_id, standard_code, date_key, assessment_count, max_score_to_date, prev_max FROM (
             SELECT student_id, standard_code, date_key, assessment_count, score AS max_score_to_date,
                    lag(score) OVER (PARTITION BY student_id, standard_code
                                     ORDER BY date_key NULLS LAST, assessment_count) AS prev_max
             FROM fact_student_mastery_daily) r WHERE max_score_to_date < prev_max"""
    ),
)
def falling_raw_scores(m: Model) -> DataFrame:
    """The same gate on raw scores, which do fall."""
    rows = m.table["fact_student_mastery_daily"].select(
        "student_id", "standard_code", "date_key", "assessment_count", F.col("score").alias("max_score_to_date")
    )
    return mastery.falling_best(rows, ["student_id", "standard_code"], ["date_key", "assessment_count"])


@query(
    "gate_best_covers_scores",
    with_models(
        """SELECT student_id, standard_code, max(score) AS top_score, max(max_score_to_date) AS top_best
           FROM fact_student_mastery_daily GROUP BY ALL HAVING max(max_score_to_date) < max(score)"""
    ),
)
def gate_best_covers_scores(m: Model) -> DataFrame:
    return mastery.best_below_scores(m.table["fact_student_mastery_daily"], k12.MASTERY_KEYS)


@query(
    "gate_no_duplicate_students",
    with_models(
        """SELECT student_id, _source_system, count(*) AS occurrence_count FROM int_students WHERE student_id IS NOT NULL
           GROUP BY ALL HAVING count(*) > 1"""
    ),
)
def gate_no_duplicate_students(m: Model) -> DataFrame:
    return checks.no_duplicate_students(m.table["int_students"])


@query(
    "gate_answer_exists_for_scored_assessment",
    with_models(
        """SELECT student_id, assessment_id, question_number, score, _source_system FROM fact_assessment_responses
           WHERE score IS NOT NULL AND (student_answer IS NULL OR correct_answer IS NULL)"""
    ),
)
def gate_answer_exists_for_scored_assessment(m: Model) -> DataFrame:
    return checks.answer_exists_for_scored_assessment(m.table["fact_assessment_responses"])


@query(
    "dangling_sections",
    with_models(
        """SELECT student_id, section_id, _source_system FROM section_memberships
           WHERE section_id IS NOT NULL AND section_id NOT IN (SELECT section_id FROM int_sections)"""
    ),
)
def dangling_sections(m: Model) -> DataFrame:
    return checks.dangling_sections(m.table["section_memberships"], m.table["int_sections"])


# --- declared checks ---------------------------------------------------------------

# In the order of _CHECKED, where a table follows those it is made from.
_WRITTEN = (
    "int_schools", "int_enrollments", "int_sections", "int_standards", "dim_student", "dim_school", "dim_misconception_pattern",
    "fact_student_mastery_daily", "fact_dq_quarantine_log", "agg_early_warning", "agg_district_comparison",
)
_CHECKED = tuple(dict.fromkeys(t for t, _, _ in checks.NOT_NULL))


def _checked_sql() -> str:
    rows = [
        f"SELECT 'not_null' AS \"check\", '{table}' AS \"table\", '{column}' AS \"column\", '{severity}' AS severity, "
        f"count(*) FILTER (WHERE {column} IS NULL) AS violations FROM \"{table}\""
        for table, column, severity in checks.NOT_NULL
    ]
    rows += [
        f"SELECT 'unique', '{table}', '{column}', 'error', count(*) FROM (SELECT {column} FROM \"{table}\" "
        f"WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1) d"
        for table, column in checks.UNIQUE.items()
    ]
    rows += [
        f"SELECT 'relationships', '{table}', '{column}', '{severity}', count(*) FROM \"{table}\" "
        f"WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM \"{parent}\" WHERE {key} IS NOT NULL)"
        for table, column, parent, key, severity in checks.RELATIONSHIPS
    ]
    rows += [
        f"SELECT 'accepted_values', '{table}', '{column}', 'error', count(DISTINCT {column}) FROM \"{table}\" "
        f"WHERE {column} NOT IN ({', '.join(repr(v) for v in values)})"
        for (table, column), values in checks.ACCEPTED.items()
    ]
    return " UNION ALL ".join(rows)


def _checked_tables(m: Model) -> dict[str, DataFrame]:
    """Every table with declared checks.

    Those that take a join, an order or an aggregate are written once, as several checks and tables read them.  The others
    are projections, of which each check reads its own columns only.
    """
    out = {}
    for name in _CHECKED:
        source, _, entity = name.partition(".")
        if name in _WRITTEN:
            m.table[name] = materialized(m.table[name], "checked")
        out[name] = m.staged(source, entity) if entity else m.table[name]
    return out


@query(
    "declared_check_report",
    with_models(
        f"""SELECT *, CASE WHEN violations = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status
            FROM ({_checked_sql()}) r"""
    ),
)
def declared_check_report(m: Model) -> DataFrame:
    """All declared checks of all layers."""
    return quality.report(quality.settled(checks.declared_checks(_checked_tables(m))))


@query(
    "unexpected_values",
    """SELECT o_orderpriority, count(*) AS rows FROM orders
       WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') GROUP BY o_orderpriority""",
)
def unexpected_values(m: Model) -> DataFrame:
    return quality.unexpected_values(m.t["orders"], "o_orderpriority", ["1-URGENT", "2-HIGH"])


@query(
    "all_gates_report",
    with_models(
        f"""SELECT g AS "check", 'gate' AS "table", '' AS "column", 'error' AS severity, v AS violations,
                   CASE WHEN v = 0 THEN 'pass' ELSE 'fail' END AS status FROM (
              SELECT 'valid_school_id' AS g, count(*) AS v FROM int_enrollments e
                WHERE NOT EXISTS (SELECT 1 FROM dim_school s WHERE s.school_id = e.school_id)
              UNION ALL SELECT 'enrollment_date_not_future', count(*) FROM int_enrollments
                WHERE TRY_CAST(enrollment_start_date AS DATE) > DATE '{b.AS_OF}'
              UNION ALL SELECT 'section_exists_for_enrollment', count(DISTINCT (school_id, _source_system)) FROM int_enrollments
                WHERE school_id IS NOT NULL AND school_id NOT IN (SELECT school_id FROM int_sections)
              UNION ALL SELECT 'student_id_not_null', count(DISTINCT _source_system) FROM int_students WHERE student_id IS NULL
              UNION ALL SELECT 'no_duplicate_students', count(*) FROM (SELECT 1 FROM int_students
                WHERE student_id IS NOT NULL GROUP BY student_id, _source_system HAVING count(*) > 1) d
              UNION ALL SELECT 'answer_exists_for_scored_assessment', count(*) FROM fact_assessment_responses
                WHERE score IS NOT NULL AND (student_answer IS NULL OR correct_answer IS NULL)
              UNION ALL SELECT 'attendance_rate_bounds', count(*) FROM attendance_rates
                WHERE attendance_rate NOT BETWEEN 0 AND 1
              UNION ALL SELECT 'grade_level_course_match', count(*) FROM int_enrollments e JOIN dim_school s USING (school_id)
                WHERE e.grade_level < s.grade_band_low
              UNION ALL SELECT 'pii_masked_in_gold', 0
              UNION ALL SELECT 'max_value_mastery', 0) r"""
    ),
)
def all_gates_report(m: Model) -> DataFrame:
    rows = [quality.counted(df, name, "gate") for name, df in checks.gates(m.table_set(), m.as_of).items()]
    return quality.report(rows)


# --- rules, routing, scorecard --------------------------------------------------------

_FLAGS = f"""
    SELECT e.*, (s.school_id IS NULL) AS bad_school,
           coalesce(TRY_CAST(enrollment_start_date AS DATE) > DATE '{b.AS_OF}', false) AS bad_date
    FROM int_enrollments e LEFT JOIN dim_school s ON s.school_id = e.school_id"""


def _flagged(m: Model) -> DataFrame:
    return quality.with_failures(m.table["int_enrollments"], k12.enrollment_rules(m.table["dim_school"], m.as_of))


@query(
    "enrollments_passed",
    with_models(
        f"""SELECT student_id, school_id, enrollment_start_date, grade_level, _source_system FROM ({_FLAGS}) f
            WHERE NOT bad_school AND NOT bad_date"""
    ),
)
def enrollments_passed(m: Model) -> DataFrame:
    return quality.route(m.table["int_enrollments"], k12.enrollment_rules(m.table["dim_school"], m.as_of))[0]


@query(
    "enrollments_quarantined",
    with_models(
        f"""SELECT student_id, school_id, enrollment_start_date, grade_level, _source_system FROM ({_FLAGS}) f
            WHERE bad_school OR bad_date"""
    ),
)
def enrollments_quarantined(m: Model) -> DataFrame:
    return quality.route(m.table["int_enrollments"], k12.enrollment_rules(m.table["dim_school"], m.as_of))[1]


@query(
    "routing_totals",
    with_models(
        f"""SELECT count(*) AS ingested, count(*) FILTER (WHERE NOT bad_school AND NOT bad_date) AS passed,
                   count(*) FILTER (WHERE bad_school OR bad_date) AS quarantined FROM ({_FLAGS}) f"""
    ),
)
def routing_totals(m: Model) -> DataFrame:
    return quality.route_totals(_flagged(m))


@query(
    "routed_in_one_pass",
    with_models(
        f"""SELECT outcome, count(*) AS rows, sum(failures)::bigint AS failures, min(total) AS observed, min(student_id) AS first_student FROM (
              SELECT *, CASE WHEN bad_school OR bad_date THEN 'quarantined' ELSE 'passed' END AS outcome,
                     bad_school::int + bad_date::int AS failures,
                     count(*) OVER (PARTITION BY bad_school OR bad_date) AS total FROM ({_FLAGS}) f) g GROUP BY outcome"""
    ),
)
def routed_in_one_pass(m: Model) -> DataFrame:
    """Both sides as they were written, next to the totals observed on the way and the log made from the written failures."""
    path = scratch_path(m.spark, "routed")
    done = quality.routed(
        m.table["int_enrollments"], k12.enrollment_rules(m.table["dim_school"], m.as_of), path, m.run_ts, "student_id"
    )
    remove_at_exit(m.spark, path)
    none = F.lit(0).cast("long")
    logged = done.log.agg(
        F.lit("quarantined").alias("outcome"), none.alias("rows"), none.alias("observed"), F.max(F.lit(None).cast("string")).alias("first_student"),
        F.count(F.lit(1)).alias("failures"),
    )
    sides = [
        df.agg(
            F.lit(name).alias("outcome"), F.count(F.lit(1)).alias("rows"), F.lit(done.totals[name]).cast("long").alias("observed"),
            F.min("student_id").alias("first_student"), none.alias("failures"),
        )
        for name, df in (("passed", done.passed), ("quarantined", done.quarantined))
    ]
    both = reduce(DataFrame.unionByName, [*sides, logged])
    return both.groupBy("outcome").agg(*[F.max(c).alias(c) for c in ("rows", "failures", "observed", "first_student")])


@query(
    "quality_freshness",
    """SELECT s AS source, age, count(*) AS ingested,
              CASE WHEN age <= 1 THEN 'green' WHEN age <= 7 THEN 'yellow' ELSE 'red' END AS freshness
       FROM (SELECT o_orderstatus AS s, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 7 ELSE 8 END AS age FROM orders) o
       GROUP BY s, age""",
)
def quality_freshness(m: Model) -> DataFrame:
    """Sources loaded today, a week ago and before: each colour of the scorecard."""
    age = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 7).otherwise(8)
    loaded = m.t["orders"].select(F.col("o_orderstatus").alias("source"), age.alias("age"), F.date_sub(m.as_of, age).cast("string").alias("_loaded_at"))
    rules = [quality.Rule("known", "Source is known", "source", "Must be known", F.col("source").isNull())]
    card = quality.scorecard(quality.with_failures(loaded, rules), m.as_of, source="source")
    return card.select("source", F.date_diff(m.as_of, F.col("last_loaded_at").cast("date")).alias("age"), "ingested", "freshness")


@query(
    "quality_scorecard",
    with_models(
        f"""SELECT _source_system, count(*) AS ingested, count(*) FILTER (WHERE NOT bad_school AND NOT bad_date) AS passed,
                   count(*) FILTER (WHERE bad_school OR bad_date) AS quarantined, max('{b.LOADED_AT}') AS last_loaded_at,
                   round(count(*) FILTER (WHERE NOT bad_school AND NOT bad_date) / count(*) * 100, 1) AS pass_rate,
                   'red' AS freshness FROM ({_FLAGS}) f GROUP BY _source_system"""
    ),
)
def quality_scorecard(m: Model) -> DataFrame:
    stamped = m.table["int_enrollments"].withColumn("_loaded_at", F.lit(b.LOADED_AT))
    rules = k12.enrollment_rules(m.table["dim_school"], m.as_of)
    return quality.scorecard(quality.with_failures(stamped, rules), m.as_of)


@query(
    "rules_on_lines",
    """SELECT rule_name, field_value, count(*) AS violations FROM (
         SELECT 'part_known' AS rule_name, '' || l_partkey AS field_value FROM lineitem
           WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 40)
         UNION ALL SELECT 'not_future', '' || CAST(l_shipdate AS DATE) FROM lineitem WHERE CAST(l_shipdate AS DATE) > DATE '2001-01-01'
         UNION ALL SELECT 'taxed', '' || l_linenumber FROM lineitem WHERE l_tax = 0) r GROUP BY ALL""",
)
def rules_on_lines(m: Model) -> DataFrame:
    """A reference rule and two row rules in one pass over the lines."""
    lines = m.t["lineitem"].select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_tax", F.col("l_shipdate").cast("date").alias("day"), F.lit("db").alias("src")
    )
    rules = [
        quality.Rule("part_known", "", "l_partkey", "", quality.ExistsIn(m.t["part"].filter("p_size <= 40"), "p_partkey")),
        quality.Rule("not_future", "", "day", "", F.col("day") > F.lit("2001-01-01").cast("date")),
        quality.Rule("taxed", "", "l_linenumber", "", F.col("l_tax") == 0),
    ]
    log = quality.violations(lines, rules, m.run_ts, "l_orderkey", "src")
    return log.groupBy("rule_name", "field_value").agg(F.count(F.lit(1)).alias("violations"))


@query(
    "section_rule_log",
    with_models(
        """SELECT _source_system AS source_system, student_id AS record_id, section_id AS field_value,
                  'section_exists_for_enrollment' AS rule_name
           FROM section_memberships WHERE section_id NOT IN (SELECT section_id FROM int_sections)"""
    ),
)
def section_rule_log(m: Model) -> DataFrame:
    rules = k12.section_rules(m.table["dim_section"])
    log = quality.violations(m.table["section_memberships"], rules, m.run_ts, "student_id")
    return log.select("source_system", "record_id", "field_value", "rule_name")


@query(
    "grade_course_violations",
    with_models(
        """SELECT a.student_id AS record_id, a.grade_level || ' in ' || s.course_name AS field_value, count(*) AS times
           FROM section_enrollments a JOIN int_sections s USING (section_id) JOIN dim_school c ON s.school_id = c.school_id
           WHERE a.grade_level BETWEEN 0 AND 5 AND (s.course_name ILIKE '%AP %' OR c.school_type = 'High') GROUP BY ALL"""
    ),
)
def grade_course_violations(m: Model) -> DataFrame:
    enrolled = k12.section_enrollments(m.xml, m.csv)
    log = k12.grade_course_violations(enrolled, m.table["dim_section"], m.table["dim_school"], m.run_ts)
    return log.groupBy("record_id", "field_value").agg(F.count(F.lit(1)).alias("times"))


# --- mastery reports ---------------------------------------------------------------------

# All standards of the bound tables: one for each line number, one for each event type.
_HEAT = [*(f"STD-{k}" for k in range(1, 8)), "click", "error", "purchase", "signup", "view"]


@query(
    "mastery_heatmap",
    with_models(
        "SELECT student_id, "
        + ", ".join(f"max(max_score_to_date) FILTER (WHERE standard_code = '{s}') AS \"{s}\"" for s in _HEAT)
        + " FROM latest GROUP BY student_id"
    ),
)
def mastery_heatmap(m: Model) -> DataFrame:
    return analytics.heatmap(latest(m), "student_id", "standard_code", _HEAT)


@query(
    "mastery_at_latest_date",
    with_models(
        """SELECT f.student_id, f.standard_code, f.date_key, f.max_score_to_date, f.mastery_level
           FROM fact_student_mastery_daily f JOIN (
             SELECT student_id, standard_code, max(date_key) AS d FROM fact_student_mastery_daily GROUP BY ALL) t
           ON f.student_id = t.student_id AND f.standard_code = t.standard_code AND f.date_key = t.d"""
    ),
)
def mastery_at_latest_date(m: Model) -> DataFrame:
    rows = m.table["fact_student_mastery_daily"].select(*k12.MASTERY_KEYS, "date_key", "max_score_to_date", "mastery_level")
    return mastery.rows_at_latest(rows, k12.MASTERY_KEYS, "date_key")


@query(
    "mastery_level_share",
    with_models(
        """SELECT mastery_level, count(*) AS count, round(count(*) / (SELECT count(*) FROM latest), 9) AS share
           FROM latest GROUP BY mastery_level"""
    ),
)
def mastery_level_share(m: Model) -> DataFrame:
    return rounded(analytics.level_share(latest(m)), "share")


@query(
    "mastery_level_matrix",
    with_models(
        "SELECT standard_code, "
        + ", ".join(f"count(*) FILTER (WHERE mastery_level = '{v}') AS \"{v}\"" for v in x.MASTERY_LEVELS)
        + " FROM latest GROUP BY standard_code"
    ),
)
def mastery_level_matrix(m: Model) -> DataFrame:
    return analytics.level_matrix(latest(m), "standard_code")


@query(
    "score_histogram",
    with_models(
        """SELECT standard_code, floor(score / 10) * 10 AS bin_start, count(*) AS count
           FROM fact_student_mastery_daily GROUP BY ALL"""
    ),
)
def score_histogram(m: Model) -> DataFrame:
    return analytics.score_histogram(m.table["fact_student_mastery_daily"], "score", 10, ["standard_code"])


@query(
    "standards_kpis",
    with_models(
        """SELECT count(*) AS standards_tracked, round(avg(s), 9) AS avg_mastery_pct,
                  count(*) FILTER (WHERE s >= 0.7) AS standards_meeting_target,
                  (SELECT count(DISTINCT student_id) FROM latest) AS students_assessed
           FROM (SELECT standard_code, avg(CASE WHEN mastery_level IN ('Meeting', 'Exceeding') THEN 1.0 ELSE 0.0 END) AS s
                 FROM latest GROUP BY standard_code) r"""
    ),
)
def standards_kpis(m: Model) -> DataFrame:
    return rounded(analytics.standards_kpis(latest(m), "student_id", "standard_code"), "avg_mastery_pct")


@query(
    "hardest_standard",
    with_models(
        """SELECT standard_code, count(*) FILTER (WHERE mastery_level NOT IN ('Meeting', 'Exceeding')) AS students_below
           FROM latest GROUP BY standard_code ORDER BY students_below DESC, standard_code LIMIT 1"""
    ),
)
def hardest_standard(m: Model) -> DataFrame:
    return analytics.hardest_item(latest(m), "standard_code")


@query(
    "mastery_with_school",
    with_models(
        """SELECT school_id, standard_code, mastery_level, count(*) AS rows, max(assessment_count) AS most,
                  round(avg(max_score_to_date), 9) AS avg_score
           FROM fact_student_mastery_daily JOIN (SELECT DISTINCT student_id, school_id FROM int_enrollments) e USING (student_id)
           GROUP BY ALL"""
    ),
)
def mastery_with_school(m: Model) -> DataFrame:
    """The fact per school of enrolment, summed up by school, standard and level."""
    out = k12.mastery_with_school(m.table["fact_student_mastery_daily"], m.table["int_enrollments"])
    return out.groupBy("school_id", "standard_code", "mastery_level").agg(
        F.count(F.lit(1)).alias("rows"),
        F.max("assessment_count").alias("most"),
        F.round(F.avg("max_score_to_date"), 9).alias("avg_score"),
    )


# --- districts and curriculum -----------------------------------------------------------------

_GAPS = """
    SELECT standard_code, arg_min(district_id, (-mastery_pct, district_id)) AS leader,
           arg_min(district_id, (mastery_pct, district_id)) AS trailer, max(mastery_pct) AS best, min(mastery_pct) AS worst,
           max(mastery_pct) - min(mastery_pct) AS gap, max(mastery_pct) - min(mastery_pct) > 0.1 AS flagged
    FROM (SELECT * REPLACE (round(mastery_pct, 9) AS mastery_pct) FROM agg_district_comparison) c GROUP BY standard_code"""


def _gaps(m: Model) -> DataFrame:
    comparison = rounded(m.table["agg_district_comparison"], "mastery_pct")
    return analytics.group_gap(comparison, "standard_code", "district_id")


@query(
    "district_gap",
    with_models(f"SELECT standard_code, leader, trailer, best, worst, round(gap, 9) AS gap, flagged FROM ({_GAPS}) g"),
)
def district_gap(m: Model) -> DataFrame:
    return rounded(_gaps(m), "gap")


@query(
    "district_leaders",
    with_models(f"SELECT leader, count(*) AS items_led FROM ({_GAPS}) g WHERE gap > 0 GROUP BY leader"),
)
def district_leaders(m: Model) -> DataFrame:
    return analytics.leaders(_gaps(m))


_LIFT = """
    SELECT standard_code, count(*) FILTER (WHERE curriculum_version = 'A') AS "students_A",
           avg(CASE WHEN mastery_level IN ('Meeting', 'Exceeding') THEN 1.0 ELSE 0.0 END)
             FILTER (WHERE curriculum_version = 'A') AS "mastery_A",
           count(*) FILTER (WHERE curriculum_version = 'B') AS "students_B",
           avg(CASE WHEN mastery_level IN ('Meeting', 'Exceeding') THEN 1.0 ELSE 0.0 END)
             FILTER (WHERE curriculum_version = 'B') AS "mastery_B"
    FROM latest JOIN dim_standard d USING (standard_code)
    JOIN (SELECT DISTINCT student_id, subject, curriculum_version FROM section_memberships JOIN dim_section USING (section_id)
          WHERE curriculum_version IN ('A', 'B')) t
      ON t.student_id = latest.student_id AND t.subject = d.subject
    GROUP BY standard_code"""


def _lift(m: Model) -> DataFrame:
    return analytics.version_lift(latest(m), m.table["dim_section"], m.table["section_memberships"], m.table["dim_standard"])


@query(
    "curriculum_lift",
    with_models(
        f"""SELECT standard_code, "students_A", round("mastery_A", 9) AS "mastery_A", "students_B",
                   round("mastery_B", 9) AS "mastery_B", round("mastery_A" - "mastery_B", 9) AS lift FROM ({_LIFT}) v"""
    ),
)
def curriculum_lift(m: Model) -> DataFrame:
    return rounded(_lift(m), "mastery_A", "mastery_B", "lift")


@query(
    "better_curriculum",
    with_models(
        f"""SELECT count(*) FILTER (WHERE l > 0) AS "items_ahead_A", count(*) FILTER (WHERE l < 0) AS "items_ahead_B",
                   round(avg(l), 9) AS avg_lift FROM (SELECT "mastery_A" - "mastery_B" AS l FROM ({_LIFT}) v) r"""
    ),
)
def better_curriculum(m: Model) -> DataFrame:
    return rounded(analytics.better_version(_lift(m)), "avg_lift")


@query(
    "enrolment_summary",
    with_models(
        """SELECT d.district_id, count(DISTINCT student_id) AS students,
                  round(avg((CASE WHEN birth_year IS NOT NULL THEN 1.0 ELSE 0.0 END
                             + CASE WHEN grade_level IS NOT NULL THEN 1.0 ELSE 0.0 END) / 2), 9) AS completeness,
                  any_value(n.schools) AS schools, any_value(n.sections) AS sections
           FROM members d JOIN (
             SELECT district_id, count(DISTINCT c.school_id) AS schools, count(DISTINCT s.section_id) AS sections
             FROM dim_school c LEFT JOIN dim_section s ON s.school_id = c.school_id GROUP BY district_id) n
             ON n.district_id = d.district_id
           GROUP BY d.district_id"""
    ),
)
def enrolment_summary(m: Model) -> DataFrame:
    rows = k12.members(m.table["dim_student"], m.table["dim_school"])
    out = analytics.enrolment_summary(
        rows, m.table["dim_school"], m.table["dim_section"], ["birth_year", "grade_level"]
    )
    return rounded(out, "completeness")


@query(
    "enrolment_by_grade",
    with_models("SELECT district_id, grade_level, count(*) AS rows FROM members GROUP BY ALL"),
)
def enrolment_by_grade(m: Model) -> DataFrame:
    return analytics.enrolment_by_grade(k12.members(m.table["dim_student"], m.table["dim_school"]))


@query(
    "wide_student",
    with_models(
        f"""SELECT s.student_id, s.first_name_hash, s.last_name_hash, s.email_hash, s.birth_year, e.school_id, e.grade_level,
                   c.district_id, '' || TRY_CAST(e.enrollment_start_date AS DATE) AS enrollment_start_date,
                   coalesce(TRY_CAST(e.enrollment_start_date AS DATE) <= DATE '{b.AS_OF}', false) AS is_active, s._source_system
            FROM int_students s LEFT JOIN int_enrollments e USING (student_id) LEFT JOIN dim_school c ON e.school_id = c.school_id"""
    ),
)
def wide_student(m: Model) -> DataFrame:
    out = k12.wide_student(m.table["int_students"], m.table["int_enrollments"], m.table["dim_school"], m.as_of)
    return out.withColumn("enrollment_start_date", F.col("enrollment_start_date").cast("string"))


@query(
    "students_in_both_sources",
    with_models(
        """SELECT email_hash, count(DISTINCT _source_system) AS sources, count(*) AS rows FROM int_students
           WHERE email_hash IS NOT NULL GROUP BY email_hash HAVING count(DISTINCT _source_system) > 1"""
    ),
)
def students_in_both_sources(m: Model) -> DataFrame:
    """The same person in both sources, by the hash of the address."""
    return shared_values(m.table["int_students"], "email_hash", "_source_system")


# --- responses --------------------------------------------------------------------------------

_HITS = """SELECT * FROM fact_assessment_responses WHERE misconception_tag IS NOT NULL AND NOT is_correct"""


@query(
    "misconception_clusters",
    with_models(
        f"""SELECT r.standard_code, r.misconception_tag, p.description AS misconception_description, p.suggested_reteach,
                   count(DISTINCT r.student_id) AS affected_students, count(*) AS total_occurrences
            FROM ({_HITS}) r JOIN dim_misconception_pattern p ON r.misconception_tag = p.pattern_label GROUP BY ALL"""
    ),
)
def misconception_clusters(m: Model) -> DataFrame:
    return responses.misconception_clusters(m.table["fact_assessment_responses"], m.table["dim_misconception_pattern"])


@query(
    "most_common_misconception",
    with_models(
        f"""SELECT standard_code, misconception_tag, count(DISTINCT student_id) AS affected_students, count(*) AS total_occurrences
            FROM ({_HITS}) r GROUP BY ALL ORDER BY affected_students DESC, standard_code, misconception_tag LIMIT 1"""
    ),
)
def most_common_misconception(m: Model) -> DataFrame:
    return responses.misconception_clusters(m.table["fact_assessment_responses"]).limit(1)


@query(
    "accuracy_by_standard",
    with_models(
        """SELECT standard_code, count(is_correct) AS answered, round(avg(CAST(is_correct AS INTEGER)), 9) AS accuracy
           FROM fact_assessment_responses GROUP BY standard_code"""
    ),
)
def accuracy_by_standard(m: Model) -> DataFrame:
    return rounded(responses.accuracy(m.table["fact_assessment_responses"]), "accuracy")


@query(
    "wrong_answers",
    with_models(
        """SELECT standard_code, correct_answer, student_answer, count(*) AS responses, count(misconception_tag) AS pattern_hits
           FROM fact_assessment_responses WHERE NOT is_correct GROUP BY ALL"""
    ),
)
def wrong_answers(m: Model) -> DataFrame:
    return responses.wrong_answers(m.table["fact_assessment_responses"])


@query(
    "reteach_table",
    with_models("SELECT standard_code, pattern_label, suggested_reteach FROM dim_misconception_pattern"),
)
def reteach_table(m: Model) -> DataFrame:
    return responses.reteach_table(m.table["dim_misconception_pattern"])


@query(
    "misconception_kpis",
    with_models(
        """SELECT count(DISTINCT misconception_id) AS misconceptions_cataloged,
                  count(DISTINCT wrong_answer_pattern) AS wrong_answer_patterns,
                  count(DISTINCT suggested_reteach) AS reteach_strategies,
                  (SELECT count(DISTINCT student_id) FROM fact_assessment_responses WHERE misconception_tag IS NOT NULL)
                    AS students_affected FROM dim_misconception_pattern"""
    ),
)
def misconception_kpis(m: Model) -> DataFrame:
    return responses.misconception_kpis(m.table["fact_assessment_responses"], m.table["dim_misconception_pattern"])


# --- prerequisites ------------------------------------------------------------------------------


@query(
    "prerequisite_failures",
    with_models(
        """SELECT f.standard_code, d.prerequisite_standard_code, count(*) AS failing, count(g.student_id) AS also_failing_prerequisite,
                  round(count(g.student_id) / count(*), 9) AS share,
                  CASE WHEN count(g.student_id) / count(*) > 0.5 THEN 'Reteach the prerequisite first'
                       ELSE 'Reteach the standard' END AS recommendation
           FROM (SELECT * FROM latest WHERE max_score_to_date < 90) f JOIN dim_standard d USING (standard_code)
           LEFT JOIN (SELECT * FROM latest WHERE max_score_to_date < 90) g
             ON g.student_id = f.student_id AND g.standard_code = d.prerequisite_standard_code
           WHERE d.prerequisite_standard_code IS NOT NULL GROUP BY ALL"""
    ),
)
def prerequisite_failures(m: Model) -> DataFrame:
    out = analytics.prerequisite_failures(latest(m), m.table["dim_standard"], below=90.0)
    return rounded(out, "share")


@query(
    "prerequisite_chains",
    with_models(
        """, t(item, ancestor, depth) AS (
             SELECT standard_code, prerequisite_standard_code, 1 FROM dim_standard WHERE prerequisite_standard_code IS NOT NULL
             UNION ALL SELECT t.item, d.prerequisite_standard_code, t.depth + 1 FROM t JOIN dim_standard d
               ON t.ancestor = d.standard_code WHERE d.prerequisite_standard_code IS NOT NULL)
           SELECT item, ancestor, depth FROM t"""
    ),
)
def prerequisite_chains(m: Model) -> DataFrame:
    return analytics.ancestors(m.table["dim_standard"], "standard_code", "prerequisite_standard_code")


# --- risk and attendance ----------------------------------------------------------------------------


@query(
    "watch_list",
    with_models(
        """SELECT * REPLACE (round(avg_mastery_score, 9) AS avg_mastery_score, round(attendance_rate, 9) AS attendance_rate),
                  CASE risk_level WHEN 'High' THEN 'Immediate intervention' ELSE 'Monitor and support' END AS recommended_action
           FROM agg_early_warning WHERE risk_level <> 'Low'"""
    ),
)
def watch_list(m: Model) -> DataFrame:
    return rounded(analytics.watch_list(m.table["agg_early_warning"]), "avg_mastery_score", "attendance_rate")


@query(
    "risk_distribution",
    with_models("SELECT risk_level, count(*) AS count FROM agg_early_warning GROUP BY risk_level"),
)
def risk_distribution(m: Model) -> DataFrame:
    return analytics.risk_distribution(m.table["agg_early_warning"])


@query(
    "early_warning_kpis",
    with_models(
        """SELECT count(*) FILTER (WHERE risk_level IN ('High', 'Medium')) AS at_risk,
                  round(avg(attendance_rate), 9) AS avg_attendance_rate,
                  count(*) FILTER (WHERE declining_trend) AS declining_trends,
                  (SELECT count(DISTINCT school_id) FROM dim_student) AS schools_represented FROM agg_early_warning"""
    ),
)
def early_warning_kpis(m: Model) -> DataFrame:
    return rounded(analytics.warning_kpis(m.table["agg_early_warning"], m.table["dim_student"]), "avg_attendance_rate")


@query(
    "dual_risk_students",
    with_models("SELECT count(*) AS dual_risk FROM agg_early_warning WHERE attendance_rate < 0.8 AND avg_mastery_score < 60"),
)
def dual_risk_students(m: Model) -> DataFrame:
    return analytics.dual_risk(m.table["agg_early_warning"])


@query(
    "attendance_status",
    with_models(
        """SELECT status, count(*) AS count, round(count(*) / (SELECT count(*) FROM fact_attendance_daily), 9) AS share
           FROM fact_attendance_daily GROUP BY status"""
    ),
)
def attendance_status(m: Model) -> DataFrame:
    return rounded(analytics.status_distribution(m.table["fact_attendance_daily"]), "share")


@query(
    "attendance_status_by_school",
    with_models(
        """SELECT school_id, status, count(*) AS count, round(count(*) / sum(count(*)) OVER (PARTITION BY school_id), 9) AS share
           FROM fact_attendance_daily GROUP BY school_id, status"""
    ),
)
def attendance_status_by_school(m: Model) -> DataFrame:
    return rounded(analytics.status_distribution(m.table["fact_attendance_daily"], ["school_id"]), "share")


@query(
    "instructional_groups",
    with_models(
        """SELECT w.risk_level, w.student_id, round(w.attendance_rate, 9) AS attendance_rate,
                  round(w.avg_mastery_score, 9) AS avg_mastery_score, a.domain AS primary_weakness
           FROM agg_early_warning w LEFT JOIN (
             SELECT student_id, domain, row_number() OVER (PARTITION BY student_id ORDER BY m, domain) AS rn FROM (
               SELECT student_id, domain, avg(max_score_to_date) AS m FROM latest JOIN dim_standard USING (standard_code)
               WHERE domain IS NOT NULL GROUP BY ALL) r) a
             ON a.student_id = w.student_id AND a.rn = 1"""
    ),
)
def instructional_groups(m: Model) -> DataFrame:
    out = analytics.instructional_groups(m.table["agg_early_warning"], latest(m), m.table["dim_standard"])
    return rounded(out, "attendance_rate", "avg_mastery_score")


# --- overview, drill-down -------------------------------------------------------------------------------


@query(
    "overview_kpis",
    with_models(
        """SELECT students, schools, standards, quarantined, at_risk,
                  round((1 - quarantined / greatest(students + quarantined, 1)) * 100, 1) AS pass_rate,
                  round(at_risk * 100 / students, 1) AS at_risk_pct
           FROM (SELECT (SELECT count(*) FROM dim_student) AS students, (SELECT count(DISTINCT school_id) FROM dim_school) AS schools,
                        (SELECT count(DISTINCT standard_code) FROM dim_standard) AS standards,
                        (SELECT count(*) FROM fact_dq_quarantine_log) AS quarantined,
                        (SELECT count(*) FROM agg_early_warning WHERE risk_level IN ('High', 'Medium')) AS at_risk) n"""
    ),
)
def overview_kpis(m: Model) -> DataFrame:
    return analytics.overview(
        m.table["dim_student"],
        m.table["dim_school"],
        m.table["dim_standard"],
        m.table["fact_dq_quarantine_log"],
        m.table["agg_early_warning"],
    )


_GOLD = (
    "dim_student", "dim_school", "dim_section", "dim_standard", "dim_misconception_pattern", "fact_student_mastery_daily",
    "fact_assessment_responses", "fact_attendance_daily", "agg_early_warning", "agg_district_comparison",
)


@query(
    "layer_counts",
    with_models(
        "SELECT 'silver' AS layer, "
        + " + ".join(f"(SELECT count(*) FROM x_{n})" for n in XML_ENTITIES)
        + " + "
        + " + ".join(f"(SELECT count(*) FROM c_{n})" for n in CSV_ENTITIES)
        + " AS rows UNION ALL SELECT 'gold', "
        + " + ".join(f"(SELECT count(*) FROM {n})" for n in _GOLD)
        + " UNION ALL SELECT 'quarantined', count(*) FROM fact_dq_quarantine_log"
    ),
)
def layer_counts(m: Model) -> DataFrame:
    silver = {f"{XML_SOURCE}.{n}": m.silver(XML_SOURCE, n) for n in XML_ENTITIES}
    silver |= {f"{CSV_SOURCE}.{n}": m.silver(CSV_SOURCE, n) for n in CSV_ENTITIES}
    return analytics.layer_counts(
        {"silver": silver, "gold": {n: m.table[n] for n in _GOLD}, "quarantined": {"log": m.table["fact_dq_quarantine_log"]}}
    )


_PLACED = """SELECT l.*, p.district_name, p.school_id, p.grade_level FROM latest l JOIN members p USING (student_id)"""
_MEASURES = """count(DISTINCT student_id) AS students, round(avg(max_score_to_date), 9) AS avg_score"""


def _placed(m: Model) -> DataFrame:
    places = k12.members(m.table["dim_student"], m.table["dim_school"]).select(
        F.col("student_id").alias("__s"), "district_name", "school_id", "grade_level"
    )
    return latest(m).join(places, F.col("student_id") == F.col("__s"), "inner").drop("__s")


def _measures() -> dict:
    return {"students": F.count_distinct("student_id"), "avg_score": F.round(F.avg("max_score_to_date"), 9)}


@query("drilldown_districts", with_models(f"SELECT district_name, {_MEASURES} FROM ({_PLACED}) p GROUP BY district_name"))
def drilldown_districts(m: Model) -> DataFrame:
    return analytics.drilldown(_placed(m), "district", _measures())


@query(
    "drilldown_schools_of_district",
    with_models(f"SELECT school_id, {_MEASURES} FROM ({_PLACED}) p WHERE district_name = 'ASIA' GROUP BY school_id"),
)
def drilldown_schools_of_district(m: Model) -> DataFrame:
    return analytics.drilldown(_placed(m), "school", _measures(), district="ASIA")


@query(
    "drilldown_students_of_grade",
    with_models(
        f"""SELECT student_id, {_MEASURES} FROM ({_PLACED}) p
            WHERE district_name = 'ASIA' AND grade_level = 1 GROUP BY student_id"""
    ),
)
def drilldown_students_of_grade(m: Model) -> DataFrame:
    return analytics.drilldown(_placed(m), "student", _measures(), district="ASIA", grade=1)


@query(
    "drilldown_levels",
    with_models(
        """SELECT level, district_name, school_id, grade_level, section_id, CASE WHEN level = 'student' THEN student_id END AS student_id,
                  count(DISTINCT s) AS students, round(avg(max_score_to_date), 9) AS avg_score FROM (
             SELECT l.max_score_to_date, p.student_id AS s, p.student_id, v.level, CASE WHEN v.depth < 5 THEN p.district_name END AS district_name,
                    CASE WHEN v.depth IN (2, 3, 4) THEN p.school_id END AS school_id,
                    CASE WHEN v.depth IN (3, 4) THEN p.grade_level END AS grade_level, CASE WHEN v.depth = 4 THEN x.section_id END AS section_id
             FROM latest l JOIN members p USING (student_id) JOIN section_memberships x USING (student_id),
                  (VALUES (1, 'district'), (2, 'school'), (3, 'grade'), (4, 'section'), (5, 'student')) v(depth, level)) r
           GROUP BY ALL"""
    ),
)
def drilldown_levels(m: Model) -> DataFrame:
    """Every level from district to student, over the sections that students attend."""
    places = k12.members(m.table["dim_student"], m.table["dim_school"]).select("student_id", "district_name", "school_id", "grade_level")
    sections = m.table["section_memberships"].select("student_id", "section_id")
    return rounded(analytics.drilldown_levels(latest(m), places, inner=sections), "avg_score")


@query(
    "masking_table",
    with_models(
        """SELECT v.field, v.classification, v.method, v.layer, n.students FROM (VALUES
             ('first_name', 'direct identifier', 'SHA-256 hash', 'silver'), ('last_name', 'direct identifier', 'SHA-256 hash', 'silver'),
             ('email', 'direct identifier', 'SHA-256 hash', 'silver'),
             ('birth_date', 'quasi identifier', 'generalised to birth year', 'silver')) v(field, classification, method, layer),
             (SELECT count(*) AS students FROM dim_student) n"""
    ),
)
def masking_table(m: Model) -> DataFrame:
    """How each personal field of the student table is masked, with the rows it covers."""
    rows = m.table["dim_student"]
    masked = {"birth_date": "birth_year"}
    fields = [F.lit(f) for f in pii.MASKING if masked.get(f, f"{f}_hash") in rows.columns]
    covered = rows.select(F.explode(F.array(*fields)).alias("field")).groupBy("field").agg(F.count(F.lit(1)).alias("students"))
    return pii.masking_table(rows).join(covered, "field")
