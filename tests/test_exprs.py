import hashlib

import pytest
from pyspark.sql import functions as F

from chalkline.functions import exprs as x


@pytest.fixture
def apply(spark):
    def run(make, values, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        return [r.out for r in df.select("i", make("v").alias("out")).orderBy("i").collect()]

    return run


def test_normalize_grade(apply):
    given = ["Kindergarten", "k", "PK", "First grade", "EIGHTH GRADE", "Freshman", "senior", "00", "09", "12"]
    assert apply(x.normalize_grade, given) == [0, 0, 0, 1, 8, 9, 12, 0, 9, 12]
    other = ["Grade 6", "", None, " k ", "12\n", "-1", "99999999999"]
    assert apply(x.normalize_grade, other) == [None] * len(other)


def test_subject_and_grade_of_title(apply):
    titles = ["Kindergarten Math", "Science K", "ELA 3", "Art", "Math 11", None]
    assert apply(x.subject_of, titles) == ["Math", "Science", "ELA", "Unknown", "Math", "Unknown"]
    assert apply(x.course_grade, titles) == [0, 0, 3, None, 11, None]


def test_code_part(apply):
    assert apply(lambda c: x.code_part(c, 3), ["MATH-0-A", "MATH-0", None]) == ["A", "", None]


def test_mastery_bands(apply):
    scores = [90.0, 89.9, 70.0, 69.9, 50.0, 49.9, None]
    assert apply(x.mastery_level, scores, "double") == [
        "Exceeding",
        "Meeting",
        "Meeting",
        "Developing",
        "Developing",
        "Needs Intervention",
        "Needs Intervention",
    ]


def test_risk_bands(spark):
    cases = [(3, 0.89, "High"), (3, 0.95, "Medium"), (0, 0.89, "Medium"), (2, 0.95, "Medium"), (1, 0.90, "Low"), (3, None, "Medium")]
    df = spark.createDataFrame([c[:2] for c in cases], "below int, rate double")
    assert [r[0] for r in df.select(x.risk_level("below", "rate")).collect()] == [c[2] for c in cases]


def test_declined(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (None, 1.0), (1.0, None)], "recent double, early double")
    assert [r[0] for r in df.select(x.declined("recent", "early")).collect()] == [True, False, False, False]


def test_hashes(apply):
    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()

    assert apply(x.hashed, [" Ann ", None]) == [sha(" Ann "), None]
    assert apply(lambda c: x.hashed(c, canonical=True), [" Ann "]) == [sha("ann")]


def test_dates(apply):
    assert apply(x.birth_year, ["2015-03-14", "soon", None]) == [2015, None, None]
    days = ["2025-07-31", "2025-08-01"]
    assert apply(lambda c: x.school_year(F.col(c).cast("date")), days) == [2024, 2025]


def test_labels_and_codes(apply):
    assert apply(x.grade_label, [0, 7, None], "int") == ["Kindergarten", "Grade 7", None]
    assert apply(x.dotted_code, ["ccss math-4 OA.a.1", " CCSS.MATH.K "]) == ["CCSS.MATH.4.OA.A.1", "CCSS.MATH.K"]
    assert apply(lambda c: x.freshness(F.col(c)), [0, 5, 30], "int") == ["green", "yellow", "red"]
