"""Column -> Column expressions, built-in functions only."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Grade words and their levels.
GRADE_WORDS = {
    "kindergarten": 0,
    "k": 0,
    "pk": 0,
    "first grade": 1,
    "second grade": 2,
    "third grade": 3,
    "fourth grade": 4,
    "fifth grade": 5,
    "sixth grade": 6,
    "seventh grade": 7,
    "eighth grade": 8,
    "ninth grade": 9,
    "freshman": 9,
    "tenth grade": 10,
    "sophomore": 10,
    "eleventh grade": 11,
    "junior": 11,
    "twelfth grade": 12,
    "senior": 12,
}

# Mastery bands, highest floor first.
MASTERY_BANDS = ((90.0, "Exceeding"), (70.0, "Meeting"), (50.0, "Developing"))
MASTERY_FLOOR = "Needs Intervention"
MASTERY_LEVELS = ("Exceeding", "Meeting", "Developing", "Needs Intervention")
MASTERED = ("Meeting", "Exceeding")

# Risk rule.
RISK_LEVELS = ("High", "Medium", "Low")
BELOW_SCORE = 50.0
ATTENDANCE_FLOOR = 0.90

# Subject words looked for in course titles, first match wins.
SUBJECTS = ("Math", "ELA", "Science")


def _as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_grade(raw: Column | str) -> Column:
    """Grade words (any case, untrimmed) or digit strings to an int level; anything else NULL."""
    raw = _as_column(raw)
    words = F.create_map(*[F.lit(x) for pair in GRADE_WORDS.items() for x in pair])
    digits = F.when(raw.rlike(r"\A[0-9]+\z"), raw.try_cast("int"))
    return F.coalesce(F.try_element_at(words, F.lower(raw)), digits)


def grade_label(level: Column | str) -> Column:
    """0 -> 'Kindergarten', n -> 'Grade n'."""
    level = _as_column(level)
    return F.when(level == 0, F.lit("Kindergarten")).otherwise(F.concat(F.lit("Grade "), level.cast("string")))


def band(value: Column | str, floors: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first floor that ``value`` reaches; ``otherwise`` below all (and for NULL)."""
    value = _as_column(value)
    return F.coalesce(*[F.when(value >= F.lit(float(floor)), F.lit(label)) for floor, label in floors], F.lit(otherwise))


def mastery_level(score: Column | str) -> Column:
    return band(score, MASTERY_BANDS, MASTERY_FLOOR)


def risk_level(
    below: Column | str,
    rate: Column | str,
    floor: float = ATTENDANCE_FLOOR,
    high: int = 3,
    medium: int = 2,
) -> Column:
    """High needs both signals, Medium either one, else Low."""
    below, low_rate = _as_column(below), _as_column(rate) < F.lit(float(floor))
    return (
        F.when((below >= high) & low_rate, F.lit("High"))
        .when((below >= medium) | low_rate, F.lit("Medium"))
        .otherwise(F.lit("Low"))
    )


def declined(recent: Column | str, early: Column | str) -> Column:
    """True only when both averages exist and the recent one is lower."""
    return F.coalesce(_as_column(recent) < _as_column(early), F.lit(False))


def hashed(c: Column | str, canonical: bool = False) -> Column:
    """SHA-256 hex of the text, optionally of its trimmed lower-case form; NULL stays NULL."""
    text = _as_column(c).cast("string")
    return F.sha2(F.lower(F.trim(text)) if canonical else text, 256)


def birth_year(c: Column | str) -> Column:
    return F.year(_as_column(c).try_cast("date"))


def subject_of(title: Column | str, words: Sequence[str] = SUBJECTS, otherwise: str = "Unknown") -> Column:
    """First of ``words`` contained in ``title`` (case-sensitive)."""
    title = _as_column(title)
    return F.coalesce(*[F.when(title.contains(w), F.lit(w)) for w in words], F.lit(otherwise))


def trailing_number(title: Column | str) -> Column:
    """The digits ending ``title`` as an int, else NULL."""
    return F.regexp_extract(_as_column(title), r"(\d+)\z", 1).try_cast("int")


def course_grade(title: Column | str) -> Column:
    """Grade level told by a course title; kindergarten titles carry no number."""
    title = _as_column(title)
    return F.when(title.startswith("Kindergarten") | (title == "Science K"), F.lit(0)).otherwise(trailing_number(title))


def code_part(code: Column | str, part: int, sep: str = "-") -> Column:
    """``part``-th piece of ``code``; '' when there are fewer pieces."""
    return F.split_part(_as_column(code), F.lit(sep), F.lit(part))


def dotted_code(code: Column | str) -> Column:
    """Standard codes in upper-case dotted form."""
    runs = F.regexp_replace(F.trim(_as_column(code)), r"[^A-Za-z0-9]+", ".")
    return F.upper(runs)


def school_year(day: Column | str, first_month: int = 8) -> Column:
    """Calendar year in which the school year of ``day`` began."""
    day = _as_column(day)
    return F.year(day) - F.when(F.month(day) >= first_month, F.lit(0)).otherwise(F.lit(1))


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, NULL for an empty whole."""
    return F.try_divide(part.cast("double"), whole)


def share_of(flag: Column) -> Column:
    """Average of an indicator; NULL flags count as 0."""
    return F.avg(F.when(flag, F.lit(1.0)).otherwise(F.lit(0.0)).cast("double"))


def freshness(age_days: Column, green: int = 1, yellow: int = 7) -> Column:
    return F.when(age_days <= green, F.lit("green")).when(age_days <= yellow, F.lit("yellow")).otherwise(F.lit("red"))


def recommended_action(risk: Column | str) -> Column:
    """What to do for a student of the given risk level."""
    risk = _as_column(risk)
    return F.when(risk == "High", F.lit("Immediate intervention")).when(risk == "Medium", F.lit("Monitor and support")).otherwise(F.lit("None"))


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
