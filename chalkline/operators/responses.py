"""Item responses: correctness, misconception tags and what is made of them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chalkline.functions import exprs as x


def tag_with_patterns(
    responses: DataFrame,
    patterns: DataFrame,
    on: dict[str, str],
    expected: str = "correct_answer",
    actual: str = "student_answer",
    take: dict[str, str] | None = None,
) -> DataFrame:
    """``is_correct`` (NULL when an answer is missing) and the matching pattern of wrong answers.

    ``on`` maps response columns to pattern columns.  Patterns join only to
    answers that are given and wrong.
    """
    take = take or {
        "misconception_tag": "pattern_label",
        "misconception_description": "description",
        "suggested_reteach": "suggested_reteach",
    }
    table = patterns.select(
        *[F.col(p).alias(f"__p_{i}") for i, p in enumerate(on.values())],
        *[F.col(src).alias(name) for name, src in take.items()],
    )
    same = [F.col(r) == F.col(f"__p_{i}") for i, r in enumerate(on)]
    joined = responses.join(table, [*same, F.col(actual) != F.col(expected)], "left")
    return joined.drop(*[f"__p_{i}" for i in range(len(on))]).withColumn("is_correct", F.col(actual) == F.col(expected))


def misconception_clusters(
    tagged: DataFrame, patterns: DataFrame | None = None, student: str = "student_id", item: str = "standard_code"
) -> DataFrame:
    """Students affected and occurrences per (item, tag), largest first.

    ``patterns`` adds one row per pattern carrying the tag, as the report does.
    """
    hits = tagged.filter(F.col("misconception_tag").isNotNull() & ~F.col("is_correct"))
    clusters = hits.groupBy(item, "misconception_tag").agg(
        F.count_distinct(student).alias("affected_students"), F.count(F.lit(1)).alias("total_occurrences")
    )
    if patterns is not None:
        notes = patterns.groupBy(F.col("pattern_label").alias("__tag"), "description", "suggested_reteach").agg(
            F.count(F.lit(1)).alias("__copies")
        )
        clusters = clusters.join(notes, F.col("misconception_tag") == F.col("__tag"), "inner").select(
            item,
            "misconception_tag",
            F.col("description").alias("misconception_description"),
            "suggested_reteach",
            "affected_students",
            (F.col("total_occurrences") * F.col("__copies")).alias("total_occurrences"),
        )
    return clusters.orderBy(F.desc("affected_students"), item, "misconception_tag")


def accuracy(tagged: DataFrame, item: str = "standard_code") -> DataFrame:
    """Share of right answers per item, lowest first; unanswered items do not count."""
    rates = tagged.groupBy(item).agg(
        F.count("is_correct").alias("answered"), F.avg(F.col("is_correct").cast("double")).alias("accuracy")
    )
    return rates.orderBy(F.asc_nulls_last("accuracy"), item)


def wrong_answers(
    tagged: DataFrame, keys: Sequence[str] = ("standard_code",), expected: str = "correct_answer", actual: str = "student_answer"
) -> DataFrame:
    """How often each wrong answer was given, and how many of those carry a tag."""
    wrong = tagged.filter(~F.col("is_correct"))
    return wrong.groupBy(*keys, expected, actual).agg(
        F.count(F.lit(1)).alias("responses"), F.count("misconception_tag").alias("pattern_hits")
    )


def reteach_table(patterns: DataFrame) -> DataFrame:
    return patterns.select("standard_code", "pattern_label", "suggested_reteach")


def misconception_kpis(tagged: DataFrame, patterns: DataFrame, student: str = "student_id") -> DataFrame:
    """Patterns cataloged, wrong-answer patterns, students affected, reteach strategies."""
    catalog = patterns.agg(
        F.count_distinct("misconception_id").alias("misconceptions_cataloged"),
        F.count_distinct("wrong_answer_pattern").alias("wrong_answer_patterns"),
        F.count_distinct("suggested_reteach").alias("reteach_strategies"),
    )
    affected = tagged.filter(F.col("misconception_tag").isNotNull()).agg(
        F.count_distinct(student).alias("students_affected")
    )
    return side_by_side(catalog, affected)


def side_by_side(*frames: DataFrame) -> DataFrame:
    """One-row aggregates as the columns of one row, without a join."""
    names = [c for frame in frames for c in frame.columns]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in names])
