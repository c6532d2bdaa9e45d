"""Mastery, trends, risk and group comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chalkline.functions import exprs as x
from chalkline.operators.joins import lookup
from chalkline.operators.ordered import HOT_ROWS, Scan, ordered_scan


def running_best(
    df: DataFrame,
    keys: Sequence[str],
    date: str,
    value: str,
    tiebreak: Sequence[str] = (),
    floors: Sequence[tuple[float, str]] = x.MASTERY_BANDS,
    otherwise: str = x.MASTERY_FLOOR,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Highest value so far and number of values so far per key, with the band it reaches.

    Values that are NULL or not numbers are left out.  ``tiebreak`` orders rows
    of the same date, so that the result does not depend on the partitioning.
    """
    scored = df.withColumn(value, F.col(value).try_cast("double")).filter(F.col(value).isNotNull())
    scan = Scan(running_max={"max_score_to_date": value}, running_count="assessment_count")
    best = ordered_scan(scored, keys, [date, *tiebreak], scan, hot_rows)
    return best.withColumn("mastery_level", x.band("max_score_to_date", floors, otherwise))


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """The row with the largest ``newest`` tuple per key (NULLs smallest), as an aggregate."""
    rest = [c for c in df.columns if c not in keys]
    top = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*newest)).alias("__row"))
    return top.select(*keys, "__row.*").select(*df.columns)


def rows_at_latest(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """All rows carrying the greatest date of their key."""
    last = df.groupBy(*[F.col(k).alias(f"__k_{k}") for k in keys]).agg(F.max(date).alias("__last"))
    same = [F.col(k) == F.col(f"__k_{k}") for k in keys]
    return df.join(last, [*same, F.col(date) == F.col("__last")], "left_semi")


def latest_mastery(
    mastery: DataFrame,
    keys: Sequence[str],
    floors: Sequence[tuple[float, str]] = x.MASTERY_BANDS,
    otherwise: str = x.MASTERY_FLOOR,
    score: str = "score",
) -> DataFrame:
    """Last state of every key.

    The count grows by one per row and the best never falls, so the last row of
    a key holds its highest score and its number of rows.  That needs no
    ordering, combines before the shuffle, and leaves the running columns of an
    unwritten fact table uncomputed.
    """
    last = mastery.groupBy(*keys).agg(F.max(score).alias("max_score_to_date"), F.count(F.lit(1)).alias("assessment_count"))
    return last.withColumn("mastery_level", x.band("max_score_to_date", floors, otherwise))


def mastery_summary(latest: DataFrame, entity: str, item: str, below: float = x.BELOW_SCORE) -> DataFrame:
    """Per entity: average best, number of items below, items seen.  ``latest`` is unique on (entity, item)."""
    return latest.groupBy(entity).agg(
        F.avg("max_score_to_date").alias("avg_mastery_score"),
        F.count_if(F.col("max_score_to_date") < below).alias("count_below_developing"),
        F.count(item).alias("standards_assessed"),
    )


def halves_trend(
    df: DataFrame, entity: str, order: Sequence[str], value: str = "max_score_to_date", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Average of the first half of an entity's rows against the rest; entities with one row are left out."""
    ranked = ordered_scan(
        df.select(entity, value, *[c for c in order if c not in (entity, value)]),
        [entity],
        order,
        Scan(running_count="__rn", group_size="__total"),
        hot_rows,
    )
    early = F.col("__rn") <= F.col("__total") / 2
    return (
        ranked.filter(F.col("__total") >= 2)
        .groupBy(entity)
        .agg(F.avg(F.when(early, F.col(value))).alias("early_avg"), F.avg(F.when(~early, F.col(value))).alias("recent_avg"))
    )


def ends_trend(
    df: DataFrame, entity: str, value: str = "max_score_to_date", count: str = "assessment_count", width: int = 3
) -> DataFrame:
    """Average at counts 1..width against the last ``width`` counts of the entity.

    Rows are first summed per (entity, count); the entity's top count is joined to those sums.
    """
    sums = df.groupBy(entity, count).agg(F.sum(value).alias("__sum"), F.count(value).alias("__n"))
    top = sums.groupBy(F.col(entity).alias("__entity")).agg(F.max(count).alias("__top"))
    joined = sums.join(top, F.col(entity).eqNullSafe(F.col("__entity")), "inner")

    def mean(cond: Column) -> Column:
        return x.ratio(F.sum(F.when(cond, F.col("__sum"))), F.sum(F.when(cond, F.col("__n"))))

    return joined.groupBy(entity).agg(
        mean(F.col(count) <= width).alias("early_avg"),
        mean(F.col(count) >= F.col("__top") - (width - 1)).alias("recent_avg"),
    )


def attendance_rate(attendance: DataFrame, entity: str, status: str = "status", present: str = "Present") -> DataFrame:
    return attendance.groupBy(entity).agg(
        x.ratio(F.count_if(F.col(status) == present), F.count(F.lit(1))).alias("attendance_rate")
    )


def early_warning(
    mastery: DataFrame,
    attendance: DataFrame,
    entity: str = "student_id",
    item: str = "standard_code",
    date: str = "date_key",
    status: str = "status",
    present: str = "Present",
    below: float = x.BELOW_SCORE,
    floor: float = x.ATTENDANCE_FLOOR,
    high: int = 3,
    medium: int = 2,
    trend: str = "halves",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Risk per entity from best scores, their trend and attendance.

    All three inputs are aggregated to one row per entity before they are
    joined on it.  ``trend`` is ``"halves"`` or ``"ends"``.
    """
    summary = mastery_summary(latest_mastery(mastery, [entity, item]), entity, item, below)
    if trend == "halves":
        trends = halves_trend(mastery, entity, [date, item, "assessment_count"], hot_rows=hot_rows)
    else:
        trends = ends_trend(mastery, entity)
    joined = lookup(summary, trends, entity, ["early_avg", "recent_avg"])
    joined = lookup(joined, attendance_rate(attendance, entity, status, present), entity, {"__rate": "attendance_rate"})
    rate = F.coalesce(F.col("__rate"), F.lit(1.0))
    return joined.select(
        entity,
        "avg_mastery_score",
        rate.alias("attendance_rate"),
        "count_below_developing",
        "standards_assessed",
        x.declined("recent_avg", "early_avg").alias("declining_trend"),
        x.risk_level("count_below_developing", rate, floor, high, medium).alias("risk_level"),
    )


def group_comparison(
    latest: DataFrame,
    entities: DataFrame,
    items: DataFrame,
    entity: str = "student_id",
    item: str = "standard_code",
    groups: Sequence[str] = ("district_id", "district_name"),
    item_take: Sequence[str] = ("subject",),
    levels: Sequence[str] = x.MASTERED,
    dedupe: bool = False,
) -> DataFrame:
    """Entities assessed, average best and share mastered per item and group.

    ``entities`` holds one row per membership, ``latest`` one per (entity,
    item).  Memberships are counted per (entity, group) before the join and used
    as weights, which equals joining every membership row; ``dedupe`` counts
    each entity once.  Item columns are added after the aggregation.
    """
    weight = F.lit(1) if dedupe else F.count(F.lit(1))
    members = (
        entities.filter(F.col(entity).isNotNull())
        .groupBy(F.col(entity).alias("__entity"), *groups)
        .agg(weight.cast("double").alias("__weight"))
    )
    w = F.col("__weight")
    grouped = (
        latest.join(members, F.col(entity) == F.col("__entity"), "inner")
        .groupBy(item, *groups)
        .agg(
            F.count(F.lit(1)).alias("student_count"),
            (F.sum(F.col("max_score_to_date") * w) / F.sum(w)).alias("avg_score"),
            (F.sum(F.when(F.col("mastery_level").isin(*levels), w).otherwise(F.lit(0.0))) / F.sum(w)).alias("mastery_pct"),
        )
    )
    described = lookup(grouped, items.select(item, *item_take).distinct(), item, list(item_take))
    return described.select(item, *item_take, *groups, "student_count", "avg_score", "mastery_pct")


def longest_streak(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    hit: Column,
    name: str = "longest_streak",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Length of the longest run of consecutive ``hit`` rows per key (0 when there is none)."""
    flagged = df.select(*keys, *order, F.when(hit, F.lit(0)).otherwise(F.lit(1)).alias("__miss"))
    islands = ordered_scan(flagged, keys, order, Scan(running_sum={"__island": "__miss"}), hot_rows)
    runs = islands.groupBy(*keys, "__island").agg(F.count_if(F.col("__miss") == 0).alias("__run"))
    return runs.groupBy(*keys).agg(F.max("__run").alias(name))


def falling_best(
    mastery: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str = "max_score_to_date",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Rows whose best is lower than the one before; empty for a right fact table."""
    scanned = ordered_scan(mastery, keys, order, Scan(previous={"prev_max": value}), hot_rows)
    return scanned.filter(F.col("prev_max").isNotNull() & (F.col(value) < F.col("prev_max")))


def best_below_scores(mastery: DataFrame, keys: Sequence[str], score: str = "score", best: str = "max_score_to_date") -> DataFrame:
    """Keys whose final best does not cover all their scores."""
    tops = mastery.groupBy(*keys).agg(F.max(score).alias("top_score"), F.max(best).alias("top_best"))
    return tops.filter(F.col("top_best") < F.col("top_score"))
