"""Reports on the published tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chalkline.functions import exprs as x
from chalkline.operators.joins import lookup
from chalkline.operators.responses import side_by_side
from chalkline.session import broadcast_upto, materialized

# --- mastery ----------------------------------------------------------------


def heatmap(latest: DataFrame, entity: str, item: str, items: Sequence[str], value: str = "max_score_to_date") -> DataFrame:
    """One row per entity, one column per item; the item list is given, so no extra job finds it."""
    return latest.groupBy(entity).pivot(item, list(items)).agg(F.max(value))


def level_share(latest: DataFrame, level: str = "mastery_level") -> DataFrame:
    """Count and share of each level; the window runs over the few level rows."""
    counts = latest.groupBy(level).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("share", F.col("count") / total)


def level_matrix(latest: DataFrame, item: str, levels: Sequence[str] = x.MASTERY_LEVELS, level: str = "mastery_level") -> DataFrame:
    """Rows per item and level, 0 where there are none."""
    return latest.groupBy(item).agg(*[F.count_if(F.col(level) == v).alias(v) for v in levels])


def score_histogram(df: DataFrame, value: str, width: float, by: Sequence[str] = ()) -> DataFrame:
    """Rows per bin of ``width``, by the lower bound of the bin."""
    low = F.floor(F.col(value) / F.lit(float(width))) * F.lit(float(width))
    return df.filter(F.col(value).isNotNull()).groupBy(*by, low.alias("bin_start")).agg(F.count(F.lit(1)).alias("count"))


def standards_kpis(latest: DataFrame, entity: str, item: str, target: float = 0.7, levels: Sequence[str] = x.MASTERED) -> DataFrame:
    """Items tracked, average share mastered, entities assessed, items reaching the target share."""
    mastered = F.col("mastery_level").isin(*levels)
    per_item = latest.groupBy(item).agg(x.share_of(mastered).alias("__share"))
    items = per_item.agg(
        F.count(item).alias("standards_tracked"),
        F.avg("__share").alias("avg_mastery_pct"),
        F.count_if(F.col("__share") >= target).alias("standards_meeting_target"),
    )
    return side_by_side(items, latest.agg(F.count_distinct(entity).alias("students_assessed")))


def hardest_item(latest: DataFrame, item: str, levels: Sequence[str] = x.MASTERED) -> DataFrame:
    """The item with most entities below mastery (first by name on a tie)."""
    below = latest.groupBy(item).agg(F.count_if(~F.col("mastery_level").isin(*levels)).alias("students_below"))
    return below.orderBy(F.desc("students_below"), item).limit(1)


# --- groups -----------------------------------------------------------------


def group_gap(comparison: DataFrame, item: str, group: str, value: str = "mastery_pct", flag_over: float = 0.10) -> DataFrame:
    """Per item: best and worst group, their distance, and whether it is over the limit.

    Ties go to the first group by name.
    """
    best = F.struct(F.col(value), F.col(group))
    per_item = comparison.filter(F.col(value).isNotNull()).groupBy(item).agg(
        F.min_by(group, F.struct((-F.col(value)).alias("v"), F.col(group))).alias("leader"),
        F.min_by(group, best).alias("trailer"),
        F.max(value).alias("best"),
        F.min(value).alias("worst"),
    )
    gap = F.col("best") - F.col("worst")
    return per_item.withColumns({"gap": gap, "flagged": gap > flag_over})


def leaders(gaps: DataFrame) -> DataFrame:
    """Items led by each group, most first; items without a gap have no leader."""
    led = gaps.filter(F.col("gap") > 0).groupBy("leader").agg(F.count(F.lit(1)).alias("items_led"))
    return led.orderBy(F.desc("items_led"), "leader")


def version_lift(
    latest: DataFrame,
    sections: DataFrame,
    memberships: DataFrame,
    items: DataFrame | None = None,
    entity: str = "student_id",
    item: str = "standard_code",
    versions: tuple[str, str] = ("A", "B"),
    levels: Sequence[str] = x.MASTERED,
) -> DataFrame:
    """Share mastered per item under each curriculum version and the lift of the first.

    An entity counts once per version and subject it is taught in, however many
    sections it attends; with ``items`` only sections of the item's subject count.
    """
    by = ["subject", "curriculum_version"] if items is not None else ["curriculum_version"]
    offered = sections.filter(F.col("curriculum_version").isin(*versions)).select("section_id", *by).distinct()
    taught = (
        memberships.select(F.col(entity).alias("__entity"), "section_id")
        .join(offered, "section_id", "inner")
        .select("__entity", *by)
        .distinct()
    )
    on = [F.col(entity) == F.col("__entity")]
    if items is not None:
        latest = latest.join(items.select(F.col(item).alias("__item"), F.col("subject").alias("__subject")), F.col(item) == F.col("__item"), "inner")
        on.append(F.col("__subject") == F.col("subject"))
    per_item = latest.join(taught, on, "inner").groupBy(item)
    mastered = F.col("mastery_level").isin(*levels)
    columns = []
    for v in versions:
        here = F.col("curriculum_version") == v
        columns.append(F.count_if(here).alias(f"students_{v}"))
        columns.append(F.avg(F.when(here, mastered.cast("double"))).alias(f"mastery_{v}"))
    return per_item.agg(*columns).withColumn("lift", F.col(f"mastery_{versions[0]}") - F.col(f"mastery_{versions[1]}"))


def better_version(lift: DataFrame, versions: tuple[str, str] = ("A", "B")) -> DataFrame:
    """Items on which each version is ahead."""
    return lift.agg(
        F.count_if(F.col("lift") > 0).alias(f"items_ahead_{versions[0]}"),
        F.count_if(F.col("lift") < 0).alias(f"items_ahead_{versions[1]}"),
        F.avg("lift").alias("avg_lift"),
    )


def enrolment_summary(
    members: DataFrame,
    schools: DataFrame,
    sections: DataFrame,
    expected: Sequence[str],
    group: str = "district_id",
    entity: str = "student_id",
) -> DataFrame:
    """Per group: entities, schools, sections and how complete the expected fields are.

    ``members`` already carries the group.
    """
    filled = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("double") for c in expected]) / len(expected)
    per_group = members.groupBy(group).agg(
        F.count_distinct(entity).alias("students"),
        F.avg(filled).alias("completeness"),
    )
    school_counts = schools.groupBy(group).agg(F.count_distinct("school_id").alias("schools"))
    per_school = sections.groupBy("school_id").agg(F.count_distinct("section_id").alias("__sections"))
    places = schools.select(group, "school_id").distinct()
    section_counts = places.join(per_school, "school_id", "inner").groupBy(group).agg(F.sum("__sections").alias("sections"))
    joined = lookup(per_group, school_counts, group, ["schools"])
    joined = lookup(joined, section_counts, group, ["sections"])
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in ("schools", "sections")})


def enrolment_by_grade(members: DataFrame, group: str = "district_id", grade: str = "grade_level") -> DataFrame:
    """Rows of every grade that occurs in a group, NULL among them."""
    return members.groupBy(group, grade).agg(F.count(F.lit(1)).alias("rows"))


# --- prerequisites ----------------------------------------------------------


def prerequisite_failures(
    latest: DataFrame,
    items: DataFrame,
    entity: str = "student_id",
    item: str = "standard_code",
    prerequisite: str = "prerequisite_standard_code",
    below: float = x.BELOW_SCORE,
) -> DataFrame:
    """Of those below on an item, how many were below on its prerequisite too.

    Both sides are unique on (entity, item), so the self join stays one to one.
    """
    failing = latest.filter(F.col("max_score_to_date") < below).select(entity, item)
    links = items.filter(F.col(prerequisite).isNotNull()).select(F.col(item).alias("__item"), prerequisite)
    needed = failing.join(links, F.col(item) == F.col("__item"), "inner").drop("__item")
    also = failing.select(F.col(entity).alias("__entity"), F.col(item).alias("__failed"))
    joined = needed.join(also, [F.col(entity) == F.col("__entity"), F.col(prerequisite) == F.col("__failed")], "left")
    share = x.ratio(F.count("__failed"), F.count(F.lit(1)))
    return joined.groupBy(item, prerequisite).agg(
        F.count(F.lit(1)).alias("failing"),
        F.count("__failed").alias("also_failing_prerequisite"),
        share.alias("share"),
        F.when(share > 0.5, F.lit("Reteach the prerequisite first")).otherwise(F.lit("Reteach the standard")).alias("recommendation"),
    )


def ancestors(items: DataFrame, item: str, parent: str) -> DataFrame:
    """Every (item, ancestor, depth) of the prerequisite links, depth being the shortest way; nothing is its own ancestor.

    Breadth first: each level holds the distinct pairs reached for the first time, so work follows the pairs, not the
    paths, and a cycle ends by itself.  Levels are written to the shared folder, as the next ones read them again.
    """
    links = items.filter(F.col(parent).isNotNull()).select(F.col(item).alias("item"), F.col(parent).alias("ancestor"))
    edges = materialized(links.where("item != ancestor").distinct(), "links")
    level = edges.withColumn("depth", F.lit(1))
    steps = edges.select(F.col("item").alias("ancestor"), F.col("ancestor").alias("next"))
    found = [level]
    while not level.isEmpty():
        further = (
            level.join(steps, "ancestor").select("item", F.col("next").alias("ancestor"), F.col("depth") + 1)
            .toDF("item", "ancestor", "depth").where("item != ancestor").distinct()
        )
        seen = reduce(DataFrame.unionByName, found).select("item", "ancestor")
        level = materialized(further.join(seen, ["item", "ancestor"], "left_anti"), "level")
        found.append(level)
    return reduce(DataFrame.unionByName, found)


# --- risk and attendance ----------------------------------------------------


def watch_list(warning: DataFrame) -> DataFrame:
    """Entities at High or Medium risk with the recommended action."""
    return warning.filter(F.col("risk_level") != "Low").withColumn("recommended_action", x.recommended_action("risk_level"))


def risk_distribution(warning: DataFrame) -> DataFrame:
    return warning.groupBy("risk_level").agg(F.count(F.lit(1)).alias("count"))


def warning_kpis(warning: DataFrame, members: DataFrame) -> DataFrame:
    """At risk, average attendance, declining trends, schools represented."""
    risk = warning.agg(
        F.count_if(F.col("risk_level").isin("High", "Medium")).alias("at_risk"),
        F.avg("attendance_rate").alias("avg_attendance_rate"),
        F.count_if("declining_trend").alias("declining_trends"),
    )
    return side_by_side(risk, members.agg(F.count_distinct("school_id").alias("schools_represented")))


def dual_risk(warning: DataFrame, attendance_under: float = 0.80, mastery_under: float = 60.0) -> DataFrame:
    low = (F.col("attendance_rate") < attendance_under) & (F.col("avg_mastery_score") < mastery_under)
    return warning.agg(F.count_if(low).alias("dual_risk"))


def status_distribution(attendance: DataFrame, by: Sequence[str] = (), status: str = "status") -> DataFrame:
    """Count and share of each status, overall or per group; counted first, then shared out."""
    counts = attendance.groupBy(*by, status).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy(*(by or [F.lit(1)])))
    return counts.withColumn("share", F.col("count") / total)


def instructional_groups(
    warning: DataFrame, latest: DataFrame, items: DataFrame, entity: str = "student_id", item: str = "standard_code", area: str = "domain"
) -> DataFrame:
    """Each entity's risk with the area of its lowest average (first by name on a tie)."""
    by_area = lookup(latest, items, item, [area]).groupBy(entity, area).agg(F.avg("max_score_to_date").alias("__avg"))
    weakest = by_area.filter(F.col(area).isNotNull()).groupBy(entity).agg(
        F.min_by(area, F.struct("__avg", area)).alias("primary_weakness")
    )
    return lookup(
        warning.select("risk_level", entity, "attendance_rate", "avg_mastery_score"), weakest, entity, ["primary_weakness"]
    )


# --- overview, filters, drill-down ------------------------------------------


def row_counts(tables: dict[str, DataFrame], name: str = "table") -> DataFrame:
    """Rows of every table, as one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias(name), "rows") for t, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def layer_counts(layers: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """Rows per layer."""
    parts = [row_counts(tables).select(F.lit(layer).alias("layer"), "rows") for layer, tables in layers.items()]
    return reduce(DataFrame.unionByName, parts).groupBy("layer").agg(F.sum("rows").alias("rows"))


def overview(students: DataFrame, schools: DataFrame, standards: DataFrame, log: DataFrame, warning: DataFrame) -> DataFrame:
    """The headline numbers as one row."""
    numbers = side_by_side(
        students.agg(F.count(F.lit(1)).alias("students")),
        schools.agg(F.count_distinct("school_id").alias("schools")),
        standards.agg(F.count_distinct("standard_code").alias("standards")),
        log.agg(F.count(F.lit(1)).alias("quarantined")),
        warning.agg(F.count_if(F.col("risk_level").isin("High", "Medium")).alias("at_risk")),
    )
    seen = F.greatest(F.col("students") + F.col("quarantined"), F.lit(1))
    return numbers.withColumns(
        {
            "pass_rate": F.round((1 - F.col("quarantined").cast("double") / seen) * 100, 1),
            "at_risk_pct": F.round(x.ratio(F.col("at_risk") * 100, F.col("students")), 1),
        }
    )


def filtered(df: DataFrame, **choices) -> DataFrame:
    """Equality filters for the choices that are set; None and 'All' mean no filter."""
    chosen = [F.col(c) == v for c, v in choices.items() if v is not None and v != "All"]
    return df.filter(x.all_of(chosen)) if chosen else df


def options(df: DataFrame, column: str, **choices) -> DataFrame:
    """Sorted distinct values to choose from, given the choices already made."""
    return filtered(df, **choices).select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


# Drill-down levels, outermost first, with their column.
LEVELS = {
    "district": "district_name",
    "school": "school_id",
    "grade": "grade_level",
    "section": "section_id",
    "student": "student_id",
}


def drilldown(df: DataFrame, level: str, measures: dict[str, Column], columns: dict[str, str] | None = None, **choices) -> DataFrame:
    """Measures per value of ``level`` within the choices made at the levels above."""
    columns = columns or LEVELS
    picked = {columns[k]: v for k, v in choices.items()}
    return filtered(df, **picked).groupBy(columns[level]).agg(*[m.alias(n) for n, m in measures.items()])


# Slices to a shuffle partition, each counted by a task of its own: many, as their counts are held in memory.
SLICES = 8


def drilldown_levels(
    facts: DataFrame,
    members: DataFrame,
    entity: str = "student_id",
    value: str = "max_score_to_date",
    columns: Sequence[str] = tuple(LEVELS.values()),
    inner: DataFrame | None = None,
) -> DataFrame:
    """All levels of the drill-down at once: ``level``, the path to it (NULL below it), entities and average value.

    The innermost level is the entity, without a path.

    ``facts`` holds values of entities, ``members`` a row for each place of an
    entity on the path ``columns``, whose last is the entity itself.  Facts are
    summed up per entity first, and places are counted per entity and path, so
    no fact meets a membership row; grouping sets then roll the paths up, first
    per entity, as an entity with several places at one level counts once, then
    over entities.  An average weighs an entity by its places.

    With ``inner``, rows of the entity and the last column of the path, its
    places are all pairs of its rows in ``members``, which lacks that column,
    and in ``inner``.  They are counted, not paired, for the levels above; for
    the last one see ``_paired``.
    """
    *path, own = columns
    names = {c: level for level, c in zip(LEVELS, columns, strict=True)}
    sums = facts.groupBy(F.col(entity).alias("__e")).agg(F.sum(value).alias("__sum"), F.count(value).alias("__n"))
    held = path if inner is None else path[:-1]
    places = members.groupBy(F.col(entity).alias(own), *held).agg(F.count(F.lit(1)).alias("__w"))
    if inner is None:
        return _rolled_up(places.join(sums, F.col(own) == F.col("__e"), "inner").drop("__e"), path, own, names)
    places = materialized(places, "places")
    last = materialized(inner.groupBy(F.col(entity).alias("__i"), path[-1]).agg(F.count(F.lit(1)).alias("__times")), "inner")
    times = last.groupBy("__i").agg(F.sum("__times").alias("__all")).join(sums, F.col("__i") == F.col("__e"), "inner").drop("__e")
    scored = places.join(times, F.col(own) == F.col("__i"), "inner").withColumn("__w", F.col("__w") * F.col("__all")).drop("__i", "__all")
    above = _rolled_up(scored, held, own, names).withColumn(path[-1], F.lit(None).cast(last.schema[path[-1]].dataType))
    paired = _paired(places, last, sums, path, own).select(
        F.lit(names[path[-1]]).alias("level"), *path, F.lit(None).cast(places.schema[own].dataType).alias(own), "students", "avg_score"
    )
    return above.select(*paired.columns).unionByName(paired)


def _rolled_up(scored: DataFrame, path: Sequence[str], own: str, names: dict[str, str]) -> DataFrame:
    """All levels from the places of entities with their weight ``__w``, sum ``__sum`` and number ``__n`` of values."""
    sets = [[F.col(c) for c in path[: k + 1]] + [F.col(own)] for k in range(len(path))] + [[F.col(own)]]
    # the grouping number tells a level apart from a NULL in its path
    rolled = scored.groupingSets(sets, *[F.col(c) for c in path], F.col(own)).agg(
        F.grouping_id().alias("__level"), F.sum("__w").alias("__w"), F.first("__sum").alias("__sum"), F.first("__n").alias("__n")
    )
    number = {sum(1 << (len(path) - j) for j in range(k + 1, len(path))): path[k] for k in range(len(path))}
    number[sum(1 << (len(path) - j) for j in range(len(path)))] = own
    level = F.lit(None).cast("string")
    for mark, column in number.items():
        level = F.when(F.col("__level") == mark, names[column]).otherwise(level)
    alone = F.when(F.col("level") == names[own], F.col(own)).alias(own)
    return rolled.withColumn("level", level).groupBy("level", *path, alone).agg(*_weighed(F.col("__w")))


def _weighed(weight: Column) -> list[Column]:
    """Entities and average value of rows that hold an entity each."""
    weighed = F.sum(weight * F.col("__n"))
    return [F.count(F.lit(1)).alias("students"), F.when(weighed > 0, F.sum(weight * F.col("__sum")) / weighed).alias("avg_score")]


def _paired(places: DataFrame, last: DataFrame, sums: DataFrame, path: Sequence[str], own: str) -> DataFrame:
    """The last level of the path: every pair of an entity's places and of its values of the last column.

    Pairs are many more than both, so none is shuffled: values are dealt to
    slices by their hash, an entity's places go along to each slice in which it
    has values, as one list of numbers, and a slice makes its pairs and counts
    them where it is.
    """
    spark = places.sparkSession
    numbers = materialized(places.select(*path[:-1]).distinct().withColumn("__place", F.monotonically_increasing_id()), "place-numbers")
    few = numbers.count()
    known = numbers.select("__place", *[F.col(c).alias(f"__p_{c}") for c in path[:-1]])
    same = [F.col(c).eqNullSafe(F.col(f"__p_{c}")) for c in path[:-1]]
    lists = (
        places.join(broadcast_upto(known, few), same).groupBy(F.col(own).alias("__o"))
        .agg(F.collect_list(F.struct("__place", "__w")).alias("__places"))
        .join(sums, F.col("__o") == F.col("__e"), "inner").drop("__e")
    )
    slices = SLICES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = last.groupBy("__i", F.pmod(F.xxhash64(path[-1]), F.lit(slices)).cast("int").alias("__slice")).agg(
        F.collect_list(F.struct(path[-1], "__times")).alias("__last")
    )
    sliced = dealt.join(lists, F.col("__i") == F.col("__o"), "inner").drop("__i", "__o").repartition(slices, "__slice")
    pairs = sliced.select("__slice", "__places", "__sum", "__n", F.inline("__last")).select(
        "__slice", path[-1], "__times", "__sum", "__n", F.inline("__places")
    )
    # dealt by the slice already, so grouped without another shuffle
    counted = pairs.groupBy("__slice", path[-1], "__place").agg(*_weighed(F.col("__w") * F.col("__times")))
    return counted.join(broadcast_upto(numbers, few), "__place").select(*path, "students", "avg_score")


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows by ``order``; each task keeps only its own first ``n``."""
    return df.orderBy(*order).limit(n)
