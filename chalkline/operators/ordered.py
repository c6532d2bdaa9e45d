"""Running aggregates over an order within groups, safe for groups of any size.

A window would put all rows of a hot group into one sort task.  So hot groups
are cut by value into slices: the window runs within slices, and what the
earlier slices of the group add is carried in from their per-slice totals.
Groups of ordinary size are one slice: one shuffle on the group keys.

Nothing runs while the plan is built.  Which groups are hot, and where they are
cut, follows from a sample of the rows by hash: an aggregate in the plan itself,
broadcast within a fixed bound.  Where it turns out empty, adaptive execution
drops the carrying before it starts.  The sample depends on the rows alone, so a
lost task that is run again, and a plan that reads the sample twice, sees the
same slices.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows of a hot group to a slice, about.
HOT_ROWS = 2_000_000
# The largest groups that are cut, and slices of one: what is broadcast holds no more bounds than their product. Any
# other group holds under a thousandth of all rows.
MOST_GROUPS = 1_000
MOST_SLICES = 1_000
# Sampled rows to a slice; bounds in one step of the two-step search.
SAMPLED = 8
STEP = 24


@dataclass(frozen=True)
class Scan:
    """What to compute along the order: output column -> source column."""

    running_max: dict[str, str] = field(default_factory=dict)
    running_sum: dict[str, str] = field(default_factory=dict)
    running_count: str | None = None
    previous: dict[str, str] = field(default_factory=dict)
    group_size: str | None = None

    def totals(self) -> dict[str, Column]:
        """Aggregates that sum up a whole slice, by output column."""
        out = {name: F.max(src) for name, src in self.running_max.items()}
        out |= {name: F.sum(src) for name, src in self.running_sum.items()}
        if self.running_count:
            out[self.running_count] = F.count(F.lit(1))
        return out

    def merge(self, name: str, before: Column, here: Column) -> Column:
        """Combine what came before a slice with the value inside it."""
        if name in self.running_max:
            return F.greatest(before, here)
        if name in self.running_sum:
            return F.when(before.isNull(), here).when(here.isNull(), before).otherwise(before + here)
        return F.coalesce(before, F.lit(0)) + here


def _nulls_last(order: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in order]


def _position(order: Sequence[str]) -> Column:
    """A struct that sorts like ``_nulls_last(order)``."""
    return F.struct(*[x for c in order for x in (F.col(c).isNull(), F.col(c))])


def _ties(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> list[str]:
    """The order, then all other columns that can be sorted, so that rows tied in the order always fall alike."""
    return [*order, *(f.name for f in df.schema if f.name not in keys and f.name not in order and _sortable(f.dataType))]


def _sortable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _sortable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_sortable(f.dataType) for f in kind)
    return not isinstance(kind, (T.MapType, T.VariantType))


def hot_groups(df: DataFrame, keys: Sequence[str], hot_rows: int) -> tuple[DataFrame, int, int] | None:
    """(keys and row count, groups, rows) of the groups with more than ``hot_rows`` rows, counted now; None without any.

    For reports: ``ordered_scan`` does without.
    """
    counted = df.groupBy(*[F.col(k).alias(f"__hot_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("__hot_rows"))
    sizes = counted.filter(F.col("__hot_rows") > hot_rows)
    groups, rows = sizes.agg(F.count(F.lit(1)), F.sum("__hot_rows")).first()
    return (sizes, groups, rows) if groups else None


def _bounds(df: DataFrame, keys: Sequence[str], order: Sequence[str], hot_rows: int) -> DataFrame:
    """Hot groups, with ``__bounds``: the positions at which they are cut, in steps.

    A position is sampled if its hash is small enough for ``SAMPLED`` of
    ``hot_rows`` to be, and every ``SAMPLED``-th of a group's sample is a bound.
    """
    chance = F.pmod(F.xxhash64(*keys, *order), F.lit(1 << 31))
    marks = [f"__b_{k}" for k in keys]
    sample = (
        df.filter(chance < float(SAMPLED * (1 << 31) / hot_rows))
        .select(*[F.col(k).alias(m) for k, m in zip(keys, marks, strict=True)], _position(order).alias("p"))
        .groupBy(*marks)
        .agg(F.array_sort(F.collect_set("p")).alias("b"))
    )
    apart = F.greatest(F.lit(SAMPLED), F.ceil(F.size("b") / MOST_SLICES))
    cut = sample.select(*marks, F.size("b").alias("n"), F.filter("b", lambda _, k: (k + 1) % apart == 0).alias("b"))
    largest = cut.filter(F.size("b") > 0).orderBy(F.desc("n"), *marks).limit(MOST_GROUPS)
    steps = F.transform(F.sequence(F.lit(0), F.ceil(F.size("b") / STEP).cast("int") - 1), lambda k: F.slice("b", k * STEP + 1, F.lit(STEP)))
    return largest.select(*marks, steps.alias("__bounds"))


def _placed(df: DataFrame, keys: Sequence[str], order: Sequence[str], bounds: DataFrame) -> DataFrame:
    """``__slice``: how many bounds of its group lie at or before a row; ``__hot``: whether there are any."""
    marks = [f"__b_{k}" for k in keys]
    at = _position(order)
    held = df.join(F.broadcast(bounds), [F.col(k).eqNullSafe(F.col(m)) for k, m in zip(keys, marks, strict=True)], "left")
    hot = F.col("__bounds").isNotNull()
    held = held.withColumns({"__hot": hot, "__at": F.when(hot, at)}).drop(*marks)
    held = held.withColumn("__full", F.when(F.col("__hot"), F.size(F.filter("__bounds", lambda step: F.get(step, F.lit(0)) <= F.col("__at")))))
    within = F.size(F.filter(F.get("__bounds", F.col("__full") - 1), lambda bound: bound <= F.col("__at")))
    number = F.when(F.col("__full") > 0, (F.col("__full") - 1) * STEP + within)
    # never null, or the join on it would filter by it below
    return held.withColumn("__slice", F.coalesce(number, F.lit(0))).drop("__bounds", "__at", "__full")


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    scan: Scan,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add the columns of ``scan``, going through each group in ascending order, NULLs last.

    Rows tied in ``order`` are taken by their other columns, in sliced groups
    and others alike; copies of one row stay in one slice.  Running sums of
    floating-point columns are refused: they would depend on the way they are
    added; cast them to a decimal.
    """
    for name, src in scan.running_sum.items():
        if isinstance(df.schema[src].dataType, (T.FloatType, T.DoubleType)):
            raise ValueError(f"{name}: a running sum of {src} needs whole numbers or decimals")
    order = _ties(df, keys, order)
    placed = _placed(df, keys, order, _bounds(df, keys, order, hot_rows))
    ordered = Window.partitionBy(*keys, "__slice").orderBy(*_nulls_last(order))
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    new = {name: total.over(upto) for name, total in scan.totals().items()}
    new |= {name: F.lag(src).over(ordered) for name, src in scan.previous.items()}
    if scan.previous:
        new["__opens"] = F.row_number().over(ordered) == 1
    if scan.group_size:
        new[scan.group_size] = F.count(F.lit(1)).over(Window.partitionBy(*keys, "__slice"))
    carry = _carry(placed.filter("__hot"), keys, order, scan)
    # a row for each slice of a hot group, within the bound of the bounds
    joined = placed.withColumns(new).join(
        F.broadcast(carry),
        [F.col("__slice") == F.col("__c_slice"), *[F.col(k).eqNullSafe(F.col(f"__c_{k}")) for k in keys]],
        "left",
    )
    merged = {n: scan.merge(n, F.col(f"__before_{n}"), F.col(n)) for n in scan.totals()}
    merged |= {n: F.when(F.col("__opens"), F.col(f"__before_{n}")).otherwise(F.col(n)) for n in scan.previous}
    if scan.group_size:
        merged[scan.group_size] = F.coalesce("__c_size", scan.group_size)
    return joined.withColumns(merged).select(*df.columns, *merged)


def _carry(hot: DataFrame, keys: Sequence[str], order: Sequence[str], scan: Scan) -> DataFrame:
    """Per slice of a hot group: what all earlier slices add up to, the last values before it, and the group's size."""
    lasts = {f"__last_{name}": F.max_by(F.col(src), _position(order)) for name, src in scan.previous.items()}
    per_slice = hot.groupBy(*keys, "__slice").agg(
        F.count(F.lit(1)).alias("__n"),
        *[c.alias(f"__total_{name}") for name, c in scan.totals().items()],
        *[c.alias(name) for name, c in lasts.items()],
    )
    by_slice = Window.partitionBy(*keys).orderBy("__slice")
    before = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    carried = {
        f"__before_{name}": (F.max if name in scan.running_max else F.sum)(f"__total_{name}").over(before)
        for name in scan.totals()
    }
    carried |= {f"__before_{name}": F.lag(f"__last_{name}").over(by_slice) for name in scan.previous}
    carried["__c_size"] = F.sum("__n").over(Window.partitionBy(*keys))
    return per_slice.withColumns(carried).select(
        *[F.col(k).alias(f"__c_{k}") for k in keys], F.col("__slice").alias("__c_slice"), *carried
    )
