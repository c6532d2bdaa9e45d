"""Rules on rows, checks on tables, and their reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from chalkline.functions import exprs as x
from chalkline.operators.joins import orphan_count
from chalkline.session import materialized
from chalkline.sources.sinks import write_parquet

LOG_COLUMNS = (
    "source_system",
    "entity_type",
    "record_id",
    "rule_name",
    "rule_description",
    "field_name",
    "field_value",
    "expected_value",
    "quarantined_at",
)


@dataclass(frozen=True)
class ExistsIn:
    """The field must occur as ``key`` in ``parent``; a NULL field fails unless ``null_ok``."""

    parent: DataFrame
    key: str
    null_ok: bool = False


@dataclass(frozen=True)
class Rule:
    """One validation rule.  ``fails`` is a predicate on the row or an ``ExistsIn``."""

    name: str
    description: str
    field: str
    expected: str
    fails: Column | ExistsIn
    entity: str = "record"
    shown: Column | None = None

    def violation(self, failed: Column) -> Column:
        shown = self.shown if self.shown is not None else F.col(self.field)
        return F.when(
            failed,
            F.struct(
                F.lit(self.entity).alias("entity_type"),
                F.lit(self.name).alias("rule_name"),
                F.lit(self.description).alias("rule_description"),
                F.lit(self.field).alias("field_name"),
                shown.cast("string").alias("field_value"),
                F.lit(self.expected).alias("expected_value"),
            ),
        )


def with_failures(df: DataFrame, rules: Sequence[Rule], name: str = "__failures") -> DataFrame:
    """Add the array of violated rules; all rules share one pass over ``df``.

    An ``ExistsIn`` rule marks rows by a left join to the distinct parent keys,
    so adaptive execution can split a hot or NULL key.
    """
    keep = df.columns
    found = []
    for i, rule in enumerate(rules):
        failed = rule.fails
        if isinstance(failed, ExistsIn):
            mark = failed.parent.select(F.col(failed.key).alias(f"__pk{i}")).distinct()
            df = df.join(mark, F.col(rule.field) == F.col(f"__pk{i}"), "left")
            missing = F.col(f"__pk{i}").isNull()
            failed = missing & F.col(rule.field).isNotNull() if rule.fails.null_ok else missing
        found.append(rule.violation(failed))
    return df.select(*keep, F.array_compact(F.array(*found)).alias(name))


def violation_log(
    flagged: DataFrame, run_ts: datetime | Column, record_id: str, source: str = "_source_system", name: str = "__failures"
) -> DataFrame:
    """One row per record and violated rule, in the columns of the quarantine log."""
    stamped = run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    return (
        flagged.select(
            F.col(source).alias("source_system"),
            F.coalesce(F.col(record_id).cast("string"), F.lit("UNKNOWN")).alias("record_id"),
            F.explode(name).alias("__v"),
        )
        .select("source_system", "record_id", "__v.*", stamped.cast("timestamp").alias("quarantined_at"))
        .select(*LOG_COLUMNS)
    )


def violations(
    df: DataFrame, rules: Sequence[Rule], run_ts: datetime | Column, record_id: str, source: str = "_source_system"
) -> DataFrame:
    return violation_log(with_failures(df, rules), run_ts, record_id, source)


def union_logs(logs: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, logs)


def route(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(passed, quarantined) rows; every input row is in exactly one of them."""
    flagged = with_failures(df, rules)
    bad = F.size("__failures") > 0
    return flagged.filter(~bad).drop("__failures"), flagged.filter(bad).drop("__failures")


@dataclass(frozen=True)
class Routed:
    """What one pass over a table left behind."""

    passed: DataFrame
    quarantined: DataFrame
    log: DataFrame
    totals: dict[str, int]


def routed(
    df: DataFrame, rules: Sequence[Rule], path: str, run_ts: datetime | Column, record_id: str, source: str = "_source_system"
) -> Routed:
    """Split a table by its rules in one pass: each row is judged once and written once, below ``path`` by its outcome.

    Passed and quarantined rows are then read from their own folders, the log is
    made from the failures that were written along with the quarantined rows,
    and the totals are observed while the rows go by.  A run again replaces
    ``path`` when it has ended well.
    """
    flagged = with_failures(df, rules)
    bad = F.size("__failures") > 0
    seen = Observation("routed")
    counted = flagged.observe(
        seen, F.count(F.lit(1)).alias("ingested"), F.count_if(~bad).alias("passed"), F.count_if(bad).alias("quarantined"),
        F.coalesce(F.sum(F.size("__failures")), F.lit(0)).alias("failures"),
    )
    write_parquet(counted.withColumn("__outcome", F.when(bad, "quarantined").otherwise("passed")), path, by=["__outcome"])
    kept = df.sparkSession.read.schema(flagged.schema.add("__outcome", "string")).parquet(path)
    passed, quarantined = (kept.filter(F.col("__outcome") == outcome).drop("__outcome") for outcome in ("passed", "quarantined"))
    log = violation_log(quarantined, run_ts, record_id, source)
    return Routed(passed.drop("__failures"), quarantined.drop("__failures"), log, seen.get)


def route_totals(flagged: DataFrame, by: Sequence[str] = (), name: str = "__failures") -> DataFrame:
    """Records ingested, passed and quarantined."""
    bad = F.size(name) > 0
    return flagged.groupBy(*by).agg(
        F.count(F.lit(1)).alias("ingested"), F.count_if(~bad).alias("passed"), F.count_if(bad).alias("quarantined")
    )


def scorecard(
    flagged: DataFrame,
    as_of: Column,
    source: str = "_source_system",
    loaded: str = "_loaded_at",
    green: int = 1,
    yellow: int = 7,
) -> DataFrame:
    """Per source: totals, pass rate, last load and how fresh it is."""
    bad = F.size("__failures") > 0
    per_source = flagged.groupBy(source).agg(
        F.count(F.lit(1)).alias("ingested"),
        F.count_if(~bad).alias("passed"),
        F.count_if(bad).alias("quarantined"),
        F.max(loaded).alias("last_loaded_at"),
    )
    age = F.date_diff(as_of.cast("date"), F.col("last_loaded_at").try_cast("date"))
    return per_source.withColumns(
        {
            "pass_rate": F.round(x.ratio(F.col("passed"), F.col("ingested")) * 100, 1),
            "freshness": x.freshness(age, green, yellow),
        }
    )


# --- checks on whole tables -------------------------------------------------

ERROR, WARN = "error", "warn"


def _report_row(check: str, table: str, column: str, severity: str, violations: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(table).alias("table"),
        F.lit(column).alias("column"),
        F.lit(severity).alias("severity"),
        violations.cast("bigint").alias("violations"),
    )


def not_null(df: DataFrame, table: str, cols: Sequence[str], warn: Sequence[str] = ()) -> DataFrame:
    """NULL rows of every column, counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    rows = [
        _report_row("not_null", table, c, WARN if c in warn else ERROR, F.col(f"n{i}")) for i, c in enumerate(cols)
    ]
    return counts.select(F.inline(F.array(*rows)))


def duplicates(df: DataFrame, cols: Sequence[str], count: str = "occurrence_count", required: Sequence[str] | None = None) -> DataFrame:
    """Keys occurring more than once; keys with a NULL in ``required`` (default: all) are left out."""
    required = cols if required is None else required
    known = df.filter(x.all_of([F.col(c).isNotNull() for c in required]))
    return known.groupBy(*cols).agg(F.count(F.lit(1)).alias(count)).filter(F.col(count) > 1)


def unique(df: DataFrame, table: str, col: str, severity: str = ERROR) -> DataFrame:
    """Number of non-NULL values occurring more than once."""
    return counted(duplicates(df, [col]), "unique", table, col, severity)


def accepted_values(df: DataFrame, table: str, col: str, values: Sequence[str], severity: str = ERROR) -> DataFrame:
    """Number of distinct non-NULL values outside ``values``."""
    return counted(unexpected_values(df, col, values), "accepted_values", table, col, severity)


def unexpected_values(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    return df.filter(~F.col(col).isin(*values)).groupBy(col).agg(F.count(F.lit(1)).alias("rows"))


def relationships(
    child: DataFrame, table: str, fk: str, parent: DataFrame, pk: str, severity: str = ERROR
) -> DataFrame:
    """Number of child rows whose non-NULL key is missing in the parent."""
    counts = orphan_count(child, parent, {fk: pk})
    return counts.select(F.inline(F.array(_report_row("relationships", table, fk, severity, F.col("violations")))))


def counted(violating: DataFrame, check: str, table: str, column: str = "", severity: str = ERROR) -> DataFrame:
    """Report row for any frame of violating rows (empty means the check passes)."""
    total = violating.agg(F.count(F.lit(1)).alias("violations"))
    return total.select(F.inline(F.array(_report_row(check, table, column, severity, F.col("violations")))))


def settled(checks: Sequence[DataFrame], at_once: int = 6) -> list[DataFrame]:
    """Report rows as written tables, some checks at a time: the disk holds the shuffles of these, not of all checks."""
    return [materialized(reduce(DataFrame.unionByName, checks[k : k + at_once]), "checks") for k in range(0, len(checks), at_once)]


def report(checks: Sequence[DataFrame]) -> DataFrame:
    """One row per check with its outcome: pass, warn or fail."""
    rows = reduce(DataFrame.unionByName, checks)
    clean = F.col("violations") == 0
    status = F.when(clean, F.lit("pass")).when(F.col("severity") == WARN, F.lit("warn")).otherwise(F.lit("fail"))
    return rows.withColumn("status", status)
