"""Join shapes used by the models.

No broadcast hints: Spark broadcasts a side whose measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise sorts and merges, where
adaptive execution splits a hot left-side key.  The helpers below add what that
does not cover: hot keys on the right of an outer join, NULL keys, and
existence checks against non-unique parents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chalkline.functions.exprs import all_of


def _pairs(on: str | Sequence[str] | dict[str, str]) -> dict[str, str]:
    if isinstance(on, str):
        return {on: on}
    return dict(on) if isinstance(on, dict) else {c: c for c in on}


def _keyed(right: DataFrame, pairs: dict[str, str], take: dict[str, str]) -> DataFrame:
    """Right side reduced to renamed keys and the wanted columns."""
    return right.select(
        *[F.col(r).alias(f"__r_{i}") for i, r in enumerate(pairs.values())],
        *[F.col(src).alias(name) for name, src in take.items()],
    )


def _matches(pairs: dict[str, str]) -> list:
    return [F.col(left) == F.col(f"__r_{i}") for i, left in enumerate(pairs)]


def _has_keys(pairs: dict[str, str]):
    return all_of([F.col(left).isNotNull() for left in pairs])


def lookup(left: DataFrame, right: DataFrame, on, take: Sequence[str] | dict[str, str]) -> DataFrame:
    """Left join to a table that is unique on the key; ``take`` names the columns to bring."""
    pairs = _pairs(on)
    take = dict(take) if isinstance(take, dict) else {c: c for c in take}
    return left.join(_keyed(right, pairs, take), _matches(pairs), "left").drop(*[f"__r_{i}" for i in range(len(pairs))])


def enrich(left: DataFrame, right: DataFrame, on, take: Sequence[str] | dict[str, str], fill: Sequence[str] = ()) -> DataFrame:
    """``lookup`` that also fills NULLs of the ``fill`` columns from the right side."""
    take = dict(take) if isinstance(take, dict) else {c: c for c in take}
    filler = {f"__fill_{c}": c for c in fill}
    joined = lookup(left, right, on, take | filler)
    return joined.withColumns({c: F.coalesce(F.col(c), F.col(f"__fill_{c}")) for c in fill}).drop(*filler) if fill else joined


def fan_out(left: DataFrame, right: DataFrame, on, take: Sequence[str] | dict[str, str]) -> DataFrame:
    """Left join to a table with many rows per key, which may be hot.

    An outer join cannot split a hot key on its right side.  So the right rows
    of a key are spread over salts, by a hash of what they bring, and a left row
    goes once to each salt that its key has there, hence never more often than
    it has matches; one without matches goes to a salt of its own hash, NULL
    keys too, so none of them pile up.  Each side is read once: the salts of a
    key come from the same shuffle that the join reads.
    """
    pairs = _pairs(on)
    take = dict(take) if isinstance(take, dict) else {c: c for c in take}
    marks = [f"__r_{i}" for i in range(len(pairs))]
    salts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = _keyed(right, pairs, take)
    keyed = keyed.filter(all_of([F.col(m).isNotNull() for m in marks]))
    # never null, or the join would filter its side only and the two readings would differ
    salt = F.coalesce(F.pmod(F.xxhash64(*take), F.lit(salts)), F.lit(0))
    # dealt by the salt's expression and salted above it: both readers need the same columns, so one shuffle serves them
    spread = keyed.repartition(*marks, salt).withColumn("__r_salt", salt)
    known = spread.groupBy(*[F.col(m).alias(m.replace("__r_", "__s_")) for m in marks]).agg(F.collect_set("__r_salt").alias("__salts"))
    alone = F.array(-1 - F.pmod(F.xxhash64(*left.columns), F.lit(salts)))
    placed = (
        left.join(known, [F.col(c) == F.col(f"__s_{i}") for i, c in enumerate(pairs)], "left")
        .withColumn("__salt", F.explode(F.coalesce("__salts", alone)))
        .drop("__salts", *[m.replace("__r_", "__s_") for m in marks])
    )
    joined = placed.join(spread, [*_matches(pairs), F.col("__salt") == F.col("__r_salt")], "left")
    return joined.select(*left.columns, *take)


def orphans(child: DataFrame, parent: DataFrame, on, null_is_orphan: bool = True) -> DataFrame:
    """Child rows without a parent.  NULL keys count as orphans, or are left out.

    NULL-key rows are told by a filter and never shuffled.
    """
    pairs = _pairs(on)
    parents = _keyed(parent, pairs, {}).distinct()
    missing = child.filter(_has_keys(pairs)).join(parents, _matches(pairs), "left_anti")
    return missing.unionByName(child.filter(~_has_keys(pairs))) if null_is_orphan else missing


def orphan_count(child: DataFrame, parent: DataFrame, on, name: str = "violations") -> DataFrame:
    """Number of child rows whose non-NULL key has no parent; child keys are counted before the join."""
    pairs = _pairs(on)
    keys = child.filter(_has_keys(pairs)).groupBy(*pairs).agg(F.count(F.lit(1)).alias("__rows"))
    missing = keys.join(_keyed(parent, pairs, {}).distinct(), _matches(pairs), "left_anti")
    return missing.agg(F.coalesce(F.sum("__rows"), F.lit(0)).alias(name))


def below_band(child: DataFrame, parent: DataFrame, on, value: str, floor: str, take: Sequence[str] = ()) -> DataFrame:
    """Child rows whose ``value`` lies under the parent's ``floor``."""
    joined = child.filter(F.col(value).isNotNull()).join(
        _keyed(parent.filter(F.col(floor).isNotNull()), _pairs(on), {c: c for c in (floor, *take)}),
        [*_matches(_pairs(on)), F.col(value) < F.col(floor)],
        "inner",
    )
    return joined.drop(*[f"__r_{i}" for i in range(len(_pairs(on)))])
