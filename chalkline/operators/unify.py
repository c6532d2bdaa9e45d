"""Bring differently shaped sources into one schema."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Source:
    """A frame and how each target column is made from it.

    A mapping value is a column name, a Column, or None for a NULL column.
    """

    df: DataFrame
    mapping: dict[str, str | Column | None]
    where: Column | None = None


def project(df: DataFrame, mapping: dict[str, str | Column | None], types: dict[str, str] | None = None) -> DataFrame:
    """Pure projection with renames; ``types`` are applied leniently."""
    types = types or {}

    def make(name: str, src: str | Column | None) -> Column:
        if src is None:
            return F.lit(None).cast(types.get(name, "string")).alias(name)
        value = F.col(src) if isinstance(src, str) else src
        return (value.try_cast(types[name]) if name in types else value).alias(name)

    return df.select(*[make(name, src) for name, src in mapping.items()])


def unify(sources: list[Source], types: dict[str, str] | None = None) -> DataFrame:
    """UNION ALL by name of the projected sources; no shuffle."""
    parts = [project(s.df.filter(s.where) if s.where is not None else s.df, s.mapping, types) for s in sources]
    return reduce(DataFrame.unionByName, parts)


def shared_values(df: DataFrame, value: str, source: str, min_sources: int = 2) -> DataFrame:
    """Values seen in several sources: value, sources, rows.  Copies combine before the shuffle."""
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(value, source)
        .agg(F.count(F.lit(1)).alias("__rows"))
        .groupBy(value)
        .agg(F.count(F.lit(1)).alias("sources"), F.sum("__rows").alias("rows"))
        .filter(F.col("sources") >= min_sources)
    )


def one_per_value(df: DataFrame, value: str, prefer: list[str]) -> DataFrame:
    """One surviving row per non-NULL value: the smallest by ``prefer``, NULLs last.

    An aggregate, so a group of copies shrinks to one row per task before the
    shuffle.  Rows without a value cannot be matched and all stay.
    """
    rest = [c for c in df.columns if c != value]
    rank = F.struct(*[x for c in prefer for x in (F.col(c).isNull(), F.col(c))])
    kept = (
        df.filter(F.col(value).isNotNull())
        .groupBy(value)
        .agg(F.min_by(F.struct(*rest), rank).alias("__row"))
        .select(value, "__row.*")
        .select(*df.columns)
    )
    return kept.unionByName(df.filter(F.col(value).isNull()))
