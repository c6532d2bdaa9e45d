"""The registry itself."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chalkline.registry.model import Model

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def add(name: str, build: Callable[[Model], DataFrame], sql: str | None = None) -> None:
    """Register a query under ``name`` and, where there is one, the SQL it must agree with."""
    if name in QUERIES:
        raise ValueError(f"query registered twice: {name}")
    QUERIES[name] = lambda spark, sf_dir: build(Model(spark, sf_dir))
    if sql is not None:
        ORACLES[name] = sql


def query(name: str, sql: str | None = None):
    """Decorator form of ``add``."""

    def register(build):
        add(name, build, sql)
        return build

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 9) -> DataFrame:
    """Averages rounded, since the two engines add doubles in different orders."""
    return df.withColumns({c: F.round(c, digits) for c in columns})
