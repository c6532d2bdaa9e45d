"""Ad-hoc SQL on published tables."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession


def query(spark: SparkSession, sql: str, args: dict[str, Any] | None = None, **tables: DataFrame) -> DataFrame:
    """Run SQL with bound parameters (``:name``) and frames (``{name}``); values are never pasted into the text."""
    return spark.sql(sql, args=args, **tables) if args else spark.sql(sql, **tables)
