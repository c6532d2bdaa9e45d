"""Writing tables and registering them in the catalog."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chalkline.session import shuffles_dropped

# A value with more rows than this would make its bucket a task of its own.
HOT_BUCKET_ROWS = 1_000_000
# Of the Parquet files.
CODEC = "zstd"


def write_parquet(df: DataFrame, path: str, by: Sequence[str] = ()) -> DataFrame:
    """Overwrite ``path``, partitioned ``by`` columns, and return a frame that reads it.

    The new files are written beside the old ones, which are swapped out by two
    renames only when all are there.  So a run that fails half way leaves the
    old table as it was, and ``df`` may read what it replaces.  Where a rename
    copies, as in object stores, the swap takes as long as a copy.
    """
    spark = df.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())

    def beside(name: str):
        return spark._jvm.org.apache.hadoop.fs.Path(at.getParent(), f"_{name}-{at.getName()}-{uuid.uuid4().hex[:8]}")

    fresh, old = beside("fresh"), beside("old")
    try:
        with shuffles_dropped(spark):
            df.write.option("compression", CODEC).partitionBy(*by).parquet(fresh.toString())
    except BaseException:
        files.delete(fresh, True)
        raise
    if files.exists(at):
        _renamed(files, at, old)
    _renamed(files, fresh, at)
    files.delete(old, True)
    return spark.read.parquet(path)


def _renamed(files, source, target) -> None:
    if not files.rename(source, target):
        raise OSError(f"{source.toString()} could not be renamed to {target.toString()}")


def write_all(tables: dict[str, DataFrame], directory: str, at_once: int = 4) -> dict[str, DataFrame]:
    """Overwrite one directory per table; some at a time, so that small tables do not leave executors idle."""
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        jobs = {name: pool.submit(write_parquet, df, f"{directory}/{name}") for name, df in tables.items()}
        return {name: job.result() for name, job in jobs.items()}


def publish(df: DataFrame, table: str, database: str = "gold", by: str | None = None, buckets: int | None = None) -> DataFrame:
    """Overwrite a managed table and return a frame that reads it.

    Written under another name first, so that a failed run keeps the old table
    and ``df`` may read what it replaces.

    With ``by``, rows are put into ``buckets`` by the hash of that column, each
    sorted by it: tables with the same number of buckets are joined and grouped
    on it without an exchange.  A bucket is read by one task, so a table in which
    one value has more than ``HOT_BUCKET_ROWS`` rows is left without buckets, for
    adaptive execution to split.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    fresh = f"`{database}`.`{table}_fresh_{uuid.uuid4().hex[:8]}`"
    plain = f"`{database}`.`{table}_plain_{uuid.uuid4().hex[:8]}`"
    try:
        with shuffles_dropped(spark):
            if by is None:
                df.write.option("compression", CODEC).saveAsTable(fresh)
            else:
                number = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
                # adaptive execution splits large buckets between writers and has one writer make several small ones
                df.hint("rebalance", number, by).write.option("compression", CODEC).bucketBy(number, by).sortBy(by).saveAsTable(fresh)
                if _largest_group(spark.table(fresh), by) > HOT_BUCKET_ROWS:
                    spark.table(fresh).write.option("compression", CODEC).saveAsTable(plain)
                    spark.sql(f"DROP TABLE {fresh}")
                    fresh = plain
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        spark.sql(f"DROP TABLE IF EXISTS {plain}")
        raise
    spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{table}`")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO `{database}`.`{table}`")
    return spark.table(f"`{database}`.`{table}`")


def _largest_group(df: DataFrame, by: str) -> int:
    """Rows of the most frequent value: one column read, counted within buckets."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.max("n"), F.lit(0)).alias("n")).first()["n"]


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """Name a lazy frame, so that SQL text can refer to it."""
    df.createOrReplaceTempView(name)
    return df


def table_directories(spark: SparkSession, directory: str) -> list[str]:
    """Names of the sub-directories; hidden ones are left out.

    One level is listed, with the file system that Spark uses for the path.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    names = [f.getPath().getName() for f in found if f.isDirectory()]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def register_parquet_dir(spark: SparkSession, directory: str, database: str = "silver") -> dict[str, DataFrame]:
    """One catalog table per Parquet directory below ``directory``, read in place; replaces what bore the name."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    tables = {}
    for name in table_directories(spark, directory):
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
        spark.sql(f"CREATE TABLE `{database}`.`{name}` USING parquet LOCATION '{directory}/{name}'")
        tables[name] = spark.table(f"`{database}`.`{name}`")
    return tables
