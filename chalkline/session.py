"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side larger than this many rows is shuffled instead of broadcast.
BROADCAST_ROWS = 500_000


def build_session(app: str = "chalkline", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with adaptive execution, skew-join splitting and UTC timestamps.

    Call-site capture is off: it costs about a millisecond per column expression
    while a plan is built.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session without that setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rsplit("/", 1)[0]
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="chalkline-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir().rsplit("/", 1)[0]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/chalkline-{name}-{uuid.uuid4().hex[:12]}"


_DROP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_dropping: dict[str, tuple[int, str | None]] = {}
_dropping_lock = threading.Lock()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of an action go when it ends, not when the driver happens to collect its garbage.

    For writes, whose plans are not run again.  Several threads may be within at
    once; the last one out restores the setting.
    """
    session = spark._jsparkSession.sessionUUID()
    with _dropping_lock:
        inside, before = _dropping.get(session, (0, None))
        if not inside:
            before = spark.conf.get(_DROP, None)
            spark.conf.set(_DROP, "true")
        _dropping[session] = inside + 1, before
    try:
        yield
    finally:
        with _dropping_lock:
            inside, before = _dropping.pop(session)
            if inside > 1:
                _dropping[session] = inside - 1, before
            elif before is None:
                spark.conf.unset(_DROP)
            else:
                spark.conf.set(_DROP, before)


def materialized(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder once and read it from there.

    Cuts the plan like a checkpoint, but in columns: later steps read only what
    they need, and a lost executor costs a file read.  The table is removed when
    the driver ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    remove_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Have a scratch folder, which must be there, removed when the driver ends."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)


def broadcast_upto(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast only when the known row count is within the bound."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df
