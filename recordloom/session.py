"""Session settings the engine relies on, and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# allowDuplicateKeys: a repeated key in one JSON object keeps its last value.
# The adaptive settings let Spark split hot join keys at run time, also where
# the split costs one more shuffle downstream. A table is as many folders as it
# has buckets: they are listed by so many tasks, not by a task each.
RUNTIME_SETTINGS = {
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings; safe to call repeatedly."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A machine-local folder is used only in local mode when nothing is set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="recordloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path in the shared folder."""
    return f"{shared_folder(spark)}/recordloom/{label}-{uuid.uuid4().hex}"


STAGED: ContextVar[list[str] | None] = ContextVar("staged", default=None)


@contextmanager
def staged_until_done(spark: SparkSession) -> Iterator[None]:
    """Folders staged inside are removed at the end; nothing read from them may be used after it.

    Threads belong to it if they run in a copy of its context.
    """
    paths: list[str] = []
    token = STAGED.set(paths)
    try:
        yield
    finally:
        STAGED.reset(token)
        for path in paths:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def stage(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later passes then start from a committed table instead of recomputing
    (or, after a lost executor, re-reading) everything above it. VARIANT columns
    are written shredded unless the session's settings say otherwise, so a later
    pass reads only the paths it extracts. ``options`` are those of the Parquet writer.
    """
    path = scratch(df.sparkSession, label)
    kept = STAGED.get()
    if kept is not None:
        kept.append(path)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Run-time settings for what is planned inside."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


SHUFFLE_PARTITION_BYTES = 128 << 20
ENCODED_GROWTH = 4  # rows in a shuffle against the same rows in compressed Parquet
UNKNOWN_BYTES = 1 << 60  # a size from here on means that Spark does not know it
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def shuffle_partitions(*inputs: DataFrame, more: int = 0) -> int:
    """Partitions a shuffle of these inputs and ``more`` bytes of files needs, no fewer than the session's setting."""
    sizes = [int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for df in inputs]
    known = more + sum(size for size in sizes if size < UNKNOWN_BYTES)
    least = int(inputs[0].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, math.ceil(known * ENCODED_GROWTH / SHUFFLE_PARTITION_BYTES))


SPREAD_BYTES = 1 << 20  # of compressed files: some hundred thousand narrow rows
TASKS_PER_CORE = 4
UNEVEN = 2  # the rows of the fullest task against an even share


def deal(table: DataFrame) -> DataFrame:
    """The table, its rows dealt to all cores if reading its files would leave most of them to a few tasks.

    Files of narrow rows are small for the number of their rows, and no task reads less than a block of rows. Rows stay in the
    order they lie in where that is not so. Counting the rows of each task reads no column.
    """
    size = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if not SPREAD_BYTES < size < UNKNOWN_BYTES:
        return table
    cores = table.sparkSession.sparkContext.defaultParallelism
    rows = [row[1] for row in table.groupBy(F.spark_partition_id()).count().collect()]
    if max(rows, default=0) * cores <= UNEVEN * sum(rows):
        return table
    least = math.ceil(size * ENCODED_GROWTH / SHUFFLE_PARTITION_BYTES)
    return table.repartition(max(least, min(TASKS_PER_CORE * cores, size // SPREAD_BYTES + 1)))


@contextmanager
def sized_shuffles(*inputs: DataFrame, more: int = 0) -> Iterator[int]:
    """Shuffles inside start with partitions that fit in memory for these inputs.

    Spark merges partitions that turn out small but never adds any, so the start
    has to grow with the data. Inputs are tables read from files, whose size
    Spark knows without a job.
    """
    spark = inputs[0].sparkSession
    count = shuffle_partitions(*inputs, more=more)
    with settings(spark, {INITIAL_PARTITIONS: str(count)}):
        yield count
