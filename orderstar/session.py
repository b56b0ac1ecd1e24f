"""Session settings, shuffle sizes and the shared working folder."""

from __future__ import annotations

import json
import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHUFFLE_INPUT_BYTES = 16 * 1024 * 1024

# ANSI mode (the default) makes a value that does not fit its column an error instead of NULL.
# Results do not depend on the others. ``forceOptimizeSkewedJoin`` lets AQE split a hot join key even
# when the aggregate above the join has to be shuffled again because of it. Without
# ``requireAllClusterKeysForCoPartition`` joins whose keys contain the columns both sides are already
# partitioned by need no further shuffle. ``maxShuffledHashJoinLocalMapThreshold`` lets a join whose
# shuffled partitions all turn out smaller than that hash them instead of sorting both sides.
# ``advisoryPartitionSizeInBytes`` is what AQE merges shuffle partitions up to. It counts compressed
# bytes, and sorted rows take up to forty times as much in memory: at 64 MB tasks take gigabytes.
# Stored tables are written once and read a few times: zstd halves the bytes of wide order lines.
SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.parquet.compression.codec": "zstd",
}
_INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tune(spark: SparkSession, shuffle_partitions: int | None = None) -> SparkSession:
    """Set what the plans are designed for, for as long as the session lasts.

    For callers that run the returned frames themselves; a refresh uses ``tuned`` instead. Shuffles
    then begin with ``shuffle_partitions`` at least.
    """
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    if shuffle_partitions is not None and shuffle_partitions > initial_partitions(spark):
        spark.conf.set(_INITIAL_PARTITIONS, str(shuffle_partitions))
    return spark


@contextmanager
def tuned(spark: SparkSession, shuffle_partitions: int | None = None) -> Iterator[SparkSession]:
    """The same settings, and a number of initial shuffle partitions, until the block ends."""
    wanted = dict(SETTINGS)
    if shuffle_partitions is not None:
        wanted[_INITIAL_PARTITIONS] = str(shuffle_partitions)
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield spark
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def shuffle_partitions(rows: DataFrame, at_most: int | None = None) -> int:
    """How many shuffle partitions to begin with for ``rows`` (the columns that will be shuffled).

    AQE merges partitions that turn out small but cannot split an aggregation, so the number grows
    with the input: one per ``SHUFFLE_INPUT_BYTES`` of the size Spark's statistics give, which needs
    no job. It never goes below the session's own setting; ``at_most`` bounds it (default: no bound).
    """
    stored = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    wanted = math.ceil(stored / SHUFFLE_INPUT_BYTES)
    if at_most is not None:
        wanted = min(wanted, at_most)
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), wanted)


def initial_partitions(spark: SparkSession) -> int:
    """How many partitions a shuffle of this session begins with."""
    given = spark.conf.get(_INITIAL_PARTITIONS, None)
    return int(given or spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs in the block go as soon as it ends.

    Otherwise they stay until the driver happens to collect its garbage, so that a chain of stored tables
    needs room for all their shuffles at once. For writes: a frame that is run again would shuffle again.
    """
    before = spark.conf.get(_FREE_SHUFFLES, None)
    if before == "true":  # also where other threads are inside such a block
        yield
        return
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FREE_SHUFFLES) if before is None else spark.conf.set(_FREE_SHUFFLES, before)


def gathered(rows: DataFrame, *names: str) -> DataFrame:
    """Rows for a shuffle, those equal in ``names`` one after the other: so they take far fewer bytes.

    Sorted where they are, by a number, which takes no comparisons. The optimizer drops a sort that only
    another sort or an aggregation would see, but not below an observation.
    """
    ordered = rows.sortWithinPartitions(F.xxhash64(*names))
    return ordered.observe(f"gathered-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` where the session names one.

    Only a single-machine session without that setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named is None and context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="orderstar-"))
    elif context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named or context.getCheckpointDir()


def work_folder(spark: SparkSession) -> str:
    """Folder of this application inside the shared one."""
    return f"{shared_folder(spark)}/orderstar/{spark.sparkContext.applicationId}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is; nothing happens if there is none."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def few_rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A frame of a few rows made by the driver, without a task in Python."""
    given = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")
    return spark.range(1, numPartitions=1).select(F.inline(given))


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder on whatever file system it is."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in files.listStatus(hadoop) if f.isDirectory()]


_scratch: list[str] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Everything checkpointed inside the block is deleted at its end, also when it fails."""
    path = f"{work_folder(spark)}/scratch-{uuid.uuid4().hex}"
    _scratch.append(path)
    try:
        yield path
    finally:
        _scratch.remove(path)
        remove_folder(spark, path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Compute once into the shared folder; the result survives the loss of executors.

    Outside ``scratch`` the rows stay until ``work_folder`` is deleted.
    """
    spark = df.sparkSession
    folder = _scratch[-1] if _scratch else f"{work_folder(spark)}/scratch"
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
