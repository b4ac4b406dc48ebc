"""Session settings this library is written for."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Plans are sized at run time. Before a query starts only tiny tables are broadcast, because the size
# of a side is a guess then; later, joins turn into broadcasts by the measured size of a shuffle.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.autoBroadcastJoinThreshold": "1MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder


#: Into how many pieces a shuffle is cut before Spark puts small ones together, and up to which size it does so.
PIECES, SHUFFLE_PIECES = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", 1000
TASK_SIZE, SHUFFLE_TASK_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "16MB"


def cut_finely(spark: SparkSession) -> None:
    """Let what a task holds follow the measured size of a shuffle, not the number of shuffle partitions.

    Adaptive execution joins small pieces up to its advisory size, but cuts none of a join or an aggregation, so with
    few partitions a task's share grows with the input. Lineage is compressed well and held several times over: 64 MB of
    it take a task more than 1 GB of memory, and spill. What was set already stays.
    """
    if spark.conf.get(PIECES, None) is None:
        spark.conf.set(PIECES, str(max(SHUFFLE_PIECES, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    if TASK_SIZE not in spark.conf.getAll:
        spark.conf.set(TASK_SIZE, SHUFFLE_TASK_SIZE)


#: Bytes of a generated method above which Spark gives up compiling a stage into one.
METHOD_SIZE, COMPILED_METHOD_SIZE = "spark.sql.codegen.hugeMethodLimit", 8000


def keep_compiled(spark: SparkSession) -> None:
    """Let wide rows be hashed by compiled code.

    The JVM never compiles a method of more than 8,000 bytes, but Spark builds stages of up to 65,535 into one, which are then
    interpreted row by row. Below the JVM's limit it splits their expressions instead. What was set already stays.
    """
    if METHOD_SIZE not in spark.conf.getAll:
        spark.conf.set(METHOD_SIZE, str(COMPILED_METHOD_SIZE))


#: Whether Spark deletes the shuffle files of a query when it ends, not when its plan is collected as garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written or counted meanwhile go when it stands; nothing reads them again."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of held frames that were given up.

    They belong to no query that ends. Spark deletes them when the JVM collects their plans, which an idle heap may put off for long.
    """
    spark.sparkContext._jvm.System.gc()
