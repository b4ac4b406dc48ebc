"""Intermediate tables leave no shuffle files behind."""

import time

from pyspark.sql import functions as F

from layerloom.llm.scratch import CLEANUP, Scratch


def _shuffle_files(spark) -> set[str]:
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {name for name in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in name}


def test_shuffle_files_go_when_a_table_stands(spark):
    before, setting = _shuffle_files(spark), spark.conf.get(CLEANUP)
    scratch = Scratch(spark)
    numbers = spark.range(1000).select((F.col("id") % 10).alias("k"), "id")
    stored = scratch.write(numbers.groupBy("k").agg(F.sum("id").alias("n")))
    bucketed = scratch.write_buckets(numbers.repartition(4, "k"), "k", 4)
    left = _shuffle_files(spark) - before
    for _ in range(20):  # executors delete them a moment later
        if not left:
            break
        time.sleep(0.5)
        left = _shuffle_files(spark) - before
    assert not left
    assert spark.conf.get(CLEANUP) == setting
    assert (stored.count(), bucketed.count()) == (10, 1000)
    scratch.close()
