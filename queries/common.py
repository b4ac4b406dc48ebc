"""Helpers shared by the query modules."""

from __future__ import annotations

import atexit
import contextlib
import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.constants import LINEAGE, RECORD_ID
from layerloom.operators import lineage
from layerloom.operators.relations import null_safe_join
from layerloom.operators.tracked import TrackedFrame
from layerloom.sources import storage

PROCESSING_DAY = dt.date(2026, 1, 15)


def own_folder(spark: SparkSession) -> str:
    """A folder for the tables of one query, among those of the run; removed when the process ends."""
    folder = f"{lineage.shared_folder(spark)}/tables-{uuid.uuid4().hex}"

    def remove() -> None:
        with contextlib.suppress(Exception):  # the session may be gone already
            storage.delete(spark, folder)

    atexit.register(remove)
    return folder


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def tracked(df: DataFrame, source: str, *id_parts: str) -> TrackedFrame:
    """Rows of a driver table as lineage sources, identified by their key columns."""
    record_id = F.concat_ws("-", *id_parts)
    seeded = lineage.seed(df.withColumn(RECORD_ID, record_id), source)
    return TrackedFrame(seeded.drop(RECORD_ID), origin=lineage.Sources(once=frozenset({source})))


def load_tracked(spark: SparkSession, folder: str, table: str, *id_parts: str) -> TrackedFrame:
    return tracked(load(spark, folder, table), f"{table}_raw", *id_parts)


def cents(column: str) -> Column:
    """Money as whole cents, so that sums and averages do not depend on their order."""
    return F.round(F.col(column) * 100).cast("bigint")


def source_counts(frame: TrackedFrame, keys: Sequence[str], *tables: str) -> DataFrame:
    """Number of source records per row and source table, one column per table."""
    found = frame.sources(*keys)
    counts = [
        F.count_if(F.col(lineage.SOURCE_TABLE) == f"{t}_raw").alias(f"n_{t}") for t in tables
    ]
    return found.groupBy(*keys).agg(*counts)


def with_source_counts(frame: TrackedFrame, keys: Sequence[str], *tables: str) -> DataFrame:
    """The rows of a grouped frame next to the number of sources behind each of them."""
    counted = frame.counted(keys, {f"n_{t}": f"{t}_raw" for t in tables})
    if counted is not None:
        return counted
    return null_safe_join(frame.data, source_counts(frame, keys, *tables), keys)


def lineage_text(frame: TrackedFrame) -> DataFrame:
    """Rows with their sources written out; for frames that were joined but not grouped."""
    parts = F.transform(
        LINEAGE, lambda e: F.concat_ws(":", e[lineage.SOURCE_TABLE], e[lineage.SOURCE_ID])
    )
    return frame.df.withColumn("sources", F.array_join(F.array_sort(parts), ",")).drop(LINEAGE)


def sql_hash(*columns: str) -> str:
    """The safe row hash in SQL."""
    parts = [
        f"coalesce(length(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')"
        for c in columns
    ]
    return f"sha256({' || '.join(parts)})"
