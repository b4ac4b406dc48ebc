"""Slowly changing dimensions of type 2, and record ids."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from layerloom.constants import FROM_DATE, HISTORY_COLUMNS, LINEAGE, OPEN_END, RECORD_ID, TO_DATE
from layerloom.functions.hashing import row_hash, row_key
from layerloom.functions.times import date_literal
from layerloom.operators.lineage import no_sources
from layerloom.session import keep_compiled

COPIES_ERROR = "Not all rows in the table are unique"


def value_columns(df: DataFrame) -> list[str]:
    """Columns that make two versions of a row differ."""
    return [c for c in df.columns if c not in (*HISTORY_COLUMNS, LINEAGE)]


def merge_history(
    incoming: DataFrame,
    stored: DataFrame,
    processing_date: dt.date | None = None,
    hash_mode: str = "safe",
) -> DataFrame:
    """Merge a full new snapshot into the stored history.

    ====== ======== ========= ==================== ====================
    stored incoming result    from_date            to_date
    ====== ======== ========= ==================== ====================
    open   yes      unchanged stored               2099-12-31
    open   no       closed    stored               processing date
    no     yes      new       processing date      2099-12-31
    closed (any)    kept      stored               stored
    ====== ======== ========= ==================== ====================

    There is no business key: a changed row closes one version and opens another. The row content is
    hashed once per side, and a single full join on the 32-byte hash decides all three cases. Closed
    versions are appended without a shuffle.

    Incoming copies of one row are an error, raised when the result is computed: rows are numbered within
    their hash in the order the join sorts them in anyway, and the second row of a hash ends the job. No
    row is sorted or aggregated ahead of the shuffle.
    """
    keep_compiled(incoming.sparkSession)
    values = value_columns(incoming)
    tracked = LINEAGE in incoming.columns
    today = date_literal(processing_date)
    open_end = F.lit(OPEN_END).cast("date")

    new = incoming.select(
        row_key(incoming, values, hash_mode).alias("_new_key"),
        F.struct(*values).alias("_new"),
        *([F.col(LINEAGE).alias("_new_lineage")] if tracked else []),
    ).withColumn("_copy", F.row_number().over(Window.partitionBy("_new_key").orderBy("_new_key")))
    current = stored.where(F.col(TO_DATE) == open_end).select(*values, FROM_DATE)
    old = current.select(
        row_key(current, values, hash_mode).alias("_old_key"),
        F.struct(*values).alias("_old"),
        F.col(FROM_DATE).alias("_old_from"),
    )
    joined = new.join(old, F.col("_new_key") == F.col("_old_key"), "full")
    row = F.coalesce("_new", "_old")
    copied = F.raise_error(F.lit(COPIES_ERROR)).cast("date")
    merged = joined.select(
        *[row.getField(c).alias(c) for c in values],
        F.when(F.col("_old_key").isNull(), today).otherwise(F.col("_old_from")).alias(FROM_DATE),
        F.when(F.col("_copy") > 1, copied)
        .when(F.col("_new_key").isNull(), today)
        .otherwise(open_end)
        .alias(TO_DATE),
        *([F.coalesce("_new_lineage", no_sources()).alias(LINEAGE)] if tracked else []),
    )
    closed = stored.where(F.col(TO_DATE) != open_end).select(
        *values, FROM_DATE, TO_DATE, *([no_sources().alias(LINEAGE)] if tracked else [])
    )
    return merged.unionByName(closed)


def first_history(incoming: DataFrame, processing_date: dt.date | None = None) -> DataFrame:
    """What ``merge_history`` gives where nothing is stored; copies of a row are for the caller to find.

    Nothing meets anything here, so rows are not shuffled.
    """
    keep_compiled(incoming.sparkSession)
    tracked = [LINEAGE] if LINEAGE in incoming.columns else []
    return incoming.select(
        *value_columns(incoming),
        date_literal(processing_date).alias(FROM_DATE),
        F.lit(OPEN_END).cast("date").alias(TO_DATE),
        *[F.coalesce(c, no_sources()).alias(c) for c in tracked],
    )


def add_record_id(df: DataFrame, partition_column: str = "", hash_mode: str = "safe") -> DataFrame:
    """Hash of all columns but the record id, ``to_date`` and lineage; so closing keeps the id.

    The id comes last, or right before the partition column.
    """
    body = [c for c in df.columns if c not in (RECORD_ID, LINEAGE)]
    record_id = row_hash(df, [c for c in body if c != TO_DATE], hash_mode).alias(RECORD_ID)
    tail = [partition_column] if partition_column else []
    lineage = [LINEAGE] if LINEAGE in df.columns else []
    return df.select(*[c for c in body if c not in tail], record_id, *tail, *lineage)
