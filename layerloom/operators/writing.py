"""Store a table: merge history, add record ids, validate, publish, measure.

The merged rows are computed once and written once, into a staging folder next to the table. The job that
writes them counts row checks, fill grades and closed rows on its way; checks on groups, and the search
for copies among a table's first rows, read the staged columns they need. A violation leaves table, edges and metrics untouched. Rows with lineage are held on
executors meanwhile, and so is what their groupings were computed from, so that the new edges come from
the same evaluation; they are staged with the rows, in a folder Spark does not read as part of the table,
while the sources are still as they were: a table may be its own source. One rename publishes both; then
the edge files move into the edge table and metrics are written. Edges left behind by a writer that died
are moved by the next one. Running the same write again is harmless: rows are recognised as unchanged,
and only edges that are missing get added.

Edges of a table are kept apart by the day their target row appeared, which never changes. A write compares
its edges with those of the days its open rows come from; rows of the day itself meet only what an
earlier run of that day left.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerloom.catalog import TableDef
from layerloom.constants import FROM_DATE, HISTORY_COLUMNS, LINEAGE, OPEN_END, RECORD_ID, TO_DATE
from layerloom.operators import lineage, quality
from layerloom.operators.history import COPIES_ERROR, add_record_id, first_history, merge_history
from layerloom.operators.tracked import TrackedFrame
from layerloom.session import cleaned, release_shuffles
from layerloom.sources import readers, storage
from layerloom.workspace import Workspace

METRICS_TABLE = "monitoring_values"
EDGES_TABLE = "record_tracing"
#: Record ids are hexadecimal digits: only a codec that counts symbols halves them.
CODEC = "zstd"
#: Bytes of stored rows whose edges one task writes.
EDGES_OF_TASK = 16 << 20
EDGE_SCHEMA = ", ".join([*[f"`{c}` string" for c in lineage.EDGE_COLUMNS], f"`{lineage.TARGET_DAY}` date"])


def compare_with_stored(frame: TrackedFrame, processing_date: dt.date | None = None) -> DataFrame:
    """Incoming rows merged into the complete stored history."""
    space, table = frame.workspace, frame.table
    stored = readers.read_table(
        space.spark, table, space.path(table), frame.partition, history="complete"
    )
    return merge_history(frame.df, stored, processing_date or space.today())


def validate_structure(df: DataFrame, table: TableDef) -> None:
    """Names, types and order must be those of the definition; nothing is read."""
    _require_columns(df, table, ignored=(LINEAGE,))


def validate_values(df: DataFrame, table: TableDef) -> None:
    """The same for rows that have no history yet: a merge would hide a wrong type."""
    _require_columns(df, table, ignored=(LINEAGE, *HISTORY_COLUMNS))


def _require_columns(df: DataFrame, table: TableDef, ignored: tuple[str, ...]) -> None:
    actual, declared = (
        [(f.name, f.dataType) for f in schema.fields if f.name not in ignored]
        for schema in (df.schema, table.stored_columns)
    )
    if actual != declared:
        raise ValueError(
            f"The structure of {table.name} does not match its definition: "
            f"got {_shown(actual)}, declared {_shown(declared)}"
        )


def _shown(columns: list[tuple[str, T.DataType]]) -> str:
    return ", ".join(f"{name} {kind.simpleString()}" for name, kind in columns)


def check_distinct_rows(df: DataFrame) -> None:
    """No row may occur twice. The record id stands for every column but ``to_date``."""
    twice = df.groupBy(lineage.packed(F.col(RECORD_ID)).alias("_id"), TO_DATE).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not twice.isEmpty():
        raise ValueError(COPIES_ERROR)


def check_distinct_ids(ids: DataFrame) -> None:
    """No record id may occur twice among a table's first rows: they appeared on one day, so equal ids are equal rows."""
    twice = ids.groupBy(lineage.packed(F.col(RECORD_ID)).alias("_id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not twice.isEmpty():
        raise ValueError(COPIES_ERROR)


def validate(df: DataFrame, table: TableDef) -> None:
    """Structure, distinct rows and the blocking gate."""
    validate_structure(df, table)
    check_distinct_rows(df)
    quality.check_blocking(df, table.quality_checks)


def write_table(frame: TrackedFrame) -> TrackedFrame:
    """Write the frame as the new state of its table and return the stored table."""
    space, table = frame.workspace, frame.table
    if space is None or table is None:
        raise ValueError("Only a frame of a workspace table can be written")
    if table.partition_column and not frame.partition:
        raise ValueError(f"Table {table.name} is partitioned: name a partition")
    if frame.partition == readers.ALL_PARTITIONS:
        raise ValueError("One partition is written at a time")
    space = space.on(space.today())
    if table.partition_column and table.partition_column not in frame.df.columns:
        frame = frame.with_df(frame.df.withColumn(table.partition_column, F.lit(frame.partition)))

    validate_values(frame.df, table)
    target = space.path(table, frame.partition if table.partition_column else "")
    staged_path = storage.staging_path(target)
    storage.recover(space.spark, target)
    _append_edges(space, table, target)
    is_first = storage.readable(space.spark, target) is None
    states = first_history(frame.df, space.processing_date) if is_first else compare_with_stored(frame, space.processing_date)
    merged = add_record_id(states, table.partition_column)
    validate_structure(merged, table)
    # The folder name states the partition, so its column is not stored in the files.
    hidden = [c for c in (table.partition_column, LINEAGE) if c]
    kept = [merged] if frame.is_tracked else []
    if kept:
        release_shuffles(space.spark)  # of tables written before
    try:
        with cleaned(space.spark), lineage.held(*kept, origin=frame.origin):
            counter = quality.RowCounter(
                merged, table.quality_checks, table.signalling_checks, space.processing_date
            )
            ordered = merged
            if table.sorted_by:
                ordered = merged.repartitionByRange(*table.sorted_by).sortWithinPartitions(*table.sorted_by)
            _stage(counter.watch(ordered).drop(*hidden), staged_path)
            seen = counter.result()
            staged = space.spark.read.schema(merged.drop(*hidden).schema).parquet(staged_path)
            if is_first:
                # No join has shown copies; of the staged rows nothing but their ids is read.
                check_distinct_ids(staged.select(RECORD_ID))
            elif seen.closed:
                # Incoming copies fail above and stored rows are distinct, so only rows closed today can clash.
                check_distinct_rows(staged.where(F.col(TO_DATE) == F.lit(space.processing_date)))
            quality.check_blocking(staged, table.quality_checks, seen)
            if frame.is_tracked:
                _stage_edges(space, frame, merged, staged, staged_path)
        storage.swap_in(space.spark, staged_path, target)
    except Exception:
        storage.delete(space.spark, staged_path)
        raise
    _append_edges(space, table, target)
    if table.name != METRICS_TABLE:
        publish_metrics(space, table.name, frame.partition, seen)
    return space.read(table.name, frame.partition, frame.history)


def _stage(rows: DataFrame, path: str) -> None:
    try:
        rows.write.option("compression", CODEC).parquet(path)
    except PySparkException as error:
        if _mentions(error, COPIES_ERROR):
            raise ValueError(COPIES_ERROR) from error
        raise


def _mentions(error: BaseException | None, text: str) -> bool:
    return error is not None and (text in str(error) or _mentions(error.__cause__, text))


def _stage_edges(
    space: Workspace, frame: TrackedFrame, merged: DataFrame, staged: DataFrame, path: str
) -> None:
    """Put the edges that are not stored yet next to the staged rows, by the day of their target."""
    is_open = F.col(TO_DATE) == F.lit(OPEN_END).cast("date")
    days = [row[0] for row in staged.where(is_open).select(FROM_DATE).distinct().collect()]
    edges = lineage.open_edges(merged, frame.origin, frame.name)
    fresh = lineage.new_edges(edges, stored_edges(space, frame.table.name, days))
    if not frame.origin.groups:
        # No shuffle lies between the held rows and their edges that would put small pieces together.
        tasks = storage.size(space.spark, path) // EDGES_OF_TASK + space.spark.sparkContext.defaultParallelism
        fresh = fresh.coalesce(tasks)
    writer = fresh.drop(lineage.TARGET_TABLE).write.option("compression", CODEC)
    writer.partitionBy(lineage.TARGET_DAY).parquet(_edges_of(path))


def _edges_of(path: str) -> str:
    """Edges that belong to the rows of a folder; Spark does not read it with the rows."""
    return storage.join(path, "_edges")


def _append_edges(space: Workspace, table: TableDef, target: str) -> None:
    """Bring edges that were published with the rows into the edge table."""
    staged = _edges_of(target)
    if storage.exists(space.spark, staged):
        publish_edges(space, table, staged)
        storage.delete(space.spark, staged)


def stored_edges(
    space: Workspace, target: str, days: Sequence[dt.date] | None = None
) -> DataFrame:
    """Stored edges into one table, or into all tables for ``all``.

    ``days`` names the days on which the targets appeared; only the folders of these days are read.
    """
    table = space.catalog.find(EDGES_TABLE)
    edges = readers.read_table(space.spark, table, space.path(table), target)
    if days is not None:
        if lineage.TARGET_DAY not in edges.columns:
            return edges.select(*lineage.EDGE_COLUMNS)
        edges = edges.where(F.col(lineage.TARGET_DAY).isin([*days]) if days else F.lit(False))
    return edges.select(*lineage.EDGE_COLUMNS)


def publish_edges(space: Workspace, table: TableDef, staged: str) -> None:
    """Move staged edge files into the folder of their target table; what has been moved is not moved again."""
    edge_table = space.catalog.find(EDGES_TABLE)
    # Straight into the partition folder: writes of other tables share nothing with this one.
    storage.move_files(space.spark, staged, space.path(edge_table, table.name))
    space.spark.catalog.refreshByPath(space.path(edge_table))


def publish_metrics(
    space: Workspace, name: str, partition: str = "", seen: quality.RowCounts | None = None
) -> None:
    """Measure the open rows of a stored table and record the result with history.

    ``seen`` holds what was counted while these rows were written.
    """
    table = space.catalog.find(name)
    rows = readers.read_table(space.spark, table, space.path(table), partition)
    if rows.columns != table.stored_columns.names:
        seen = None  # counted under the declared names, not under those the rows are read by
    metrics = quality.signalling_metrics(
        rows, table.signalling_checks, stored_edges(space, name), seen
    ).withColumn("table_name", F.lit(name))
    known = space.read(METRICS_TABLE, partition=name, history="complete").df
    numbered = quality.assign_signalling_ids(metrics, known)
    write_table(space.frame(METRICS_TABLE, numbered, partition=name))


def record_history(
    space: Workspace, starts: DataFrame, per_start: bool = False
) -> DataFrame:
    """Trace stored records (``table_name, RecordID``) back to their sources."""
    return lineage.trace(stored_edges(space, readers.ALL_PARTITIONS), starts, per_start)
