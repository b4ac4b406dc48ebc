"""Dense ranks of large groups without sorting a group in one task.

A window ordered over a whole table, or over a group that holds a third of it, sorts that group in a
single task. Here the rows are cut into ranges of (group, value) instead and sorted in each. Rows of one
value may lie in several ranges, so a value that fills most of the table is spread, too. The part of a group
inside a range is a run. A row knows its rank within its run; what comes before the run, and the size of
the whole group, follow from sums over the runs, of which there are no more than groups and ranges
together.

Both the ranks and the runs read one shuffle of the rows, which Spark reuses; it finds the cuts when it
runs.

Ranks of one value in several groupings (``range_ranks``) need one shuffle, too: rows are cut into ranges of the value
alone, and a task counts the values of each group in its range. Rows are repeated once per grouping only afterwards.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

# Tasks carry the functions of this module with them, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: What names a run: hashes of the group and of the first value, and where the first row came from.
RUN = ("_run_group", "_run_value", "_run_part")
_ADDED = [T.StructField(c, T.LongType()) for c in (*RUN, "_local")]


def _hash(columns: Sequence[str]) -> Column:
    """64 bits of the values; sorted neighbours that differ differ here, too. Nulls count by their place."""
    return F.xxhash64(*[part for c in columns for part in (F.col(c), F.col(c).isNull())], F.lit(0))


def _changes(words: np.ndarray, last: int | None) -> np.ndarray:
    """Where a row differs from the one before."""
    return np.concatenate([[last is None or words[0] != last], words[1:] != words[:-1]])


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a range with the first row of their run and their rank in it."""
    group = value = None
    run, held = np.zeros(3, np.int64), 0
    for batch in batches:
        if not batch.num_rows:
            continue
        groups, values, parts = (batch.column(c).to_numpy().astype(np.int64) for c in ("_group_hash", "_value_hash", "_part"))
        starts = _changes(groups, group)
        seen = np.cumsum(_changes(values, value) | starts)
        # Place of the first row of the run; 0 stands for the run that began in an earlier batch.
        at = np.maximum.accumulate(np.where(starts, np.arange(1, len(groups) + 1), 0))
        local = np.where(at > 0, seen - seen[np.maximum(at - 1, 0)] + 1, seen + held)
        begun = np.vstack([run, np.column_stack([groups, values, parts])])[at]
        kept = batch.drop_columns(["_group_hash", "_value_hash", "_part"])
        added = [pa.array(np.ascontiguousarray(x)) for x in (*begun.T, local.astype(np.int64))]
        yield pa.RecordBatch.from_arrays([*kept.columns, *added], names=[*kept.schema.names, *[f.name for f in _ADDED]])
        group, value, run, held = groups[-1], values[-1], begun[-1], int(local[-1])


def with_dense_rank(
    df: DataFrame, by: Sequence[str], value: str, ranges: int | None = None
) -> DataFrame:
    """Attach ``dense_rank``, ``distinct_count`` and ``row_count`` of the group to every row.

    A null counts as a value and ranks first, NaN ranks last, -0.0 and 0.0 are one value. The rows are shuffled
    once, into ``ranges`` ranges (as many as Spark shuffles into by default); runs are joined by a broadcast
    where they are few.
    """
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumns({"_group_hash": _hash(by), "_value_hash": _hash([value]), "_part": F.spark_partition_id()})
    order = [*by, value, "_part"]
    ranked = (
        keyed.repartitionByRange(ranges, *order)
        .sortWithinPartitions(*order)
        .mapInArrow(_numbered, T.StructType([*df.schema.fields, *_ADDED]))
    )
    runs = ranked.groupBy(*by, *RUN).agg(
        F.max("_local").alias("_n"),
        F.count(F.lit(1)).alias("_m"),
        F.min_by(value, "_local").alias("_first"),
        F.max_by(value, "_local").alias("_last"),
    )
    group = Window.partitionBy(*by)
    ordered = group.orderBy(F.asc_nulls_first("_first"), "_run_part")
    # A value that goes on from one run to the next is counted in both.
    before = F.lag(F.struct("_last")).over(ordered)
    again = before.isNotNull() & before["_last"].eqNullSafe(F.col("_first"))
    counted = runs.withColumn("_again", again.cast("bigint"))
    offsets = counted.select(
        *[F.col(c).alias(f"{c}_of") for c in RUN],
        (F.sum(F.col("_n") - F.col("_again")).over(ordered) - F.col("_n")).alias("_offset"),
        F.sum(F.col("_n") - F.col("_again")).over(group).alias("distinct_count"),
        F.sum("_m").over(group).alias("row_count"),
    )
    if not by:
        offsets = F.broadcast(offsets)  # one run for each range
    same = [F.col(c) == F.col(f"{c}_of") for c in RUN]
    # Cuts made twice may differ, and a row would belong to no run then: an error, never a lost row.
    unknown = F.raise_error(F.lit("Ranks need spark.sql.exchange.reuse: rows and runs must share one shuffle"))
    offset = F.when(F.col("_offset").isNull(), unknown.cast("bigint")).otherwise(F.col("_offset"))
    return ranked.join(offsets, same, "left").select(
        *df.columns, (F.col("_local") + offset).alias("dense_rank"), "distinct_count", "row_count"
    )


# -- one value, several groupings -----------------------------------------------------------------


class _Groups:
    """What a range has shown of the groups of one grouping so far: rank, last and first value and number of rows."""

    def __init__(self) -> None:
        self.held: dict[int, tuple[int, int, int, int]] = {}

    def ranks(self, groups: np.ndarray, values: np.ndarray) -> np.ndarray:
        """The rank of each row among the values of its group in this range; rows come sorted by value."""
        order = np.argsort(groups, kind="stable")
        group, value = groups[order], values[order]
        starts = _changes(group, None)
        first = np.flatnonzero(starts)
        last = np.append(first[1:], len(group)) - 1
        seen = np.cumsum(starts | _changes(value, None))
        before = [self.held.get(g) for g in group[first].tolist()]
        # A value that goes on from the batch before is counted there.
        base = [b[0] - (b[1] == v) if b else 0 for b, v in zip(before, value[first].tolist(), strict=True)]
        offset = np.asarray(base, np.int64) + 1 - seen[first]
        ranks = seen + np.repeat(offset, last - first + 1)
        found = zip(group[first].tolist(), before, ranks[last].tolist(), value[last].tolist(), value[first].tolist(), (last - first + 1).tolist(), strict=True)
        for name, b, rank, end, begin, n in found:
            self.held[name] = (rank, end, b[2] if b else begin, n + (b[3] if b else 0))
        placed = np.empty(len(order), np.int64)
        placed[order] = ranks
        return placed


def _ranks_of_range(n: int):
    """Rows of a range with their ranks in each of ``n`` groupings and the hash of the range's first row."""

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, start = [_Groups() for _ in range(n)], None
        for batch in batches:
            if not batch.num_rows:
                continue
            start = batch.column("_row_hash")[0].as_py() if start is None else start
            values = batch.column("_value_hash").to_numpy()
            ranks = [s.ranks(batch.column(f"_group{i}").to_numpy(), values) for i, s in enumerate(seen)]
            kept = batch.drop_columns(["_row_hash", "_value_hash", *[f"_group{i}" for i in range(n)]])
            added = [pa.array(np.full(batch.num_rows, start, np.int64)), *[pa.array(r.astype(np.int32)) for r in ranks]]
            names = [*kept.schema.names, "_start", *[f"_local{i}" for i in range(n)]]
            yield pa.RecordBatch.from_arrays([*kept.columns, *added], names=names)

    return ranked


_RUNS = "_range int, _start long, _set tinyint, _group long, _n long, _m long, _first long, _last long"


def _runs_of_range(n: int):
    """What a range holds of each group of ``n`` groupings: one row for each."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, at, start = [_Groups() for _ in range(n)], None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if start is None:
                at, start = batch.column("_range")[0].as_py(), batch.column("_row_hash")[0].as_py()
            values = batch.column("_value_hash").to_numpy()
            for i, groups in enumerate(seen):
                groups.ranks(batch.column(f"_group{i}").to_numpy(), values)
        for i, groups in enumerate(seen):
            if not groups.held:
                continue
            n_values, last, first, n_rows = (pa.array(c, pa.int64()) for c in zip(*groups.held.values(), strict=True))
            size = len(groups.held)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([at] * size, pa.int32()),
                    pa.array([start] * size, pa.int64()),
                    pa.array([i] * size, pa.int8()),
                    pa.array(list(groups.held), pa.int64()),
                    *(n_values, n_rows, first, last),
                ],
                names=["_range", "_start", "_set", "_group", "_n", "_m", "_first", "_last"],
            )

    return runs


def range_ranks(
    df: DataFrame, sets: Sequence[Sequence[str]], value: str, ranges: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Ranks of ``value`` within ranges, for groups formed by each of the ``sets`` of columns: rows and runs.

    The rows, each once, carry ``_range``, ``_start`` and a rank for each set; join or filter them as needed, and let
    ``per_set`` make ranks in whole groups of them. A task holds one entry for each group that its range has.
    """
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = df.withColumn("_part", F.spark_partition_id()).repartitionByRange(ranges, value, "_part")
    # Hashes are not shuffled. The number of a range orders ranges; its first row tells cuts made twice apart.
    hashes = [_hash(columns).alias(f"_group{i}") for i, columns in enumerate(sets)]
    ordered = spread.sortWithinPartitions(value, "_part").select(
        *df.columns,
        F.spark_partition_id().alias("_range"),
        _hash([value, "_part"]).alias("_row_hash"),
        _hash([value]).alias("_value_hash"),
        *hashes,
    )
    added = [T.StructField("_range", T.IntegerType()), T.StructField("_start", T.LongType())]
    added += [T.StructField(f"_local{i}", T.IntegerType()) for i in range(len(sets))]
    rows = ordered.mapInArrow(_ranks_of_range(len(sets)), T.StructType([*df.schema.fields, *added]))
    group = Window.partitionBy("_set", "_group")
    before = F.lag("_last").over(group.orderBy("_range"))
    counted = ordered.mapInArrow(_runs_of_range(len(sets)), _RUNS).withColumn(
        "_own", F.col("_n") - F.coalesce((before == F.col("_first")).cast("bigint"), F.lit(0))
    )
    runs = counted.select(
        *[F.col(c).alias(f"{c}_of") for c in ("_range", "_start", "_set", "_group")],
        (F.sum("_own").over(group.orderBy("_range")) - F.col("_n")).alias("_offset"),
        F.sum("_own").over(group).alias("distinct_count"),
        F.sum("_m").over(group).alias("row_count"),
    )
    return rows, runs


def per_set(rows: DataFrame, runs: DataFrame, sets: Sequence[Sequence[str]]) -> DataFrame:
    """Rows of ``range_ranks`` once per set: its number ``_set``, ``dense_rank``, ``distinct_count`` and ``row_count``.

    Runs stand on the left, so that Spark makes them first: where they turn out to be few, they are broadcast.
    """
    own = ["_range", "_start", *[f"_local{i}" for i in range(len(sets))]]
    kept = [c for c in rows.columns if c not in own]
    choices = [
        F.struct(F.lit(i).cast("tinyint").alias("_set"), _hash(columns).alias("_group"), F.col(f"_local{i}").alias("_local"))
        for i, columns in enumerate(sets)
    ]
    repeated = rows.select(*kept, "_range", "_start", F.inline(F.array(*choices)))
    same = [F.col(c) == F.col(f"{c}_of") for c in ("_range", "_start", "_set", "_group")]
    unknown = F.raise_error(F.lit("Ranks need spark.sql.exchange.reuse: rows and runs must share one shuffle"))
    offset = F.when(F.col("_offset").isNull(), unknown.cast("bigint")).otherwise(F.col("_offset"))
    return runs.join(repeated, same, "right").select(
        *kept, "_set", (F.col("_local") + offset).alias("dense_rank"), "distinct_count", "row_count"
    )
