"""Exact duplicates by deterministic block naming.

A text is cut into blocks of a fixed number of bytes. All blocks of the corpus are sorted (by a hash, then
by their bytes) and each distinct block gets its place in that order as an integer name. Then the names of neighbouring blocks
are paired, and the pairs are sorted and named the same way, until each document has one name left. Two
texts of the same number of blocks have the same last name exactly when they are equal: names come
from comparing bytes, never from a hash.

One sort names all blocks of a level. Rows of a frequent block spread over range partitions, because
the row id breaks ties in the sort; a run of equal blocks that crosses partitions is joined again by
comparing the last block of one partition with the first of the next.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from layerloom.llm.scratch import Scratch

BLOCK_BYTES = 2048

WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: str) -> Column:
    """The text with each run of ASCII white space replaced by one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), WHITE_SPACE, " ")


def _blocks(data: Column, size: int) -> Column:
    last = F.greatest(F.lit(0), (F.octet_length(data) - 1).cast("int")) / size
    return F.transform(
        F.sequence(F.lit(0), F.floor(last).cast("int")),
        lambda i: F.substring(data, i * size + 1, F.lit(size)),
    )


def _labels(keys: Sequence[str], rest: Sequence[str]):
    """Numbers the runs of equal keys in a sorted partition from 0.

    Gives one row per input row, and at the end two rows that hold the first and last keys.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, run_no, last, first, schema = TaskContext.get().partitionId(), -1, None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            schema = batch.schema
            columns = [batch.column(k) for k in keys]
            changed = np.zeros(batch.num_rows, dtype=bool)
            for c in columns:
                changed[1:] |= pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(False)
            head = tuple(c[0].as_py() for c in columns)
            changed[0] = head != last
            first = first or head
            last = tuple(c[-1].as_py() for c in columns)
            numbers = run_no + np.cumsum(changed)
            run_no = int(numbers[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in rest]
                + [
                    pa.array(np.full(batch.num_rows, part, dtype=np.int32)),
                    pa.array(numbers),
                    pa.nulls(batch.num_rows, pa.int32()),
                ]
                + [pa.nulls(batch.num_rows, schema.field(k).type) for k in keys],
                names=[*rest, "part", "number", "edge", *keys],
            )
        if schema is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(2, schema.field(c).type) for c in rest]
                + [
                    pa.array([part] * 2, pa.int32()),
                    pa.array([0, run_no], pa.int64()),
                    pa.array([0, 1], pa.int32()),
                ]
                + [
                    pa.array([a, b], schema.field(k).type)
                    for k, a, b in zip(keys, first, last, strict=True)
                ],
                names=[*rest, "part", "number", "edge", *keys],
            )

    return run


def name_keys(scratch: Scratch, df: DataFrame, keys: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """Adds ``name``, a number from 0 for each distinct ``keys`` (never null), and drops the keys.

    Names follow the order of a 128-bit hash of the keys, then the keys, so they do not depend on partitions.
    Only keys compared byte by byte share a name. ``tie`` columns identify a row; they spread equal keys
    over partitions.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rest = [c for c in df.columns if c not in keys]
    schema = ", ".join(
        [f"`{c}` {kinds[c]}" for c in rest]
        + ["part int", "number bigint", "edge int"]
        + [f"`{k}` {kinds[k]}" for k in keys]
    )
    # Ranges are cut by hashes of the keys and the tie: their samples are small, whatever the keys are.
    hashes = [F.xxhash64(*keys), F.xxhash64(F.lit(1), *keys)]
    labelled = scratch.write(
        df.repartitionByRange(*hashes, *tie)
        .sortWithinPartitions(*hashes, *keys, *tie)
        .mapInArrow(_labels(keys, rest), schema)
    )
    edges = labelled.where(F.col("edge").isNotNull())
    firsts = edges.where("edge = 0").select("part", *keys)
    lasts = edges.where("edge = 1").select("part", F.col("number").alias("top"), *keys)
    # One row per partition from here on, without the keys where rows meet in one task.
    by_part = Window.orderBy("part")
    parts = lasts.select("part", "top").withColumn("before", F.lag("part").over(by_part))
    carried = (
        firsts.join(parts.select("part", "before"), "part")
        .join(lasts.select(F.col("part").alias("before"), *keys), ["before", *keys])
        .select("part", F.lit(1).alias("carried"))
    )
    shifts = (
        parts.join(carried, "part", "left")
        .withColumn("carried", F.coalesce("carried", F.lit(0)))
        .select(
            "part",
            (
                F.sum(F.col("top") + 1).over(by_part)
                - F.col("top")
                - 1
                - F.sum("carried").over(by_part)
            ).alias("shift"),
        )
    )
    # As many rows as partitions of the sort: bounded by the cluster, not by the data.
    return (
        labelled.where(F.col("edge").isNull())
        .join(F.broadcast(shifts), "part")
        .select(*rest, (F.col("number") + F.col("shift")).alias("name"))
    )


def duplicates(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    row_column: str | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per input row with the row that stays of its group of equal texts.

    Texts are compared after ``normalised``; null counts as empty, and all empty texts are equal. Of
    equal texts the row with the smallest id stays, a null id coming last; of repeated rows with the
    same id the first by ``row_column`` stays. ``row_column`` names a unique integer; without it rows are
    numbered as they are read. Other columns are ignored, whatever their names. An empty table gives no
    rows.

    Columns: row_id, doc_id, keep_id, group_size, kept, text_sha256, n_blocks, name. (n_blocks, name) is
    the identity of a text.
    """
    scratch = Scratch(docs.sparkSession)
    row = F.col(row_column) if row_column else F.monotonically_increasing_id()
    data = docs.select(
        row.cast("long").alias("row_id"),
        F.col(id_column).alias("doc_id"),
        normalised(text_column).cast("binary").alias("data"),
    )
    blocks = data.select(
        "row_id",
        "doc_id",
        F.sha2("data", 256).alias("text_sha256"),
        F.posexplode(_blocks(F.col("data"), block_bytes)).alias("pos", "block"),
        (F.floor((F.greatest(F.octet_length("data"), F.lit(1)) - 1) / block_bytes) + 1)
        .cast("int")
        .alias("n_blocks"),
    ).select(
        "row_id",
        "pos",
        "n_blocks",
        F.col("n_blocks").alias("left"),
        # What belongs to the document travels with its first block only.
        *[F.when(F.col("pos") == 0, F.col(c)).alias(c) for c in ("doc_id", "text_sha256")],
        "block",
    )
    named = scratch.write(name_keys(scratch, blocks, ["block"], ["row_id", "pos"]))
    about = ["row_id", "doc_id", "text_sha256", "n_blocks", "name"]
    done = [named.where("left = 1").select(*about)]
    longest = named.agg(F.max("n_blocks")).first()[0] or 0
    for _ in range(max(0, longest - 1).bit_length()):
        place = F.col("pos") % 2
        pairs = (
            named.where("left > 1")
            .groupBy("row_id", F.floor(F.col("pos") / 2).cast("int").alias("pos"))
            .agg(
                F.max("n_blocks").alias("n_blocks"),
                F.max(F.ceil(F.col("left") / 2)).cast("int").alias("left"),
                F.max("doc_id").alias("doc_id"),
                F.max("text_sha256").alias("text_sha256"),
                F.max(F.when(place == 0, F.col("name"))).alias("a"),
                F.coalesce(F.max(F.when(place == 1, F.col("name"))), F.lit(-1)).alias("b"),
            )
        )
        named = scratch.write(name_keys(scratch, pairs, ["a", "b"], ["row_id", "pos"]))
        done.append(named.where("left = 1").select(*about))
    documents = done[0]
    for more in done[1:]:
        documents = documents.unionByName(more)
    smallest = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("id"), "row_id"))
    groups = scratch.write(
        documents.groupBy("n_blocks", "name").agg(
            smallest.alias("first"), F.count(F.lit(1)).alias("group_size")
        )
    )
    return documents.join(groups, ["n_blocks", "name"]).select(
        "row_id",
        "doc_id",
        F.col("first.id").alias("keep_id"),
        "group_size",
        (F.col("row_id") == F.col("first.row_id")).alias("kept"),
        "text_sha256",
        "n_blocks",
        "name",
    )


def drop_duplicates(
    docs: DataFrame, *, row_column: str | None = None, **options
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; ``row_column`` as in ``Scratch.numbered``."""
    scratch, number = Scratch(docs.sparkSession), "_row_of_block_names"
    rows = scratch.numbered(docs, number, row_column)
    gone = duplicates(rows, row_column=number, **options).where("NOT kept")
    gone = scratch.write(gone.select(F.col("row_id").alias(number)))
    return rows.join(gone, number, "left_anti").select(*docs.columns)
