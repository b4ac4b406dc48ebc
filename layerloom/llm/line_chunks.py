"""Removal of multi-line passages that the corpus repeats, by content-defined chunks of lines.

A rolling hash over the hashes of three neighbouring lines ends a chunk where it is smaller than those of the lines on
both sides. So boundaries depend on the lines around them alone, a passage that moved is cut as before, and every chunk of
a text with several lines has several. Chunks are sorted by their bytes over the whole corpus, and all but the first of
equal ones are removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.llm.block_names import name_keys
from layerloom.llm.scratch import Scratch

#: A line that ends a chunk has the smallest rolling hash of this many lines on either side, so a chunk has more lines than
#: that, and ``2 * RADIUS + 1`` on average.
RADIUS = 1

#: Lines of a rolling hash, the factor for each line further back, and the prime that mixes their sum.
WINDOW, FACTOR, PRIME = 3, 31, 1_000_003


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n")


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("long")


def _rolled(hashes: str) -> Column:
    """The rolling hash that ends at each line; lines ahead of the text count as 0."""
    at = lambda i: F.coalesce(F.get(F.col(hashes), i), F.lit(0))
    return F.transform(
        F.sequence(F.lit(0), F.size(hashes) - 1),
        lambda i: sum((at(i - k) * FACTOR**k for k in range(1, WINDOW)), at(i)) % PRIME,
    )


def _ends(rolled: str, radius: int) -> Column:
    """Places of the last line of each chunk, from 0."""
    # The first and the last chunk are as long as the others at least.
    last = F.size(rolled) - 1
    inside = F.when(last > 2 * radius, F.sequence(F.lit(radius), last - 1 - radius)).otherwise(
        F.array().cast("array<int>")
    )
    lowest = lambda start: F.array_min(F.slice(F.col(rolled), start, F.lit(radius)))
    # Places count from 0, slices from 1. Of equal neighbours none is smaller, so a run of one line is not cut.
    smaller = lambda i: F.get(F.col(rolled), i) < F.least(lowest(i - radius + 1), lowest(i + 2))
    return F.concat(F.filter(inside, smaller), F.array(last))


def chunks(docs: DataFrame, *, text_column: str = "text", radius: int = RADIUS) -> DataFrame:
    """The chunks of each text: all columns but the text, and place, start, n_lines and chunk."""
    rest = [c for c in docs.columns if c != text_column]
    cut = (
        docs.select(*rest, _lines(text_column).alias("_lines"))
        .withColumn("_hashes", F.transform("_lines", _line_hash))
        .withColumn("_rolled", _rolled("_hashes"))
        .withColumn("_ends", _ends("_rolled", radius))
        # There always is an end. The outer form keeps the optimizer from testing so ahead of the
        # projections, where it would compute the hashes anew for each line.
        .select(*rest, "_lines", "_ends", F.posexplode_outer("_ends").alias("place", "_end"))
        .withColumn("start", F.coalesce(F.get("_ends", F.col("place") - 1) + 1, F.lit(0)))
        .withColumn("n_lines", F.col("_end") - F.col("start") + 1)
    )
    chunk = F.array_join(F.slice("_lines", F.col("start") + 1, F.col("n_lines")), "\n")
    return cut.select(*rest, "place", "start", "n_lines", chunk.alias("chunk"))


def repeated_chunks(docs: DataFrame, scratch: Scratch, *, radius: int = RADIUS) -> DataFrame:
    """(row_id, start, n_lines) of chunks of several lines that are not the first of their bytes.

    ``docs`` has row_id (unique), doc_id and text.
    """
    several = chunks(docs, radius=radius).where("n_lines > 1").where(F.col("chunk").rlike(r"[^\x20\x09-\x0D]"))
    named = scratch.write(name_keys(scratch, several, ["chunk"], ["row_id", "place"]))
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("id"), "row_id", "place")
    groups = scratch.write(
        named.groupBy("name")
        .agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("name", F.col("first.row_id").alias("first_row"), F.col("first.place").alias("first_place"))
    )
    return (
        named.join(groups, "name")
        .where("row_id != first_row OR place != first_place")
        .select("row_id", "start", "n_lines")
    )


def drop_repeated_chunks(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    row_column: str | None = None,
    radius: int = RADIUS,
) -> DataFrame:
    """One row per input row: doc_id, text without repeated chunks, n_lines and n_removed (lines before, removed).

    Lines end at line feeds. Of equal chunks of at least two lines that are not white space throughout, the one of the
    smallest doc_id stays (a null id comes last, then the order of rows, then the place), wherever the others are. A text
    of one line has no such chunk, and a run of one repeated line is one chunk. A text of any length is one row.
    ``row_column`` is as in ``Scratch.numbered``.
    A null text counts as empty and stays empty. Repeated rows are rows of their own, so the later ones
    lose their chunks. Other columns are ignored, whatever their names. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession)
    taken = docs.select(
        *([F.col(row_column).alias("row")] if row_column else []),
        F.col(id_column).alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    rows = scratch.numbered(taken, "row_id", "row" if row_column else None)
    repeated = repeated_chunks(rows, scratch, radius=radius)
    by_row = scratch.write(
        repeated.groupBy("row_id").agg(
            F.flatten(
                F.collect_list(F.sequence("start", F.col("start") + F.col("n_lines") - 1))
            ).alias("gone")
        )
    )
    joined = rows.join(by_row, "row_id", "left").withColumn("gone", F.coalesce("gone", F.array().cast("array<int>")))
    kept = F.array_except(F.sequence(F.lit(0), F.size(_lines("text")) - 1), F.col("gone"))
    text = F.when(F.size("gone") == 0, F.col("text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(F.col("_lines"), i)), "\n")
    )
    return joined.withColumn("_lines", _lines("text")).select(
        "doc_id",
        text.alias("text"),
        F.size("_lines").alias("n_lines"),
        F.size("gone").alias("n_removed"),
    )
