"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.llm.scratch import Scratch


def _starred(links: DataFrame, scratch: Scratch) -> DataFrame:
    """Links each node's larger neighbours to the smallest of its neighbourhood."""
    both = links.union(links.select("b", "a"))
    lowest = scratch.write(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")))
    # A node of many links is split by the skewed-join rule: both sides are shuffled by the join alone.
    joined = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return joined.where("a != b").distinct()


def _gathered(links: DataFrame, scratch: Scratch) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    lowest = scratch.write(down.groupBy("a").agg(F.min("b").alias("m")))
    moved = down.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    kept = lowest.select("a", F.col("m").alias("b"))
    return moved.union(kept).where("a != b").distinct()


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for each node of ``links`` (a, b; integers, no nulls); root is its smallest node.

    Each round is written to the shared folder; the number of rounds grows with the logarithm of the
    longest chain. A node without links does not occur.
    """
    links = scratch.write(links.where("a != b").distinct())
    state = _state(links)
    while True:
        starred = scratch.write(_starred(links, scratch))
        links = scratch.write(_gathered(starred, scratch))
        now = _state(links)
        if now == state:
            break
        state = now
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        roots.select("node", F.col("node").alias("root"))
    )
