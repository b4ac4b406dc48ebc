"""Small relational helpers built from plain DataFrame operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join in which null keys meet; the key columns of the left side are kept."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    matches = []
    for key in keys:
        a, b = left[key], renamed[f"_r_{key}"]
        # A key that is never null on one side needs no null-safe form, which doubles the join keys.
        plain = not (left.schema[key].nullable and right.schema[key].nullable)
        matches.append(a == b if plain else a.eqNullSafe(b))
    condition = reduce(Column.__and__, matches, F.lit(True))
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first under ``order``.

    Spark cuts each input partition down to one row per key before the shuffle, so a hot key sends
    at most one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(window)).where("_n = 1").drop("_n")


def keep_lowest(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """All rows that share the lowest ``value`` of their group (nulls come first, ties stay).

    Equal to keeping ``dense_rank() = 1``, but the minimum is pre-aggregated and joined back, so no
    task has to hold a whole group.
    """
    lowest = df.groupBy(*keys).agg(
        F.min(value).alias("_low"), F.bool_or(F.col(value).isNull()).alias("_has_null")
    )
    joined = null_safe_join(df, lowest, keys)
    keep = F.when(F.col("_has_null"), F.col(value).isNull()).otherwise(F.col(value) == F.col("_low"))
    return joined.where(keep).drop("_low", "_has_null")


def first_value_by(
    df: DataFrame, keys: Sequence[str], order: str, value: str, output: str
) -> DataFrame:
    """One row per key: ``value`` at the lowest ``order`` (ties: the lowest value; nulls come first).

    Rows shrink to one per key and ``order`` before they are compared. Numbers and dates need no sort.
    """
    steps = df.groupBy(*keys, F.col(order).alias("_order")).agg(
        F.bool_or(F.col(value).isNull()).alias("_has_null"), F.min(value).alias("_low")
    )
    steps = steps.withColumn("_low", F.when(~F.col("_has_null"), F.col("_low")))
    unordered = F.col("_order").isNull()
    return steps.groupBy(*keys).agg(
        F.when(F.bool_or(unordered), F.max(F.when(unordered, F.col("_low"))))
        .otherwise(F.min_by("_low", "_order"))
        .alias(output)
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def same_schema(left: DataFrame, right: DataFrame) -> None:
    """Both sides must have the same column names and types; order does not matter."""
    a = {f.name: f.dataType for f in left.schema.fields}
    b = {f.name: f.dataType for f in right.schema.fields}
    if a != b:
        differing = sorted(set(a.items()) ^ set(b.items()), key=str)
        raise ValueError(f"Columns differ: {[(n, t.simpleString()) for n, t in differing]}")
