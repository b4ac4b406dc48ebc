"""Read a layered table as declared: format, history mode, null tokens, clean names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerloom.catalog import TableDef
from layerloom.constants import OPEN_END, TO_DATE
from layerloom.functions.naming import clean_column_names
from layerloom.sources import storage

# The CSV dialects, the null tokens and the two history modes.
CSV_DIALECTS = {
    "csv": {"sep": ",", "quote": '"', "escape": '"'},
    "csv_pipe_sep": {"sep": "|", "quote": '"', "escape": '"'},
    "multiline": {"sep": ";", "quote": "~", "escape": "~"},
}
NULL_TOKENS = ("NA", "nan")
HISTORY_MODES = ("recent", "complete")
ALL_PARTITIONS = "all"


def read_table(
    spark: SparkSession,
    table: TableDef,
    path: str,
    partition: str = "",
    history: str = "recent",
) -> DataFrame:
    """The stored rows; a table that was never written reads as empty with its declared schema."""
    check_history_mode(history)
    if table.partition_column and not partition:
        raise ValueError(f"Table {table.name} is partitioned: name a partition")
    if table.file_format != "parquet" and table.file_format not in CSV_DIALECTS:
        raise ValueError(f"Unsupported file format: {table.file_format}")

    df = keep_history(_load(spark, table, path, partition), history)
    if table.container == "landingzone":
        df = null_tokens(df)
    return clean_column_names(df)


def check_history_mode(history: str) -> None:
    if history not in HISTORY_MODES:
        raise ValueError(f"{history} is not a history mode, use one of {HISTORY_MODES}")


def keep_history(df: DataFrame, history: str) -> DataFrame:
    """``recent`` keeps the open rows (the filter reaches the Parquet scan), ``complete`` all rows."""
    check_history_mode(history)
    if history == "recent" and TO_DATE in df.columns:
        return df.where(F.col(TO_DATE) == F.lit(OPEN_END).cast("date"))
    return df


def _load(spark: SparkSession, table: TableDef, path: str, partition: str) -> DataFrame:
    single = bool(table.partition_column) and partition != ALL_PARTITIONS
    if single and table.file_format == "parquet":
        # The folder of the partition itself, so that a swap under way does not hide it.
        place = storage.readable(spark, partition_path(path, table, partition))
        if place is None:
            return empty(spark, table.stored_columns)
        kinds = {f.name: f.dataType for f in table.stored_columns.fields}
        inside = T.StructType([f for f in table.stored_columns.fields if f.name != table.partition_column])
        value = F.lit(partition).cast(kinds[table.partition_column])
        df = spark.read.schema(inside).parquet(place).withColumn(table.partition_column, value)
        # Folders inside the partition may state more columns.
        more = [c for c in df.columns if c not in table.stored_columns.names]
        return df.select(*table.stored_columns.names, *more)
    place = storage.readable(spark, path)
    if place is None:
        return empty(spark, table.stored_columns)
    if table.file_format == "parquet":
        return spark.read.schema(table.stored_columns).parquet(place)
    return read_csv(spark, place, table.columns, table.file_format, table.multiline)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    dialect: str = "csv",
    multiline: bool | None = None,
) -> DataFrame:
    """CSV with a header; a value that does not fit the declared type is an error.

    Unless ``multiline`` says otherwise only the dialect of that name has line breaks in quotes; files
    of the others split over many tasks. Without ``multiline`` quoted line breaks fail
    instead of being misread.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("multiLine", dialect == "multiline" if multiline is None else multiline)
        .options(**CSV_DIALECTS[dialect])
        .csv(path)
    )


def null_tokens(df: DataFrame) -> DataFrame:
    """Turn the null tokens of text columns into nulls."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.replace(dict.fromkeys(NULL_TOKENS), subset=text) if text else df


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, in a form the optimizer can prune joins and unions with."""
    return spark.range(0).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    ).where(F.lit(False))


def partition_path(path: str, table: TableDef, partition: str) -> str:
    return storage.join(path, f"{table.partition_column}={partition}")
