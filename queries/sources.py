"""Driver tables written as files of each CSV dialect and read back by the library."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.catalog import struct_of
from layerloom.sources import readers
from queries.common import load, own_folder

SCHEMA = "long o_orderkey\nstring note\ndouble o_totalprice"


def _notes(spark: SparkSession, folder: str, breaks: bool) -> DataFrame:
    """Orders with separators, quotes and, where the dialect has them, line breaks in their notes."""
    parts = [F.lit('says "'), F.col("o_orderpriority"), F.lit('", a|b;c~d'), F.col("o_orderstatus")]
    if breaks:
        parts.insert(2, F.lit("\nnext line "))
    note = F.when(F.col("o_orderkey") % 7 == 0, "NA").otherwise(F.concat(*parts))
    return load(spark, folder, "orders").select("o_orderkey", note.alias("note"), "o_totalprice")


def _csv_query(dialect: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        path = f"{own_folder(spark)}/{dialect}"
        notes = _notes(spark, folder, breaks=dialect == "multiline")
        notes.write.option("header", True).options(**readers.CSV_DIALECTS[dialect]).csv(path)
        return readers.null_tokens(readers.read_csv(spark, path, struct_of(SCHEMA), dialect))

    return run


def _csv_sql(breaks: str = "") -> str:
    return f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN
       'says "' || o_orderpriority || {breaks or "''"} || '", a|b;c~d' || o_orderstatus END AS note, o_totalprice
FROM orders
"""


QUERIES = {
    "csv_comma": (_csv_query("csv"), _csv_sql()),
    "csv_pipe": (_csv_query("csv_pipe_sep"), _csv_sql()),
    "csv_multiline": (_csv_query("multiline"), _csv_sql("chr(10) || 'next line '")),
}
