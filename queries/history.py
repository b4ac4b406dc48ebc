"""Row hashes, record ids and history merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.constants import FROM_DATE, OPEN_END, RECORD_ID, TO_DATE
from layerloom.functions.hashing import row_hash
from layerloom.operators.history import add_record_id, merge_history
from layerloom.sources.readers import keep_history
from queries.common import PROCESSING_DAY, load, sql_hash

VALUES = ["o_orderkey", "o_custkey", "o_orderstatus", "o_priority"]
BASE = """
SELECT o_orderkey, o_custkey, o_orderstatus, nullif(o_orderpriority, '5-LOW') AS o_priority,
       o_orderpriority, cast(o_orderdate AS date) AS day
FROM orders"""


def _base(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("o_priority"),
        "o_orderpriority",
        F.col("o_orderdate").cast("date").alias("day"),
    )


def row_hash_safe(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders").withColumn(
        "priority", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    )
    columns = ["o_custkey", "priority", "o_orderstatus", "o_totalprice", "o_orderdate"]
    return orders.select("o_orderkey", row_hash(orders, columns).alias("row_hash"))


ROW_HASH_SAFE_SQL = f"""
SELECT o_orderkey,
  {sql_hash("o_custkey", "nullif(o_orderpriority, '5-LOW')", "o_orderstatus", "o_totalprice", "o_orderdate")}
  AS row_hash
FROM orders
"""


def row_hash_nested(spark: SparkSession, folder: str) -> DataFrame:
    """Hashes of arrays, structs and maps, with nulls inside and out."""
    priority = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    orders = load(spark, folder, "orders").select(
        "o_orderkey",
        F.array("o_orderstatus", priority).alias("tags"),
        F.when(F.col("o_orderstatus") != "P", F.struct("o_custkey", priority.alias("p"))).alias("place"),
        F.create_map(F.lit("status"), F.col("o_orderstatus"), F.lit("priority"), priority).alias("facts"),
    )
    return orders.select("o_orderkey", row_hash(orders, ["tags", "place", "facts"]).alias("row_hash"))


def _sized(text: str) -> str:
    return f"coalesce(length({text}) || ':' || ({text}), '-')"


_PRIORITY, _STATUS = _sized("nullif(o_orderpriority, '5-LOW')"), _sized("o_orderstatus")
_TAGS = _sized(f"'[' || {_STATUS} || {_PRIORITY} || ']'")
_PLACE = _sized(f"CASE WHEN o_orderstatus <> 'P' THEN '(' || {_sized('cast(o_custkey AS varchar)')} || {_PRIORITY} || ')' END")
_FACTS = _sized(f"'{{6:status' || {_STATUS} || '8:priority' || {_PRIORITY} || '}}'")
ROW_HASH_NESTED_SQL = f"SELECT o_orderkey, sha256({_TAGS} || {_PLACE} || {_FACTS}) AS row_hash FROM orders"


def row_hash_concat(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders").withColumn(
        "priority", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    )
    columns = ["o_custkey", "priority", "o_orderstatus", "o_totalprice"]
    return orders.select("o_orderkey", row_hash(orders, columns, "concat").alias("row_hash"))


ROW_HASH_CONCAT_SQL = """
SELECT o_orderkey,
  sha256(concat_ws('|', o_custkey, nullif(o_orderpriority, '5-LOW'), o_orderstatus, o_totalprice)) AS row_hash
FROM orders
"""


def record_id(spark: SparkSession, folder: str) -> DataFrame:
    rows = _base(spark, folder).select(
        *VALUES,
        F.col("day").alias(FROM_DATE),
        F.lit(OPEN_END).cast("date").alias(TO_DATE),
        F.lit("orders").alias("table_name"),
    )
    return add_record_id(rows, partition_column="table_name")


RECORD_ID_SQL = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_priority, day AS from_date,
       date '{OPEN_END}' AS to_date, 'orders' AS table_name,
       {sql_hash(*VALUES, "day", "'orders'")} AS "RecordID"
FROM ({BASE})
"""

# (stored rows, stored to_date, incoming rows, incoming status) as SQL that both engines read.
CASES = {
    "unchanged": ("true", "NULL", "true", "o_orderstatus"),
    "added": ("day < date '1999-01-01'", "NULL", "true", "o_orderstatus"),
    "closed": ("true", "NULL", "o_orderpriority <> '4-NOT SPECIFIED'", "o_orderstatus"),
    # Changed rows close one version and open another; versions closed before may come back.
    "mixed": (
        "day < date '2001-01-01'",
        "CASE WHEN o_orderpriority = '1-URGENT' THEN date '2025-06-01' END",
        "o_orderpriority <> '4-NOT SPECIFIED'",
        "CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END",
    ),
}


def _merged(spark: SparkSession, folder: str, case: str) -> DataFrame:
    stored_rows, stored_end, incoming_rows, incoming_status = CASES[case]
    base = _base(spark, folder)
    stored = base.where(stored_rows).select(
        *VALUES,
        F.col("day").alias(FROM_DATE),
        F.coalesce(F.expr(stored_end), F.lit(OPEN_END)).cast("date").alias(TO_DATE),
        F.lit("stored").alias(RECORD_ID),
    )
    incoming = base.where(incoming_rows).withColumn("o_orderstatus", F.expr(incoming_status))
    return merge_history(incoming.select(*VALUES), stored, PROCESSING_DAY)


def _merged_sql(case: str) -> str:
    stored_rows, stored_end, incoming_rows, incoming_status = CASES[case]
    return f"""
WITH base AS ({BASE}),
stored AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_priority, day AS from_date,
                  coalesce({stored_end}, date '{OPEN_END}') AS to_date FROM base WHERE {stored_rows}),
incoming AS (SELECT o_orderkey, o_custkey, {incoming_status} AS o_orderstatus, o_priority
             FROM base WHERE {incoming_rows}),
current_rows AS (SELECT * FROM stored WHERE to_date = date '{OPEN_END}'),
merged AS (
  SELECT coalesce(i.o_orderkey, s.o_orderkey) AS o_orderkey, coalesce(i.o_custkey, s.o_custkey) AS o_custkey,
         coalesce(i.o_orderstatus, s.o_orderstatus) AS o_orderstatus, coalesce(i.o_priority, s.o_priority) AS o_priority,
         coalesce(s.from_date, date '{PROCESSING_DAY}') AS from_date,
         CASE WHEN i.o_orderkey IS NULL THEN date '{PROCESSING_DAY}' ELSE date '{OPEN_END}' END AS to_date
  FROM incoming i FULL JOIN current_rows s
    ON i.o_orderkey = s.o_orderkey AND i.o_custkey = s.o_custkey AND i.o_orderstatus = s.o_orderstatus
   AND coalesce(i.o_priority, 'none') = coalesce(s.o_priority, 'none')
  UNION ALL SELECT * FROM stored WHERE to_date <> date '{OPEN_END}')
SELECT * FROM merged"""


def _merge_query(case: str):
    return lambda spark, folder: _merged(spark, folder, case)


def _history_query(mode: str):
    return lambda spark, folder: add_record_id(keep_history(_merged(spark, folder, "mixed"), mode))


def _history_sql(condition: str) -> str:
    columns = ", ".join([*VALUES, FROM_DATE, TO_DATE])
    hashed = sql_hash(*VALUES, FROM_DATE)
    return f"""SELECT {columns}, {hashed} AS "RecordID" FROM ({_merged_sql("mixed")}) WHERE {condition}"""


QUERIES = {
    "row_hash_safe": (row_hash_safe, ROW_HASH_SAFE_SQL),
    "row_hash_nested": (row_hash_nested, ROW_HASH_NESTED_SQL),
    "row_hash_concat": (row_hash_concat, ROW_HASH_CONCAT_SQL),
    "record_id": (record_id, RECORD_ID_SQL),
    **{f"scd2_{case}": (_merge_query(case), _merged_sql(case)) for case in CASES},
    "history_recent": (_history_query("recent"), _history_sql(f"to_date = date '{OPEN_END}'")),
    "history_complete": (_history_query("complete"), _history_sql("true")),
}
