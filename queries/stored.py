"""Tables written through the whole path on two days, then read back from storage."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom import TableCatalog, TableDef, Workspace
from layerloom.catalog import struct_of, with_history
from layerloom.constants import OPEN_END
from layerloom.operators import writing
from layerloom.operators.quality import FILLED_TEXT
from queries.common import load, own_folder, sql_hash

DAY1, DAY2 = dt.date(2026, 1, 15), dt.date(2026, 1, 16)
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_priority"]


def _table(name: str, columns: str, *gates: dict) -> TableDef:
    topic, layer = name.split("_")
    return TableDef(
        name, f"{layer}_layer", layer, topic, "parquet", with_history(struct_of(columns)), "", gates
    )


TABLES = (
    _table(
        "orders_raw",
        "long o_orderkey o_custkey\nstring o_orderstatus o_priority",
        {"check": "values are unique", "columns": ["o_orderkey"]},
        {"check": "values have format", "columns": ["o_orderstatus"], "format": "^[FOP]$"},
    ),
    _table("customers_raw", "long c_custkey\nstring segment"),
    _table("counts_datamodel", "string segment\nlong n"),
    _table("orders_datamodel", "long o_orderkey\nstring segment o_orderstatus"),
)


def _workspace(spark: SparkSession, folder: str) -> Workspace:
    """A workspace of its own with orders of two days, customers and a joined table."""
    space = Workspace(spark, own_folder(spark), catalog=TableCatalog.default().register(*TABLES))
    orders = load(spark, folder, "orders").withColumn(
        "o_priority", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    )
    early = orders.where("o_orderdate < timestamp_ntz'2001-01-01'").select(*ORDER_COLUMNS)
    status = F.when(F.col("o_orderstatus") == "P", "F").otherwise(F.col("o_orderstatus"))
    late = orders.where("o_orderpriority <> '4-NOT SPECIFIED'").withColumn("o_orderstatus", status)
    customers = load(spark, folder, "customer").select(
        "c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment")
    )
    space.on(DAY1).frame("orders_raw", early).write()
    space.on(DAY1).frame("customers_raw", customers).write()
    space.on(DAY2).frame("orders_raw", late.select(*ORDER_COLUMNS)).write()
    return space.on(DAY2)


def stored_history(spark: SparkSession, folder: str) -> DataFrame:
    return _workspace(spark, folder).read("orders_raw", history="complete").data


def stored_edges(spark: SparkSession, folder: str) -> DataFrame:
    space = _workspace(spark, folder)
    customers = space.read("customers_raw").select("c_custkey", "segment")
    joined = (
        space.read("orders_raw")
        .select(*ORDER_COLUMNS)
        .join(customers, left_on="o_custkey", right_on="c_custkey", how="left")
        .select("o_orderkey", "segment", "o_orderstatus")
    )
    space.frame("orders_datamodel", joined).write()
    return writing.stored_edges(space, "orders_datamodel")


def stored_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _workspace(spark, folder).read("monitoring_values", "orders_raw", history="complete").data


def stored_self_update(spark: SparkSession, folder: str) -> DataFrame:
    """Edges of a grouped table that is written back to itself, into files that replace its own source."""
    space = Workspace(spark, own_folder(spark), catalog=TableCatalog.default().register(*TABLES))
    customers = load(spark, folder, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    space.on(DAY1).frame("customers_raw", customers).write()
    counted = space.on(DAY1).read("customers_raw").group_by(["segment"], F.count(F.lit(1)).alias("n"))
    space.on(DAY1).frame("counts_datamodel", counted).write()
    doubled = (
        space.on(DAY2)
        .read("counts_datamodel")
        .group_by(["segment"], (F.sum("n") * 2).alias("n"))
    )
    space.on(DAY2).frame("counts_datamodel", doubled).write()
    return writing.stored_edges(space.on(DAY2), "counts_datamodel")


_SEGMENT_IDS = f"""
WITH s AS (SELECT c_mktsegment AS segment, count(*) AS n, 2 * count(*) AS twice FROM customer GROUP BY c_mktsegment),
ids AS (SELECT segment, {sql_hash("segment", "n", f"date '{DAY1}'")} AS early,
               {sql_hash("segment", "twice", f"date '{DAY2}'")} AS late FROM s)"""

STORED_SELF_UPDATE_SQL = f"""{_SEGMENT_IDS}
SELECT {sql_hash("c_custkey", "c_mktsegment", f"date '{DAY1}'")} AS "source_RecordID",
       'customers_raw' AS source_table_name, early AS "target_RecordID", 'counts_datamodel' AS target_table_name
FROM customer JOIN ids ON segment = c_mktsegment
UNION ALL SELECT early, 'counts_datamodel', late, 'counts_datamodel' FROM ids
"""

_STATES = f"""
WITH o AS (SELECT *, nullif(o_orderpriority, '5-LOW') AS o_priority FROM orders),
d1 AS (SELECT {", ".join(ORDER_COLUMNS)} FROM o WHERE o_orderdate < timestamp '2001-01-01'),
d2 AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
              o_priority FROM o WHERE o_orderpriority <> '4-NOT SPECIFIED'),
versions AS (
  SELECT coalesce(b.o_orderkey, a.o_orderkey) AS o_orderkey, coalesce(b.o_custkey, a.o_custkey) AS o_custkey,
         coalesce(b.o_orderstatus, a.o_orderstatus) AS o_orderstatus, coalesce(b.o_priority, a.o_priority) AS o_priority,
         CASE WHEN a.o_orderkey IS NULL THEN date '{DAY2}' ELSE date '{DAY1}' END AS from_date,
         CASE WHEN b.o_orderkey IS NULL THEN date '{DAY2}' ELSE date '{OPEN_END}' END AS to_date
  FROM d1 a FULL JOIN d2 b ON a.o_orderkey = b.o_orderkey AND a.o_orderstatus = b.o_orderstatus),
stored AS (SELECT *, {sql_hash(*ORDER_COLUMNS, "from_date")} AS "RecordID" FROM versions)"""

STORED_EDGES_SQL = f"""{_STATES},
c AS (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer),
ids AS (SELECT c_custkey AS k, segment, {sql_hash("c_custkey", "segment", f"date '{DAY1}'")} AS cid FROM c),
j AS (SELECT stored."RecordID" AS oid, cid,
             {sql_hash("o_orderkey", "segment", "o_orderstatus", f"date '{DAY2}'")} AS target
      FROM stored LEFT JOIN ids ON o_custkey = k WHERE to_date = date '{OPEN_END}')
SELECT oid AS "source_RecordID", 'orders_raw' AS source_table_name, target AS "target_RecordID",
       'orders_datamodel' AS target_table_name FROM j
UNION ALL SELECT cid, 'customers_raw', target, 'orders_datamodel' FROM j WHERE cid IS NOT NULL
"""


def _counts_sql(day: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT cast({position} AS bigint) AS signalling_id, 'dq_1' AS check_id, '{column}' AS column_name,
            '{FILLED_TEXT}' AS check_name, count(*) AS total_count, count({column}) AS valid_count,
            'orders_raw' AS table_name FROM {day}"""
        for position, column in enumerate(sorted(ORDER_COLUMNS), start=1)
    )


_METRIC_ID = sql_hash(
    "signalling_id", "check_id", "column_name", "check_name", "total_count", "valid_count", "table_name", "from_date"
)
STORED_METRICS_SQL = f"""{_STATES},
m AS (SELECT *, date '{DAY1}' AS from_date, date '{DAY2}' AS to_date FROM ({_counts_sql("d1")})
      UNION ALL SELECT *, date '{DAY2}', date '{OPEN_END}' FROM ({_counts_sql("d2")}))
SELECT *, {_METRIC_ID} AS "RecordID" FROM m
"""

QUERIES = {
    "stored_history": (stored_history, f"{_STATES} SELECT * FROM stored"),
    "stored_edges": (stored_edges, STORED_EDGES_SQL),
    "stored_self_update": (stored_self_update, STORED_SELF_UPDATE_SQL),
    "stored_metrics": (stored_metrics, STORED_METRICS_SQL),
}
