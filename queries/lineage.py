"""Joins, groupings and set operations that carry lineage; edges and traces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.constants import FROM_DATE, OPEN_END, RECORD_ID, TO_DATE
from layerloom.operators import lineage
from layerloom.operators.history import add_record_id
from layerloom.operators.relations import union_all
from layerloom.operators.tracked import TrackedFrame
from queries.common import (
    PROCESSING_DAY,
    cents,
    lineage_text,
    load,
    load_tracked,
    source_counts,
    sql_hash,
    with_source_counts,
)


def lineage_rollup(spark: SparkSession, folder: str) -> DataFrame:
    orders = load_tracked(spark, folder, "orders", "o_orderkey")
    customers = load_tracked(spark, folder, "customer", "c_custkey").select("c_custkey", "c_nationkey")
    nations = load_tracked(spark, folder, "nation", "n_nationkey").select("n_nationkey", "n_name")
    rollup = (
        orders.with_columns(order_year=F.year("o_orderdate"), price_cents=cents("o_totalprice"))
        .select("o_custkey", "order_year", "price_cents")
        .join(customers, left_on="o_custkey", right_on="c_custkey", how="left")
        .join(nations, left_on="c_nationkey", right_on="n_nationkey", how="left")
        .group_by(
            ["n_name", "order_year"],
            F.count(F.lit(1)).alias("n_rows"),
            F.avg("price_cents").alias("avg_cents"),
            F.max("price_cents").alias("max_cents"),
        )
    )
    return with_source_counts(rollup, ["n_name", "order_year"], "orders", "customer", "nation")


LINEAGE_ROLLUP_SQL = """
SELECT n_name, cast(year(o_orderdate) AS integer) AS order_year, count(*) AS n_rows,
       avg(cast(round(o_totalprice * 100) AS bigint)) AS avg_cents,
       max(cast(round(o_totalprice * 100) AS bigint)) AS max_cents,
       count(DISTINCT o_orderkey) AS n_orders, count(DISTINCT c_custkey) AS n_customer,
       count(DISTINCT n_nationkey) AS n_nation
FROM orders LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey
GROUP BY 1, 2
"""


def groupby_null_keys(spark: SparkSession, folder: str) -> DataFrame:
    orders = load_tracked(spark, folder, "orders", "o_orderkey").with_columns(
        priority=F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")), price_cents=cents("o_totalprice")
    )
    grouped = orders.group_by(
        ["priority", "o_orderstatus"],
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("price_cents").alias("sum_cents"),
    )
    return with_source_counts(grouped, ["priority", "o_orderstatus"], "orders")


GROUPBY_NULL_KEYS_SQL = """
SELECT nullif(o_orderpriority, '5-LOW') AS priority, o_orderstatus, count(*) AS n_rows,
       cast(sum(cast(round(o_totalprice * 100) AS bigint)) AS bigint) AS sum_cents,
       count(DISTINCT o_orderkey) AS n_orders
FROM orders GROUP BY 1, 2
"""


def tracked_distinct(spark: SparkSession, folder: str) -> DataFrame:
    lines = load_tracked(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    keys = ["l_suppkey", "l_returnflag", "flag"]
    distinct = (
        lines.with_columns(flag=F.nullif(F.col("l_linestatus"), F.lit("O"))).select(*keys).distinct()
    )
    return with_source_counts(distinct, keys, "lineitem")


TRACKED_DISTINCT_SQL = """
SELECT l_suppkey, l_returnflag, nullif(l_linestatus, 'O') AS flag,
       count(DISTINCT (l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS n_lineitem
FROM lineitem GROUP BY 1, 2, 3
"""


def tracked_union(spark: SparkSession, folder: str) -> DataFrame:
    """Customers by segment and priority, seen in orders and in their own table."""
    orders = load_tracked(spark, folder, "orders", "o_orderkey")
    placed = orders.where("o_orderstatus <> 'O'").select("o_custkey", "o_orderpriority")
    pending = orders.where("o_orderstatus <> 'F'").select("o_custkey", "o_orderpriority")
    customers = load_tracked(spark, folder, "customer", "c_custkey")
    known = customers.with_columns(o_custkey=F.col("c_custkey"), o_orderpriority=F.lit("5-LOW"))
    both = placed.union(pending).union(known.select("o_custkey", "o_orderpriority"))
    return with_source_counts(both, ["o_custkey", "o_orderpriority"], "orders", "customer")


TRACKED_UNION_SQL = """
SELECT o_custkey, o_orderpriority, count(DISTINCT o_orderkey) AS n_orders,
       count(DISTINCT c_custkey) AS n_customer
FROM (SELECT o_custkey, o_orderpriority, o_orderkey, NULL AS c_custkey FROM orders
      UNION ALL SELECT c_custkey, '5-LOW', NULL, c_custkey FROM customer)
GROUP BY 1, 2
"""


def tracked_average(spark: SparkSession, folder: str) -> DataFrame:
    lines = load_tracked(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    average = lines.average(["l_partkey"], "l_quantity", "avg_quantity")
    return with_source_counts(average, ["l_partkey"], "lineitem")


TRACKED_AVERAGE_SQL = """
SELECT l_partkey, avg(l_quantity) AS avg_quantity,
       count(DISTINCT (l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS n_lineitem
FROM lineitem GROUP BY 1
"""


def grouped_twice(spark: SparkSession, folder: str) -> DataFrame:
    """Lineage through a grouping, a join and a second grouping."""
    lines = load_tracked(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    orders = load_tracked(spark, folder, "orders", "o_orderkey").select("o_orderkey", "o_custkey")
    per_order = lines.group_by(["l_orderkey"], F.sum("l_quantity").alias("quantity"))
    per_customer = per_order.join(
        orders, left_on="l_orderkey", right_on="o_orderkey", how="inner"
    ).group_by(["o_custkey"], F.max("quantity").alias("largest_order"))
    return with_source_counts(per_customer, ["o_custkey"], "orders", "lineitem")


GROUPED_TWICE_SQL = """
SELECT o_custkey, max(quantity) AS largest_order, count(*) AS n_orders,
       cast(sum(n) AS bigint) AS n_lineitem
FROM (SELECT l_orderkey, sum(l_quantity) AS quantity,
             count(DISTINCT (l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS n
      FROM lineitem GROUP BY 1) JOIN orders ON l_orderkey = o_orderkey
GROUP BY 1
"""


def _customers(spark: SparkSession, folder: str):
    """All customers; the key of those in debt is negative and has no partner."""
    key = F.when(F.col("c_acctbal") > 0, F.col("c_custkey")).otherwise(-F.col("c_custkey"))
    return load_tracked(spark, folder, "customer", "c_custkey").with_columns(c_custkey=key)


_CUSTOMERS_SQL = """(SELECT c_custkey AS id, c_mktsegment,
        CASE WHEN c_acctbal > 0 THEN c_custkey ELSE -c_custkey END AS c_custkey FROM customer)"""


def join_left_on(spark: SparkSession, folder: str) -> DataFrame:
    orders = load_tracked(spark, folder, "orders", "o_orderkey").select("o_orderkey", "o_custkey")
    customers = _customers(spark, folder)
    joined = orders.join(
        customers.select("c_custkey", "c_mktsegment"),
        left_on=["o_custkey"],
        right_on=["c_custkey"],
        how="left",
    )
    return lineage_text(joined)


JOIN_LEFT_ON_SQL = f"""
SELECT o_orderkey, o_custkey, c_mktsegment,
       coalesce('customer_raw:' || id || ',', '') || 'orders_raw:' || o_orderkey AS sources
FROM orders LEFT JOIN {_CUSTOMERS_SQL} ON o_custkey = c_custkey
"""


def _two_sides(spark: SparkSession, folder: str):
    # All rows of both sides; orders that are not pending belong to customers of another range of keys.
    customers = _customers(spark, folder)
    key = F.when(F.col("o_orderstatus") == "P", F.col("o_custkey")).otherwise(
        -1_000_000_000 - F.col("o_custkey")
    )
    orders = load_tracked(spark, folder, "orders", "o_orderkey").with_columns(o_custkey=key)
    return (
        customers.rename({"c_custkey": "custkey"}).select("custkey", "c_mktsegment"),
        orders.rename({"o_custkey": "custkey"}).select("custkey", "o_orderkey"),
    )


_ORDERS_SQL = """(SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_custkey
        ELSE -1000000000 - o_custkey END AS o_custkey FROM orders)"""


def _join_query(how: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        customers, orders = _two_sides(spark, folder)
        return lineage_text(customers.join(orders, on="custkey", how=how))

    return run


def _join_sql(how: str) -> str:
    return f"""
SELECT coalesce(c_custkey, o_custkey) AS custkey, c_mktsegment, o_orderkey,
       concat_ws(',', 'customer_raw:' || id, 'orders_raw:' || o_orderkey) AS sources
FROM {_CUSTOMERS_SQL} {how} JOIN {_ORDERS_SQL} ON c_custkey = o_custkey
"""


def _filter_join_sql(word: str) -> str:
    return f"""
SELECT c_custkey AS custkey, c_mktsegment, 'customer_raw:' || id AS sources
FROM {_CUSTOMERS_SQL} WHERE {word} EXISTS (SELECT 1 FROM {_ORDERS_SQL} WHERE o_custkey = c_custkey)
"""


def lineage_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Edges into a table of customer totals that is about to be stored."""
    lines = load_tracked(spark, folder, "lineitem", "l_orderkey", "l_linenumber")
    orders = load_tracked(spark, folder, "orders", "o_orderkey").select("o_orderkey", "o_custkey")
    totals = lines.select("l_orderkey").join(
        orders, left_on="l_orderkey", right_on="o_orderkey", how="left"
    ).group_by(["o_custkey"], F.count(F.lit(1)).alias("n_lines"))
    rows = totals.df.withColumns(
        {FROM_DATE: F.lit(PROCESSING_DAY), TO_DATE: F.lit(OPEN_END).cast("date")}
    )
    edges = lineage.open_edges(add_record_id(rows), totals.origin, "customer_totals_enriched")
    return edges.select(*lineage.EDGE_COLUMNS)


LINEAGE_EDGES_SQL = f"""
WITH joined AS (SELECT * FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey),
totals AS (SELECT o_custkey, count(*) AS n_lines FROM joined GROUP BY 1),
ids AS (SELECT o_custkey AS k, {sql_hash("o_custkey", "n_lines", f"date '{PROCESSING_DAY}'")} AS id FROM totals)
SELECT DISTINCT source_RecordID, source_table_name, id AS "target_RecordID",
       'customer_totals_enriched' AS target_table_name
FROM (SELECT o_custkey, l_orderkey || '-' || l_linenumber AS "source_RecordID",
             'lineitem_raw' AS source_table_name FROM joined
      UNION ALL SELECT o_custkey, cast(o_orderkey AS varchar), 'orders_raw' FROM joined
      WHERE o_orderkey IS NOT NULL)
JOIN ids ON o_custkey IS NOT DISTINCT FROM k
"""


def lineage_map_import(spark: SparkSession, folder: str) -> DataFrame:
    """Sources handed over as a map of table to record ids, followed through a grouping."""
    key, customer = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    shared = F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.array(customer, customer, F.lit(None)))
    known = F.map_from_arrays(
        F.array(F.lit("orders_raw"), F.lit("customer_raw")), F.array(F.array(key), shared.cast("array<string>"))
    )
    sources = F.when(F.col("o_orderpriority") != "5-LOW", known)
    handed = load(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", sources.alias("sources"))
    frame = TrackedFrame.from_lineage_map(handed, "sources")
    keys = ["o_orderstatus", "o_orderpriority"]
    grouped = frame.group_by(keys, F.count(F.lit(1)).alias("n"))
    counted = source_counts(grouped, keys, "orders", "customer")
    return grouped.data.join(counted, keys, "left")


LINEAGE_MAP_IMPORT_SQL = """
SELECT o_orderstatus, o_orderpriority, count(*) AS n,
       CASE WHEN o_orderpriority <> '5-LOW' THEN count(DISTINCT o_orderkey) END AS n_orders,
       CASE WHEN o_orderpriority <> '5-LOW' THEN
         count(DISTINCT o_custkey) FILTER (o_orderstatus <> 'P') END AS n_customer
FROM orders GROUP BY 1, 2
"""


def _graph(spark: SparkSession, folder: str) -> DataFrame:
    """Edges lineitem -> orders -> customer -> nation -> region."""

    def edges(table: str, target: list[str], source_table: str, source: str) -> DataFrame:
        return load(spark, folder, table).select(
            F.col(source).cast("string").alias(lineage.SOURCE_ID),
            F.lit(source_table).alias(lineage.SOURCE_TABLE),
            F.concat_ws("-", *target).alias(lineage.TARGET_ID),
            F.lit(table).alias(lineage.TARGET_TABLE),
        )

    return union_all(
        [
            edges("lineitem", ["l_orderkey", "l_linenumber"], "orders", "l_orderkey"),
            edges("orders", ["o_orderkey"], "customer", "o_custkey"),
            edges("customer", ["c_custkey"], "nation", "c_nationkey"),
            edges("nation", ["n_nationkey"], "region", "n_regionkey"),
        ]
    )


def lineage_trace(spark: SparkSession, folder: str) -> DataFrame:
    starts = load(spark, folder, "lineitem").select(
        F.lit("lineitem").alias("table_name"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias(RECORD_ID),
    )
    return lineage.trace(_graph(spark, folder), starts)


def lineage_trace_per_start(spark: SparkSession, folder: str) -> DataFrame:
    starts = load(spark, folder, "orders").select(
        F.lit("orders").alias("table_name"), F.col("o_orderkey").cast("string").alias(RECORD_ID)
    )
    return lineage.trace(_graph(spark, folder), starts, per_start=True)


_GRAPH_SQL = """
WITH RECURSIVE edges AS (
  SELECT 'lineitem' AS tt, l_orderkey || '-' || l_linenumber AS tid, 'orders' AS st,
         cast(l_orderkey AS varchar) AS sid FROM lineitem
  UNION SELECT 'orders', cast(o_orderkey AS varchar), 'customer', cast(o_custkey AS varchar) FROM orders
  UNION SELECT 'customer', cast(c_custkey AS varchar), 'nation', cast(c_nationkey AS varchar) FROM customer
  UNION SELECT 'nation', cast(n_nationkey AS varchar), 'region', cast(n_regionkey AS varchar) FROM nation
)"""
LINEAGE_TRACE_SQL = f"""{_GRAPH_SQL},
walk AS (
  SELECT DISTINCT 0 AS depth, 'lineitem' AS table_name, l_orderkey || '-' || l_linenumber AS "RecordID",
         cast(NULL AS varchar) AS parent_table_name, cast(NULL AS varchar) AS "parent_RecordID"
  FROM lineitem
  UNION SELECT depth + 1, st, sid, tt, tid FROM walk JOIN edges ON table_name = tt AND "RecordID" = tid
)
SELECT * FROM walk
"""
LINEAGE_TRACE_PER_START_SQL = f"""{_GRAPH_SQL},
walk AS (
  SELECT 'orders' AS start_table_name, cast(o_orderkey AS varchar) AS "start_RecordID", 0 AS depth,
         'orders' AS table_name, cast(o_orderkey AS varchar) AS "RecordID",
         cast(NULL AS varchar) AS parent_table_name, cast(NULL AS varchar) AS "parent_RecordID"
  FROM orders
  UNION SELECT start_table_name, "start_RecordID", depth + 1, st, sid, tt, tid
  FROM walk JOIN edges ON table_name = tt AND "RecordID" = tid
)
SELECT * FROM walk
"""


QUERIES = {
    "lineage_rollup": (lineage_rollup, LINEAGE_ROLLUP_SQL),
    "groupby_null_keys": (groupby_null_keys, GROUPBY_NULL_KEYS_SQL),
    "tracked_distinct": (tracked_distinct, TRACKED_DISTINCT_SQL),
    "tracked_union": (tracked_union, TRACKED_UNION_SQL),
    "tracked_average": (tracked_average, TRACKED_AVERAGE_SQL),
    "grouped_twice": (grouped_twice, GROUPED_TWICE_SQL),
    "join_left_on": (join_left_on, JOIN_LEFT_ON_SQL),
    "join_inner": (_join_query("inner"), _join_sql("INNER")),
    "join_right": (_join_query("right"), _join_sql("RIGHT")),
    "join_full": (_join_query("full"), _join_sql("FULL")),
    "semi_join": (_join_query("semi"), _filter_join_sql("")),
    "anti_join": (_join_query("anti"), _filter_join_sql("NOT")),
    "lineage_edges": (lineage_edges, LINEAGE_EDGES_SQL),
    "lineage_map_import": (lineage_map_import, LINEAGE_MAP_IMPORT_SQL),
    "lineage_trace": (lineage_trace, LINEAGE_TRACE_SQL),
    "lineage_trace_per_start": (lineage_trace_per_start, LINEAGE_TRACE_PER_START_SQL),
}
