"""Quality checks, metric ids and the blocking gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.constants import OPEN_END, RECORD_ID, TO_DATE
from layerloom.operators import lineage, quality
from queries.common import load


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with nulls, null tokens and NaN in them."""
    return load(spark, folder, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.when(F.col("o_orderstatus") == "P", "NA").otherwise(F.col("o_orderstatus")).alias("status"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"),
        F.when(F.col("o_orderpriority") == "2-HIGH", float("nan"))
        .otherwise(F.col("o_totalprice"))
        .alias("price"),
        F.col("o_orderdate").cast("date").alias("day"),
    )


ORDERS_SQL = """(SELECT o_orderkey, o_custkey,
  CASE WHEN o_orderstatus = 'P' THEN 'NA' ELSE o_orderstatus END AS status,
  nullif(o_orderpriority, '5-LOW') AS priority,
  CASE WHEN o_orderpriority = '2-HIGH' THEN 'NaN'::double ELSE o_totalprice END AS price,
  cast(o_orderdate AS date) AS day FROM orders)"""

FILLED_SQL = {
    "o_orderkey": "o_orderkey IS NOT NULL",
    "o_custkey": "o_custkey IS NOT NULL",
    "status": "status NOT IN ('NA', 'nan')",
    "priority": "priority NOT IN ('NA', 'nan')",
    "price": "NOT isnan(price)",
    "day": "day IS NOT NULL",
}


def _metric_sql(check_id: str, column: str, text: str, valid: str, source: str = ORDERS_SQL) -> str:
    text = text.replace("'", "''")
    return f"""SELECT cast(NULL AS bigint) AS signalling_id, '{check_id}' AS check_id, '{column}' AS column_name,
       '{text}' AS check_name, cast(count(*) AS bigint) AS total_count,
       cast(count(*) FILTER ({valid}) AS bigint) AS valid_count FROM {source}"""


def filled(spark: SparkSession, folder: str) -> DataFrame:
    return quality.filled_values(_orders(spark, folder))


DQ_FILLED_SQL = " UNION ALL ".join(
    _metric_sql("dq_1", c, quality.FILLED_TEXT, valid) for c, valid in FILLED_SQL.items()
)


def _counts_sql(valid: str, source: str) -> str:
    return f"""SELECT cast(count(*) AS bigint) AS total_count,
       cast(count(*) FILTER ({valid}) AS bigint) AS valid_count FROM {source}"""


PRIORITIES = ["1-URGENT", "2-HIGH"]
LIST_CHECK = {"check": "values within list", "columns": ["priority"], "value_list": PRIORITIES}
RANGE_CHECK = {"check": "values in range", "columns": ["price"], "range_start": 1000, "range_end": 100000}
FORMAT_CHECK = {"check": "values have format", "columns": ["priority"], "format": r"^\d-[A-Z]+$"}
UNIQUE_CHECK = {"check": "values are unique", "columns": ["o_custkey", "priority"]}
LIST_SQL = "priority IN ('1-URGENT', '2-HIGH')"
RANGE_SQL = "price BETWEEN 1000 AND 100000"
FORMAT_SQL = r"regexp_matches(priority, '^\d-[A-Z]+$')"


def _on_orders(check: dict):
    return lambda spark, folder: quality.measure(_orders(spark, folder), check)


UNIQUE_SQL = f"""SELECT cast(count(*) AS bigint) AS total_count,
       cast(count(DISTINCT (o_custkey, coalesce(priority, 'none'))) AS bigint) AS valid_count FROM {ORDERS_SQL}"""


def consistent(spark: SparkSession, folder: str) -> DataFrame:
    """Line status against the status of the order; keys repeat on the line side."""
    lines = load(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), F.col("l_linestatus").alias("status")
    )
    orders = load(spark, folder, "orders").select(
        F.col("o_orderkey").alias("orderkey"), F.col("o_orderstatus").alias("status")
    )
    return quality.consistent_rows(lines, "status", orders, ["orderkey"])


CONSISTENT_SQL = """
SELECT (SELECT count(*) FROM lineitem) AS total_count, count(*) AS valid_count
FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND l_linestatus = o_orderstatus
"""


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"),
        F.nullif(F.col("l_suppkey"), F.lit(7)).alias("suppkey"),
        F.nullif(F.col("l_returnflag"), F.lit("R")).alias("flag"),
        F.nullif(F.col("l_linestatus"), F.lit("F")).alias("status"),
        (F.col("l_quantity") / 64).alias("share"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias(RECORD_ID),
    )


LINES_SQL = """(SELECT l_orderkey AS orderkey, nullif(l_suppkey, 7) AS suppkey, nullif(l_returnflag, 'R') AS flag,
  nullif(l_linestatus, 'F') AS status, l_quantity / 64 AS share FROM lineitem)"""
OCCUR_CHECK = {"check": "values occur as expected", "columns": ["orderkey", "flag"], "expected_count": 2}
SUM_CHECK = {"check": "values sum to 1", "columns": ["orderkey", "suppkey"], "sum_column": "share"}
DISTINCT_CHECK = {
    "check": "distinct values occur as expected",
    "columns": ["orderkey"],
    "distinct_columns": ["flag", "status"],
    "expected_count": 3,
}


def _on_lines(check: dict):
    return lambda spark, folder: quality.measure(_lines(spark, folder), check)


def _group_sql(keys: str, passes: str, usable: str) -> str:
    return f"""WITH l AS (SELECT * FROM {LINES_SQL}),
good AS (SELECT {keys}, count(*) AS n FROM l WHERE {usable} GROUP BY {keys} HAVING {passes})
SELECT (SELECT count(*) FROM l) AS total_count, cast((SELECT coalesce(sum(n), 0) FROM good) AS bigint) AS valid_count"""


OCCUR_SQL = _group_sql("orderkey, flag", "count(*) = 2", "flag IS NOT NULL")
SUM_SQL = _group_sql("orderkey, suppkey", "sum(share) BETWEEN 0.98 AND 1.02", "suppkey IS NOT NULL")
DISTINCT_SQL = _group_sql(
    "orderkey", "count(DISTINCT (coalesce(flag, '-'), coalesce(status, '-'))) = 3", "true"
)


def expected_history(spark: SparkSession, folder: str) -> DataFrame:
    """Orders traced to one customer and one or four lines."""
    orders = load(spark, folder, "orders")
    lines = load(spark, folder, "lineitem")
    trace = (
        lines.select(
            F.col("l_orderkey").cast("string").alias(lineage.TARGET_ID),
            F.lit("lineitem_raw").alias(lineage.SOURCE_TABLE),
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias(lineage.SOURCE_ID),
        )
    ).unionByName(
        load(spark, folder, "orders").select(
            F.col("o_orderkey").cast("string").alias(lineage.TARGET_ID),
            F.lit("customer_raw").alias(lineage.SOURCE_TABLE),
            F.col("o_custkey").cast("string").alias(lineage.SOURCE_ID),
        )
    )
    check = {
        "check": "record has expected history",
        "columns": ["all"],
        "record_trace_table": trace,
        "expected_trace": {
            "source_table_name": ["customer_raw", "lineitem_raw", "lineitem_raw"],
            "amount_records": [1, 1, 4],
        },
    }
    rows = orders.select(F.col("o_orderkey").cast("string").alias(RECORD_ID))
    return quality.measure(rows, check)


HISTORY_SQL = """
WITH n AS (SELECT o_orderkey, count(l_orderkey) AS n FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
           GROUP BY 1)
SELECT count(*) AS total_count, count(*) FILTER (n IN (0, 1, 4)) AS valid_count FROM n
"""

SIGNALLING = [
    LIST_CHECK,
    RANGE_CHECK,
    FORMAT_CHECK,
    UNIQUE_CHECK,
    {"check": "values occur as expected", "columns": ["o_custkey"], "expected_count": 10},
]


def _metrics(spark: SparkSession, folder: str) -> DataFrame:
    orders = _orders(spark, folder).withColumn(RECORD_ID, F.col("o_orderkey").cast("string"))
    return quality.signalling_metrics(orders, SIGNALLING)


def _metrics_sql() -> str:
    return " UNION ALL ".join(
        [
            DQ_FILLED_SQL,
            _metric_sql("dq_2", "priority", quality.describe(LIST_CHECK), LIST_SQL),
            _metric_sql("dq_3", "price", quality.describe(RANGE_CHECK), RANGE_SQL),
            _metric_sql("dq_5", "priority", quality.describe(FORMAT_CHECK), FORMAT_SQL),
            f"""SELECT NULL, 'dq_4', 'o_custkey,priority', '{quality.describe(UNIQUE_CHECK)}', *
                FROM ({UNIQUE_SQL})""",
            """SELECT NULL, 'dq_7', 'o_custkey', 'values occur 10 times', (SELECT count(*) FROM orders),
               cast((SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey
                     HAVING count(*) = 10)) AS bigint)""",
        ]
    )


def metric_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of earlier metrics (the fill grades, numbered by column name) are kept."""
    metrics = _metrics(spark, folder).withColumn("table_name", F.lit("orders_raw"))
    known = list(FILLED_SQL)
    number = F.array_position(F.array(*[F.lit(c) for c in sorted(known)]), F.col("column_name"))
    stored = metrics.where("check_id = 'dq_1'").withColumn("signalling_id", number.cast("bigint"))
    return quality.assign_signalling_ids(metrics, stored)


METRIC_IDS_SQL = f"""
WITH m AS ({_metrics_sql()}),
n AS (SELECT *, row_number() OVER (PARTITION BY check_id = 'dq_1'
                  ORDER BY CASE WHEN check_id = 'dq_1' THEN column_name ELSE check_id END,
                           column_name, check_name) AS rn FROM m)
SELECT CASE WHEN check_id = 'dq_1' THEN rn ELSE rn + {len(FILLED_SQL)} END AS signalling_id, check_id, column_name,
       check_name, total_count, valid_count, 'orders_raw' AS table_name FROM n
"""


def blocking(spark: SparkSession, folder: str) -> DataFrame:
    """The gate looks at open rows only."""
    orders = _orders(spark, folder).withColumn(
        TO_DATE,
        F.when(F.col("priority") == "1-URGENT", F.lit("2025-01-01")).otherwise(OPEN_END).cast("date"),
    )
    return quality.blocking_counts(orders, [RANGE_CHECK, UNIQUE_CHECK, FORMAT_CHECK])


BLOCKING_SQL = f"""
WITH o AS (SELECT * FROM {ORDERS_SQL} WHERE priority IS DISTINCT FROM '1-URGENT')
SELECT 0 AS position, 'values in range' AS "check", count(*) AS total_count,
       count(*) FILTER ({RANGE_SQL}) AS valid_count FROM o
UNION ALL SELECT 1, 'values are unique', count(*), count(DISTINCT (o_custkey, coalesce(priority, 'none'))) FROM o
UNION ALL SELECT 2, 'values have format', count(*), count(*) FILTER ({FORMAT_SQL}) FROM o
"""


QUERIES = {
    "dq_filled": (filled, DQ_FILLED_SQL),
    "dq_within_list": (_on_orders(LIST_CHECK), _counts_sql(LIST_SQL, ORDERS_SQL)),
    "dq_in_range": (_on_orders(RANGE_CHECK), _counts_sql(RANGE_SQL, ORDERS_SQL)),
    "dq_unique": (_on_orders(UNIQUE_CHECK), UNIQUE_SQL),
    "dq_format": (_on_orders(FORMAT_CHECK), _counts_sql(FORMAT_SQL, ORDERS_SQL)),
    "dq_consistent": (consistent, CONSISTENT_SQL),
    "dq_occurs": (_on_lines(OCCUR_CHECK), OCCUR_SQL),
    "dq_sums_to_one": (_on_lines(SUM_CHECK), SUM_SQL),
    "dq_distinct_occurs": (_on_lines(DISTINCT_CHECK), DISTINCT_SQL),
    "dq_history": (expected_history, HISTORY_SQL),
    "dq_signalling": (_metrics, _metrics_sql()),
    "dq_ids": (metric_ids, METRIC_IDS_SQL),
    "dq_blocking": (blocking, BLOCKING_SQL),
}
