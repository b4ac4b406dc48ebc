"""Column operators, scalar cleaning, ranks and other window-like operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.functions import text
from layerloom.functions.naming import clean_column_names
from layerloom.operators.ranking import with_dense_rank
from layerloom.operators.relations import first_per_group, keep_lowest
from layerloom.sources.readers import null_tokens
from queries.common import cents, lineage_text, load, load_tracked, with_source_counts


def select_rename_cast_drop(spark: SparkSession, folder: str) -> DataFrame:
    parts = load_tracked(spark, folder, "part", "p_partkey")
    shaped = (
        parts.with_columns(
            price_cents=cents("p_retailprice"),
            brand=F.nullif(F.col("p_brand"), F.lit("Brand#4")),
            layer=F.lit("raw"),
        )
        .with_columns(
            brand=F.coalesce("brand", F.lit("none")),
            size_class=F.when(F.col("p_size") <= 10, "small")
            .when(F.col("p_size").between(11, 30), "medium")
            .otherwise("large"),
        )
        .where(F.col("p_type").isin("ECONOMY", "SMALL") | F.col("p_name").rlike("^(red|blue) "))
        .cast(["p_size"], "bigint")
        .rename({"p_partkey": "Part_Key", "p_size": "Size"})
        .drop("p_retailprice", "p_brand")
        .select("Part_Key", "p_type", "Size", "price_cents", "brand", "layer", "size_class")
    )
    return lineage_text(shaped)


SELECT_RENAME_CAST_DROP_SQL = r"""
SELECT p_partkey AS "Part_Key", p_type, cast(p_size AS bigint) AS "Size",
       cast(round(p_retailprice * 100) AS bigint) AS price_cents,
       coalesce(nullif(p_brand, 'Brand#4'), 'none') AS brand, 'raw' AS layer,
       CASE WHEN p_size <= 10 THEN 'small' WHEN p_size BETWEEN 11 AND 30 THEN 'medium' ELSE 'large' END
         AS size_class,
       'part_raw:' || p_partkey AS sources
FROM part WHERE p_type IN ('ECONOMY', 'SMALL') OR regexp_matches(p_name, '^(red|blue) ')
"""


def clean_names(spark: SparkSession, folder: str) -> DataFrame:
    messy = ["part-key", "name (long)", "brand\\code", "type/kind", "size", "retail  price"]
    return clean_column_names(load(spark, folder, "part").toDF(*messy))


CLEAN_NAMES_SQL = """
SELECT p_partkey AS part_key, p_name AS name_long, p_brand AS brand_code, p_type AS type_kind,
       p_size AS size, p_retailprice AS retail_price
FROM part
"""


def null_token_events(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    events = load(spark, folder, "events").select(
        "event_id",
        F.when(kind == "click", "NA").when(kind == "view", "nan").otherwise(kind).alias("event_type"),
        "value",
    )
    return null_tokens(events)


NULL_TOKENS_SQL = """
SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN NULL ELSE event_type END AS event_type, value
FROM events
"""


def unpivot_measures(spark: SparkSession, folder: str) -> DataFrame:
    lines = load_tracked(spark, folder, "lineitem", "l_orderkey", "l_linenumber")
    wide = lines.with_columns(
        quantity=F.col("l_quantity").cast("bigint"), price=cents("l_extendedprice"), tax=cents("l_tax")
    )
    long = wide.unpivot(["l_orderkey", "l_linenumber"], ["quantity", "price", "tax"], "measure", "amount")
    return lineage_text(long)


UNPIVOT_SQL = """
SELECT l_orderkey, l_linenumber, measure, amount, 'lineitem_raw:' || l_orderkey || '-' || l_linenumber AS sources
FROM (SELECT l_orderkey, l_linenumber, cast(l_quantity AS bigint) AS quantity,
             cast(round(l_extendedprice * 100) AS bigint) AS price,
             cast(round(l_tax * 100) AS bigint) AS tax FROM lineitem)
UNPIVOT (amount FOR measure IN (quantity, price, tax))
"""


def group_rank(spark: SparkSession, folder: str) -> DataFrame:
    """Dense rank, distinct count and row count within groups that may be hot or null."""
    lines = load(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        F.nullif(F.col("l_returnflag"), F.lit("R")).alias("flag"),
    )
    return with_dense_rank(lines, ["flag"], "l_extendedprice")


GROUP_RANK_SQL = """
WITH r AS (SELECT l_orderkey, l_linenumber, l_extendedprice, nullif(l_returnflag, 'R') AS flag FROM lineitem),
d AS (SELECT *, dense_rank() OVER (PARTITION BY flag ORDER BY l_extendedprice) AS dense_rank,
             count(*) OVER (PARTITION BY flag) AS row_count FROM r)
SELECT *, max(dense_rank) OVER (PARTITION BY flag) AS distinct_count FROM d
"""


def global_rank(spark: SparkSession, folder: str) -> DataFrame:
    lines = load(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_linestatus") == "O", F.col("l_extendedprice")).alias("open_price"),
    )
    return with_dense_rank(lines, [], "open_price").drop("row_count")


GLOBAL_RANK_SQL = """
WITH r AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'O' THEN l_extendedprice END AS open_price
           FROM lineitem),
d AS (SELECT *, dense_rank() OVER (ORDER BY open_price NULLS FIRST) AS dense_rank FROM r)
SELECT *, max(dense_rank) OVER () AS distinct_count FROM d
"""


def lowest_with_ties(spark: SparkSession, folder: str) -> DataFrame:
    lines = load(spark, folder, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_returnflag", F.col("l_quantity").cast("bigint").alias("quantity")
    )
    return keep_lowest(lines, ["l_suppkey", "l_returnflag"], "quantity")


LOWEST_WITH_TIES_SQL = """
SELECT l_orderkey, l_suppkey, l_returnflag, cast(l_quantity AS bigint) AS quantity FROM lineitem
QUALIFY dense_rank() OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY l_quantity) = 1
"""


def distinct_subset(spark: SparkSession, folder: str) -> DataFrame:
    lines = load(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    return first_per_group(
        lines, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_extendedprice"]
    )


DISTINCT_SUBSET_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY l_partkey, l_suppkey, l_extendedprice) = 1
"""


def topk_orders(spark: SparkSession, folder: str) -> DataFrame:
    """A top-k report that keeps the sources of its rows: Spark keeps k rows per task and merges them."""
    orders = load_tracked(spark, folder, "orders", "o_orderkey").select("o_orderkey", "o_custkey", "o_totalprice")
    return lineage_text(orders.head(100, F.desc("o_totalprice"), "o_orderkey"))


TOPK_SQL = """
SELECT o_orderkey, o_custkey, o_totalprice, 'orders_raw:' || o_orderkey AS sources
FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100
"""


def ordered_groups(spark: SparkSession, folder: str) -> DataFrame:
    """The ten customers with the most orders, ordered, with the number of records behind each."""
    orders = load_tracked(spark, folder, "orders", "o_orderkey")
    counted = orders.group_by(["o_custkey"], F.count(F.lit(1)).alias("n"))
    first = counted.order_by("o_custkey").head(10, F.desc("n"), "o_custkey")
    return with_source_counts(first, ["o_custkey"], "orders")


ORDERED_GROUPS_SQL = """
SELECT o_custkey, count(*) AS n, count(DISTINCT o_orderkey) AS n_orders
FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey LIMIT 10
"""


def postcode(spark: SparkSession, folder: str) -> DataFrame:
    """Postcodes in several spellings, taken from orders."""
    digits = F.lpad(F.col("o_custkey").cast("string"), 4, "1")
    raw = (
        F.when(F.col("o_orderstatus") == "F", F.concat(digits, F.lower(F.substring("o_orderpriority", 3, 2))))
        .when(F.col("o_orderstatus") == "O", F.concat(digits, F.lit(" "), F.substring("o_orderpriority", 3, 2)))
        .otherwise(F.substring("o_orderpriority", 3, 10))
    )
    return load(spark, folder, "orders").select(
        "o_orderkey", text.structure_postcode(raw).alias("postcode")
    )


POSTCODE_SQL = r"""
WITH r AS (SELECT o_orderkey,
  CASE o_orderstatus
    WHEN 'F' THEN lpad(left(cast(o_custkey AS varchar), 4), 4, '1') || lower(substring(o_orderpriority, 3, 2))
    WHEN 'O' THEN lpad(left(cast(o_custkey AS varchar), 4), 4, '1') || ' ' || substring(o_orderpriority, 3, 2)
    ELSE substring(o_orderpriority, 3, 10) END AS raw FROM orders)
SELECT o_orderkey, regexp_extract(raw, '^(\d{4})', 1) || ' ' || upper(regexp_extract(raw, '([A-Za-z]{2})$', 1))
         AS postcode
FROM r
"""


def postcode_from_city(spark: SparkSession, folder: str) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    code = F.when(status == "F", F.lpad(F.col("o_custkey").cast("string"), 4, "2")).when(
        status == "P", "kruiningen"
    )
    city = F.when(status == "F", F.concat(F.lower(F.substring(priority, 3, 2)), F.lit(" town"))).otherwise(
        "kruiningen"
    )
    city = F.when(priority == "5-LOW", code).otherwise(city)
    return load(spark, folder, "orders").select(
        "o_orderkey", text.postcode_from_address(code, city).alias("postcode")
    )


POSTCODE_FROM_CITY_SQL = r"""
WITH a AS (SELECT o_orderkey, o_orderpriority, o_orderstatus,
  CASE o_orderstatus WHEN 'F' THEN lpad(left(cast(o_custkey AS varchar), 4), 4, '2')
                     WHEN 'P' THEN 'kruiningen' END AS code FROM orders),
b AS (SELECT o_orderkey, code,
  CASE WHEN o_orderpriority = '5-LOW' THEN code
       WHEN o_orderstatus = 'F' THEN lower(substring(o_orderpriority, 3, 2)) || ' town'
       ELSE 'kruiningen' END AS city FROM a),
j AS (SELECT o_orderkey, CASE WHEN code = city THEN code ELSE code || city END AS joined FROM b),
s AS (SELECT o_orderkey, joined, string_split(joined, ' ')[1] AS head FROM j)
SELECT o_orderkey,
  CASE WHEN joined IS NULL OR joined IN ('etten-leur', 'kruiningen') THEN ''
       ELSE regexp_extract(head, '^(\d{4})', 1) || ' ' || upper(regexp_extract(head, '([A-Za-z]{2})$', 1)) END
    AS postcode
FROM s
"""


def keep_one_name(spark: SparkSession, folder: str) -> DataFrame:
    customers = load(spark, folder, "customer")
    statutory = F.when(F.col("c_mktsegment") != "BUILDING", F.concat_ws(" ", "c_mktsegment", "c_nationkey"))
    return customers.select("c_custkey", text.preferred_name(F.col("c_name"), statutory).alias("name"))


KEEP_ONE_NAME_SQL = """
SELECT c_custkey, lower(CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment || ' ' || c_nationkey
                             ELSE c_name END) AS name
FROM customer
"""


def industry_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Quoted, short and long codes."""
    from layerloom.plans.climate import clean_codes

    key = F.col("l_partkey").cast("string")
    code = F.when(F.col("l_returnflag") == "A", F.concat(F.lit("'"), key, F.lit("'"))).when(
        F.col("l_returnflag") == "N", F.concat(F.lit("98765"), key)
    ).otherwise(key)
    lines = load(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", code.alias("isic_code"))
    return clean_codes(lines)


INDUSTRY_CODES_SQL = """
WITH r AS (SELECT l_orderkey, l_linenumber,
  CASE l_returnflag WHEN 'N' THEN '98765' || l_partkey ELSE cast(l_partkey AS varchar) END AS code FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN length(code) < 4 THEN lpad(code, 4, '0') ELSE code END AS isic_code FROM r
"""


QUERIES = {
    "select_rename_cast_drop": (select_rename_cast_drop, SELECT_RENAME_CAST_DROP_SQL),
    "clean_names": (clean_names, CLEAN_NAMES_SQL),
    "null_tokens": (null_token_events, NULL_TOKENS_SQL),
    "unpivot_measures": (unpivot_measures, UNPIVOT_SQL),
    "group_rank": (group_rank, GROUP_RANK_SQL),
    "global_rank": (global_rank, GLOBAL_RANK_SQL),
    "lowest_with_ties": (lowest_with_ties, LOWEST_WITH_TIES_SQL),
    "distinct_subset": (distinct_subset, DISTINCT_SUBSET_SQL),
    "topk_orders": (topk_orders, TOPK_SQL),
    "ordered_groups": (ordered_groups, ORDERED_GROUPS_SQL),
    "postcode": (postcode, POSTCODE_SQL),
    "postcode_from_city": (postcode_from_city, POSTCODE_FROM_CITY_SQL),
    "keep_one_name": (keep_one_name, KEEP_ONE_NAME_SQL),
    "industry_codes": (industry_codes, INDUSTRY_CODES_SQL),
}
