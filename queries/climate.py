"""Climate-risk jobs: parts are activities, suppliers and brands are ledger entries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.plans import climate
from queries.common import cents, load, load_tracked, tracked, with_source_counts

SCENARIO_NAMES = {"A": "stated", "N": "net zero", "R": "delayed"}


def _activities(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "part").select(
        F.col("p_partkey").alias("activity_uuid_product_uuid"),
        F.col("p_brand").alias("geography"),
        F.col("p_size").cast("string").alias("isic_4digit"),
        F.concat_ws("/", "p_type", "p_name").alias("cpc_code"),
        F.lit("market").alias("activity_type"),
        F.col("p_name").alias("reference_product_name"),
        F.col("p_type").alias("activity_name"),
    )


def match_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers that asked for products, in line-number priority; one priority is unknown."""
    parts = load(spark, folder, "part")
    lines = load(spark, folder, "lineitem").select("l_partkey", "l_suppkey", "l_linenumber")
    ledger = (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("l_suppkey").alias("ledger_id"),
            F.col("p_brand").alias("ecoinvent_geography"),
            F.col("p_size").cast("string").alias("isic_code"),
            F.concat_ws("/", "p_type", "p_name").alias("cpc_code"),
            F.lit("market").alias("activity_type"),
            F.nullif(F.col("l_linenumber"), F.lit(7)).alias("priority"),
        )
        .distinct()
    )
    return climate.match_ledger(ledger, _activities(spark, folder))


MATCH_LEDGER_SQL = """
WITH ledger AS (
  SELECT DISTINCT l_suppkey AS ledger_id, p_brand AS ecoinvent_geography, cast(p_size AS varchar) AS isic_code,
         p_type || '/' || p_name AS cpc_code, 'market' AS activity_type, nullif(l_linenumber, 7) AS priority
  FROM lineitem JOIN part ON l_partkey = p_partkey),
matched AS (
  SELECT p_partkey AS activity_uuid_product_uuid, cast(p_size AS varchar) AS isic_4digit,
         p_name AS reference_product_name, p_type AS activity_name, ledger.*
  FROM part JOIN ledger ON p_brand = ecoinvent_geography AND cast(p_size AS varchar) = isic_code
   AND p_type || '/' || p_name = cpc_code)
SELECT * FROM matched
QUALIFY dense_rank() OVER (PARTITION BY ledger_id, reference_product_name, activity_name, activity_type
                           ORDER BY priority NULLS FIRST) = 1
"""


def emission_profile(spark: SparkSession, folder: str) -> DataFrame:
    emissions = load(spark, folder, "part").select(
        F.col("p_partkey").alias("activity_uuid_product_uuid"),
        F.col("p_name").alias("reference_product_name"),
        cents("p_retailprice").alias("co2_footprint"),
        F.col("p_size").cast("string").alias("isic_code"),
        F.nullif(F.col("p_type"), F.lit("SMALL")).alias("sector"),
        F.col("p_brand").alias("unit"),
    )
    mapping = load(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("ledger_id"), F.col("l_partkey").alias("activity_uuid_product_uuid")
    )
    profile = climate.emission_profile(mapping, emissions)
    return profile.withColumn("average_profile_ranking", F.round("average_profile_ranking", 10))


EMISSION_PROFILE_SQL = """
WITH e AS (SELECT p_partkey AS activity, p_name AS product_name,
                  cast(round(p_retailprice * 100) AS bigint) AS co2_footprint, cast(p_size AS varchar) AS isic_code,
                  nullif(p_type, 'SMALL') AS sector, p_brand AS unit FROM part),
long AS (
  SELECT *, 'all' AS bench, '' AS k1, '' AS k2 FROM e
  UNION ALL SELECT *, 'isic_4digit', isic_code, '' FROM e
  UNION ALL SELECT *, 'sector', sector, '' FROM e
  UNION ALL SELECT *, 'unit', unit, '' FROM e
  UNION ALL SELECT *, 'unit_isic_4digit', unit, isic_code FROM e
  UNION ALL SELECT *, 'unit_sector', unit, sector FROM e),
d AS (SELECT *, dense_rank() OVER (PARTITION BY bench, k1, k2 ORDER BY co2_footprint) AS dr,
             count(*) OVER (PARTITION BY bench, k1, k2) AS n FROM long),
r AS (SELECT *, dr / CASE WHEN bench = 'all' THEN max(dr) OVER (PARTITION BY bench) ELSE n END AS ranking FROM d),
averages AS (SELECT l_suppkey AS ledger_id, bench AS benchmark_group, avg(ranking) AS a, avg(co2_footprint) AS c
             FROM lineitem JOIN r ON l_partkey = activity GROUP BY 1, 2),
kept AS (SELECT l_suppkey AS kept_id, e.* FROM lineitem JOIN e ON l_partkey = activity
         QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY activity) = 1)
SELECT ledger_id, benchmark_group, round(a, 10) AS average_profile_ranking, c AS average_co2_footprint,
       activity AS activity_uuid_product_uuid, product_name, co2_footprint, isic_code, sector, unit,
       CASE WHEN a <= 1.0::double / 3 THEN 'low' WHEN a <= 2.0::double / 3 THEN 'medium' ELSE 'high' END AS risk_category
FROM averages JOIN kept ON ledger_id = kept_id
"""


def upstream_profile(spark: SparkSession, folder: str) -> DataFrame:
    lines = load_tracked(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    upstream = lines.with_columns(
        activity_uuid_product_uuid=F.col("l_partkey"),
        input_co2_footprint=cents("l_extendedprice"),
        input_isic_code=F.col("l_linenumber").cast("string"),
        input_sector=F.nullif(F.col("l_returnflag"), F.lit("R")),
        input_unit=F.col("l_linestatus"),
    )
    mapping = load_tracked(spark, folder, "part", "p_partkey").with_columns(
        ledger_id=F.concat_ws("/", "p_brand", "p_size"), activity_uuid_product_uuid=F.col("p_partkey")
    )
    profile = climate.upstream_profile(mapping, upstream)
    counted = with_source_counts(profile, ["ledger_id", "benchmark_group"], "part", "lineitem")
    return counted.withColumn("average_input_profile_rank", F.round("average_input_profile_rank", 10))


UPSTREAM_PROFILE_SQL = """
WITH e AS (SELECT l_partkey AS activity, (l_orderkey, l_linenumber, l_partkey, l_suppkey) AS line,
                  cast(round(l_extendedprice * 100) AS bigint) AS co2, cast(l_linenumber AS varchar) AS isic,
                  nullif(l_returnflag, 'R') AS sector, l_linestatus AS unit FROM lineitem),
long AS (
  SELECT *, 'all' AS bench, '' AS k1, '' AS k2 FROM e
  UNION ALL SELECT *, 'input_isic_4digit', isic, '' FROM e
  UNION ALL SELECT *, 'input_sector', sector, '' FROM e
  UNION ALL SELECT *, 'input_unit', unit, '' FROM e
  UNION ALL SELECT *, 'input_unit_isic_4digit', unit, isic FROM e
  UNION ALL SELECT *, 'input_unit_sector', unit, sector FROM e),
d AS (SELECT *, dense_rank() OVER (PARTITION BY bench, k1, k2 ORDER BY co2) AS dr FROM long),
r AS (SELECT *, dr / max(dr) OVER (PARTITION BY bench, k1, k2) AS ranking FROM d),
a AS (SELECT p_brand || '/' || p_size AS ledger_id, bench AS benchmark_group, avg(ranking) AS rank,
             avg(co2) AS average_input_co2_footprint, count(DISTINCT p_partkey) AS n_part,
             count(DISTINCT line) AS n_lineitem
      FROM part JOIN r ON p_partkey = activity GROUP BY 1, 2)
SELECT ledger_id, benchmark_group, round(rank, 10) AS average_input_profile_rank, average_input_co2_footprint,
       n_part, n_lineitem,
       CASE WHEN rank <= 1.0::double / 3 THEN 'low' WHEN rank <= 2.0::double / 3 THEN 'medium' ELSE 'high' END
         AS risk_category
FROM a
"""


def _pathways(spark: SparkSession, folder: str, sector: str = "ipr_sector") -> DataFrame:
    """Yearly quantities as pathways; ship years 1995 to 2001 stand for 2020 to 2050."""
    prefix = sector.removesuffix("_sector")
    return (
        load(spark, folder, "lineitem")
        .withColumn("year", (F.year("l_shipdate") - 1995) * 5 + 2020)
        .groupBy(
            F.col("l_returnflag").alias("scenario"),
            F.nullif(F.col("l_linestatus"), F.lit("O")).alias("region"),
            F.col("l_linenumber").alias(sector),
            (F.col("l_suppkey") % 10).alias(f"{prefix}_subsector"),
            "year",
        )
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("value"))
    )


def reductions(spark: SparkSession, folder: str) -> DataFrame:
    return climate.reductions(_pathways(spark, folder), SCENARIO_NAMES)


_PATHWAYS_SQL = """
WITH p AS (SELECT l_returnflag AS scenario, nullif(l_linestatus, 'O') AS region, l_linenumber AS ipr_sector,
                  l_suppkey % 10 AS ipr_subsector, cast((year(l_shipdate) - 1995) * 5 + 2020 AS integer) AS year,
                  cast(sum(cast(l_quantity AS bigint)) AS bigint) AS value FROM lineitem GROUP BY 1, 2, 3, 4, 5),
f AS (SELECT *, first_value(value) OVER (PARTITION BY scenario, region, ipr_sector, ipr_subsector ORDER BY year)
        AS first_value FROM p),
r AS (SELECT CASE scenario WHEN 'A' THEN 'stated' WHEN 'N' THEN 'net zero' ELSE 'delayed' END AS scenario,
             region, ipr_sector, ipr_subsector, year, value, first_value,
             round(1 - value / first_value, 2) AS reductions FROM f WHERE year IN (2030, 2050))"""


def scenario_columns(spark: SparkSession, folder: str) -> DataFrame:
    return climate.scenario_columns(reductions(spark, folder))


_SCENARIO = """SELECT scenario AS scenario_name, region, ipr_sector AS scenario_sector,
       ipr_subsector AS scenario_subsector, year, value, reductions, 'ipr' AS scenario_type FROM r"""


def combined_targets(spark: SparkSession, folder: str) -> DataFrame:
    """Two target sets with ids of their own; the common rows meet."""
    rows = climate.scenario_columns(reductions(spark, folder))
    identity = F.concat_ws(
        "-", "scenario_name", "region", "scenario_sector", "scenario_subsector", "year"
    )
    first = rows.where("year = 2030").withColumn("scenario_targets_ipr_id", identity)
    second = rows.where("scenario_name <> 'stated'").withColumn("scenario_targets_weo_id", identity)
    key = "scenario_targets_ipr_id"
    combined = climate.combine_targets(
        tracked(first, "ipr_raw", key), tracked(second, "weo_raw", "scenario_targets_weo_id")
    )
    keys = ["scenario_name", "region", "scenario_sector", "scenario_subsector", "year"]
    return with_source_counts(combined, keys, "ipr", "weo")


COMBINED_TARGETS_SQL = f"""{_PATHWAYS_SQL}, s AS ({_SCENARIO})
SELECT *, cast(year = 2030 AS bigint) AS n_ipr, cast(scenario_name <> 'stated' AS bigint) AS n_weo
FROM s WHERE year = 2030 OR scenario_name <> 'stated'
"""


def sector_profile(spark: SparkSession, folder: str) -> DataFrame:
    return climate.sector_profile(scenario_columns(spark, folder))


def _band_sql(score: str) -> str:
    return f"""CASE WHEN year = 2030 THEN CASE WHEN {score} <= 1.0::double / 9 THEN 'low'
         WHEN {score} <= 1.0::double / 3 THEN 'medium' ELSE 'high' END
         ELSE CASE WHEN {score} <= 2.0::double / 9 THEN 'low' WHEN {score} <= 2.0::double / 3 THEN 'medium' ELSE 'high' END END"""


SECTOR_PROFILE_SQL = f"""{_PATHWAYS_SQL}, s AS ({_SCENARIO})
SELECT scenario_name, region, scenario_sector, scenario_subsector, year, value, scenario_type,
       reductions AS profile_ranking, {_band_sql("reductions")} AS risk_category,
       lower(scenario_type || '_' || scenario_name || '_' || year) AS benchmark_group
FROM s
"""


def sector_profile_upstream(spark: SparkSession, folder: str) -> DataFrame:
    rows = scenario_columns(spark, folder)
    return climate.sector_profile(rows.toDF(*[f"input_{c}" for c in rows.columns]), prefix="input_")


SECTOR_PROFILE_UPSTREAM_SQL = f"""{_PATHWAYS_SQL}, s AS ({_SCENARIO})
SELECT scenario_name AS input_scenario_name, region AS input_region, scenario_sector AS input_scenario_sector,
       scenario_subsector AS input_scenario_subsector, year AS input_year, value AS input_value,
       scenario_type AS input_scenario_type, reductions AS profile_ranking,
       {_band_sql("reductions")} AS risk_category,
       lower(scenario_type || '_' || scenario_name || '_' || year) AS benchmark_group
FROM s
"""


def transition_risk(spark: SparkSession, folder: str) -> DataFrame:
    """Ranks on both sides of [0, 1], some missing."""
    lines = load(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_quantity") / 32 - 0.25).alias("average_profile_ranking"),
        F.when(F.col("l_returnflag") != "R", F.col("l_linenumber") / 4 - 0.5).alias("profile_ranking"),
        F.year("l_shipdate").alias("scenario_year"),
        F.col("l_linestatus").alias("benchmark_group"),
    )
    return climate.transition_risk(lines)


TRANSITION_RISK_SQL = """
WITH r AS (SELECT l_orderkey, l_linenumber, l_quantity / 32 - 0.25 AS average_profile_ranking,
                  CASE WHEN l_returnflag <> 'R' THEN l_linenumber / 4 - 0.5 END AS profile_ranking,
                  cast(year(l_shipdate) AS integer) AS scenario_year, l_linestatus AS status FROM lineitem)
SELECT l_orderkey, l_linenumber, average_profile_ranking, profile_ranking, scenario_year,
       CASE WHEN profile_ranking IS NOT NULL THEN
         least(greatest((average_profile_ranking + profile_ranking) / 2, 0.0), 1.0) END AS transition_risk_score,
       CASE WHEN profile_ranking IS NOT NULL THEN scenario_year || '_' || status END AS benchmark_group
FROM r
"""


def assertion_counts(spark: SparkSession, folder: str) -> DataFrame:
    lines = load(spark, folder, "lineitem").select(
        F.nullif(F.col("l_linenumber"), F.lit(7)).alias("isic_code"),
        F.nullif(F.col("l_returnflag"), F.lit("R")).alias("sector"),
        F.nullif(F.col("l_linestatus"), F.lit("O")).alias("subsector"),
        F.nullif(F.col("l_suppkey"), F.lit(3)).alias("product_name"),
    )
    sectors = climate.sector_violations(lines).withColumn("rule", F.lit("sector"))
    names = climate.product_name_violations(lines).withColumn("rule", F.lit("product name"))
    return sectors.unionByName(names)


ASSERTION_COUNTS_SQL = """
SELECT 'sector' AS rule,
       count(*) FILTER (l_linenumber <> 7 AND (l_returnflag = 'R' OR l_linestatus = 'O')) AS violations FROM lineitem
UNION ALL SELECT 'product name', count(*) FILTER (l_suppkey = 3) FROM lineitem
"""


def geography_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Both rules, for activities and for ledger entries."""
    lines = load(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("input_activity_uuid_product_uuid"),
        F.concat_ws("/", F.col("l_suppkey") % 50, F.col("l_partkey") % 7).alias("ledger_id"),
        F.col("l_linestatus").alias("input_geography"),
        F.concat(F.lit("product "), (F.col("l_suppkey") % 3).cast("string")).alias("input_product_name"),
        F.when(F.col("l_returnflag") == "A", 16).when(F.col("l_returnflag") == "R", 3).alias("input_priority"),
        F.col("l_linenumber").alias("row_num"),
    )
    activities = climate.geography_violations(lines).withColumn("of", F.lit("activity"))
    entries = climate.geography_violations(lines, "ledger_id").withColumn("of", F.lit("ledger"))
    return activities.unionByName(entries)


def _geography_sql(product: str, of: str) -> str:
    return f"""
SELECT 'geography' AS rule, {product} AS product, '{of}' AS of FROM lineitem
WHERE l_linenumber <= 2 AND l_returnflag = 'A' GROUP BY 2 HAVING count(DISTINCT l_linestatus) > 1
UNION ALL SELECT 'no priority', {product}, '{of}' FROM lineitem
WHERE l_linenumber <= 2 AND l_returnflag = 'N' GROUP BY 2 HAVING count(DISTINCT l_suppkey % 3) > 1"""


GEOGRAPHY_VIOLATIONS_SQL = f"""
WITH g AS ({_geography_sql("cast(l_partkey AS varchar)", "activity")}
           UNION ALL {_geography_sql("(l_suppkey % 50) || '/' || (l_partkey % 7)", "ledger")})
SELECT rule, of, count(*) AS violations FROM g GROUP BY 1, 2
"""


def complete_emissions(spark: SparkSession, folder: str) -> DataFrame:
    lines = load(spark, folder, "lineitem").select(
        "l_orderkey",
        F.nullif(F.col("l_linenumber"), F.lit(7)).alias("isic_code"),
        F.nullif(F.col("l_returnflag"), F.lit("R")).alias("sector"),
        F.when(F.col("l_linestatus") == "O", F.col("l_extendedprice")).alias("co2_footprint"),
    )
    return climate.complete_emissions(lines)


COMPLETE_EMISSIONS_SQL = """
SELECT l_orderkey, l_linenumber AS isic_code, l_returnflag AS sector, l_extendedprice AS co2_footprint
FROM lineitem WHERE l_linenumber <> 7 AND l_returnflag <> 'R' AND l_linestatus = 'O'
"""


QUERIES = {
    "match_ledger": (match_ledger, MATCH_LEDGER_SQL),
    "emission_profile": (emission_profile, EMISSION_PROFILE_SQL),
    "upstream_profile": (upstream_profile, UPSTREAM_PROFILE_SQL),
    "reductions": (reductions, f"{_PATHWAYS_SQL} SELECT * FROM r"),
    "scenario_columns": (scenario_columns, f"{_PATHWAYS_SQL} {_SCENARIO}"),
    "combined_targets": (combined_targets, COMBINED_TARGETS_SQL),
    "sector_profile": (sector_profile, SECTOR_PROFILE_SQL),
    "sector_profile_upstream": (sector_profile_upstream, SECTOR_PROFILE_UPSTREAM_SQL),
    "transition_risk": (transition_risk, TRANSITION_RISK_SQL),
    "assertion_counts": (assertion_counts, ASSERTION_COUNTS_SQL),
    "geography_violations": (geography_violations, GEOGRAPHY_VIOLATIONS_SQL),
    "complete_emissions": (complete_emissions, COMPLETE_EMISSIONS_SQL),
}
