"""Climate-risk analytics: activity matching, benchmark ranks, reduction targets, risk bands.

Column names are arguments. Benchmark labels follow the names of the sector and unit columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerloom.functions.bands import RANK_BANDS, REDUCTION_BANDS, clamp_unit, risk_band
from layerloom.functions.hashing import row_text
from layerloom.functions.naming import find_column, require_columns
from layerloom.functions.text import clean_industry_code
from layerloom.operators.ranking import per_set, range_ranks, with_dense_rank
from layerloom.operators.relations import (
    first_per_group,
    first_value_by,
    keep_lowest,
    null_safe_join,
)
from layerloom.operators.tracked import TrackedFrame

# Labels, years and the priority that decide the result.
ALL_BENCHMARK = "all"
INDUSTRY_BENCHMARK = "isic_4digit"
INPUT_PREFIX = "input_"
TARGET_YEARS = (2030, 2050)
GEOGRAPHY_PRIORITY = 16
GEOGRAPHY_ROWS = 2
TARGET_ID_COLUMNS = ("scenario_targets_ipr_id", "scenario_targets_weo_id")
# Activity column -> ledger column.
MATCH_COLUMNS = {
    "geography": "ecoinvent_geography",
    "isic_4digit": "isic_code",
    "cpc_code": "cpc_code",
    "activity_type": "activity_type",
}


# -- matching and preparation -------------------------------------------------------------------


def match_ledger(
    ledger: DataFrame,
    activities: DataFrame,
    match: Mapping[str, str] = MATCH_COLUMNS,
    ledger_id: str = "ledger_id",
    priority: str = "priority",
) -> DataFrame:
    """Activities per ledger entry, only those of the best (lowest) priority; ties stay.

    The best priority is looked for per ledger entry, product, activity name and activity type.
    """
    renamed = activities.withColumnsRenamed({a: f"_{a}" for a in match})
    keys = [ledger_id, "reference_product_name", "activity_name", "activity_type"]
    names, own = [f"_{a}" for a in match], [k for k in keys if k in renamed.columns]
    condition = [F.col(f"_{a}") == F.col(b) for a, b in match.items()]
    # Activities that agree in these columns stand or fall together: one of each kind is judged.
    kinds = renamed.select(*names, *own).distinct()
    best = keep_lowest(kinds.join(ledger, condition).drop(*names), keys, priority)
    # The industry code of the activity stays next to the one of the ledger.
    same_name = [f"_{a}" for a in match if a != INDUSTRY_BENCHMARK]
    same_kind = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in own]
    matched = renamed.join(best.withColumnsRenamed({k: f"_of_{k}" for k in own}), [*condition, *same_kind])
    matched = matched.drop(*same_name, *[f"_of_{k}" for k in own])
    if INDUSTRY_BENCHMARK in match:
        matched = matched.withColumnRenamed(f"_{INDUSTRY_BENCHMARK}", INDUSTRY_BENCHMARK)
    return matched


def clean_codes(df: DataFrame, column: str = "isic_code") -> DataFrame:
    require_columns(df, column)
    return df.withColumn(column, clean_industry_code(F.col(column)))


def check_emission_columns(
    df: DataFrame, co2: str = "co2_footprint", sector: str = "sector", unit: str = "unit"
) -> None:
    """The needed columns must be there, and at least one row."""
    for name in (co2, sector, unit):
        find_column(df, name)
    if df.isEmpty():
        raise ValueError("Dataframe is empty")


def complete_emissions(
    df: DataFrame, co2: str = "co2_footprint", sector: str = "sector", isic: str = "isic_code"
) -> DataFrame:
    """Rows that have a sector, an industry code and a footprint."""
    return df.dropna(subset=[sector, isic, co2])


# -- assertions ---------------------------------------------------------------------------------


def sector_violations(
    df: DataFrame, isic: str = "isic_code", sector: str = "sector", subsector: str = "subsector"
) -> DataFrame:
    """How many rows with an industry code lack a sector or a subsector."""
    lacking = F.col(isic).isNotNull() & (F.col(sector).isNull() | F.col(subsector).isNull())
    return df.agg(F.count_if(lacking).alias("violations"))


def product_name_violations(df: DataFrame, product_name: str = "product_name") -> DataFrame:
    return df.agg(F.count_if(F.col(product_name).isNull()).alias("violations"))


def geography_violations(
    df: DataFrame, product: str = "input_activity_uuid_product_uuid"
) -> DataFrame:
    """Inputs with several geographies at the last priority, or several names without priority.

    The same check serves activities and ledger entries: ``product`` is the id column.
    """
    nearest = df.where(F.col("row_num") <= GEOGRAPHY_ROWS)
    geographies = nearest.where(F.col("input_priority") == GEOGRAPHY_PRIORITY).select(
        product, F.col("input_geography").alias("_what"), F.lit("geography").alias("rule")
    )
    names = nearest.where(F.col("input_priority").isNull()).select(
        product, F.col("input_product_name").alias("_what"), F.lit("no priority").alias("rule")
    )
    # Distinct first: a hot input shrinks to its few geographies before it is counted.
    return (
        geographies.unionByName(names)
        .distinct()
        .groupBy("rule", product)
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .groupBy("rule")
        .agg(F.count(F.lit(1)).alias("violations"))
    )


def require_none(violations: DataFrame, message: str) -> None:
    """Raise if a violation count is not zero."""
    if not violations.where("violations > 0").isEmpty():
        raise ValueError(message)


def assert_sectors_present(df: DataFrame, **columns: str) -> None:
    require_none(
        sector_violations(df, **columns), "Industry codes without a sector or subsector were found"
    )


def assert_product_names(df: DataFrame, product_name: str = "product_name") -> None:
    require_none(product_name_violations(df, product_name), f"Column {product_name} (product_name) holds nulls")


def assert_one_geography(df: DataFrame, product: str = "input_activity_uuid_product_uuid") -> None:
    found = geography_violations(df, product)
    require_none(
        found.where("rule = 'geography'"),
        f"Products lie in several geographies at one and the same priority `{GEOGRAPHY_PRIORITY}`",
    )
    require_none(
        found.where("rule = 'no priority'"),
        "Products without a geography have several rows without a priority (NA input priority)",
    )


# -- benchmark ranks ----------------------------------------------------------------------------


def benchmarks(isic: str, sector: str, unit: str, prefix: str = "") -> dict[str, list[str]]:
    """The six benchmark groups: label and the columns that form it."""
    sector_label, unit_label = sector.removeprefix(prefix), unit.removeprefix(prefix)
    return {
        ALL_BENCHMARK: [],
        f"{prefix}{INDUSTRY_BENCHMARK}": [isic],
        f"{prefix}{sector_label}": [sector],
        f"{prefix}{unit_label}": [unit],
        f"{prefix}{unit_label}_{INDUSTRY_BENCHMARK}": [unit, isic],
        f"{prefix}{unit_label}_{sector_label}": [unit, sector],
    }


def per_benchmark(
    df: DataFrame, groups: Mapping[str, Sequence[str]], keep: Sequence[str]
) -> tuple[DataFrame, list[str]]:
    """Each row once per benchmark, like grouping sets: the kept columns and what names its group there.

    That is the number of the benchmark and the columns that form it; the others are null.
    """
    columns = list(dict.fromkeys(c for formed in groups.values() for c in formed))
    names = [f"_by{i}" for i in range(len(columns))]
    choices = [
        F.struct(
            F.lit(i).cast("tinyint").alias("_benchmark"),
            *[
                (F.col(c) if c in formed else F.lit(None).cast(df.schema[c].dataType)).alias(name)
                for c, name in zip(columns, names, strict=True)
            ],
        )
        for i, formed in enumerate(groups.values())
    ]
    return df.select(*keep, F.inline(F.array(*choices))), ["_benchmark", *names]


def _label(groups: Mapping[str, Sequence[str]], number: str = "_benchmark") -> Column:
    """The label of a benchmark's number."""
    return F.array(*[F.lit(label) for label in groups])[F.col(number).cast("int")]


def emission_profile(
    mapping: DataFrame,
    emissions: DataFrame,
    ledger_id: str = "ledger_id",
    activity_id: str = "activity_uuid_product_uuid",
    co2: str = "co2_footprint",
    isic: str = "isic_code",
    sector: str = "sector",
    unit: str = "unit",
    null_band: str | None = None,
) -> DataFrame:
    """Average relative footprint rank of each ledger entry in six benchmark groups.

    A rank is relative to the number of distinct footprints (benchmark ``all``) or to the number of
    rows of its group. Of the activities of a ledger entry, the one with the lowest id lends its
    other columns.
    """
    groups = benchmarks(isic, sector, unit)
    narrow = emissions.select(*dict.fromkeys([activity_id, co2, isic, sector, unit]))
    repeated, by = per_benchmark(narrow, groups, [activity_id, co2])
    ranked = with_dense_rank(repeated, by, co2)
    size = F.when(F.col("_benchmark") == list(groups).index(ALL_BENCHMARK), F.col("distinct_count")).otherwise(
        F.col("row_count")
    )
    ranked = ranked.withColumn("profile_ranking", F.col("dense_rank") / size)
    # Only ids, footprints and ranks exist once per benchmark.
    ids = mapping.select(ledger_id, activity_id)
    scored = ids.join(
        ranked.select(activity_id, "_benchmark", "profile_ranking", co2), activity_id
    )
    averages = scored.groupBy(ledger_id, "_benchmark").agg(
        F.avg("profile_ranking").alias("average_profile_ranking"),
        F.avg(co2).alias(f"average_{co2}"),
    )
    averages = averages.select(
        ledger_id, _label(groups).alias("benchmark_group"), "average_profile_ranking", f"average_{co2}"
    )
    # All other columns are looked up for one activity per ledger entry only.
    known = ids.join(narrow.select(activity_id), activity_id, "left_semi")
    lowest = known.groupBy(ledger_id).agg(F.min(activity_id).alias(activity_id))
    wide = null_safe_join(mapping, lowest, [ledger_id, activity_id]).join(emissions, activity_id)
    rest = [c for c in wide.columns if c not in (ledger_id, activity_id)]
    kept = first_per_group(wide, [ledger_id], [activity_id, *rest])
    return (
        null_safe_join(averages, kept, [ledger_id])
        .withColumnsRenamed({"reference_product_name": "product_name"})
        .withColumn(
            "risk_category", risk_band(F.col("average_profile_ranking"), RANK_BANDS, null_band)
        )
    )


def upstream_profile(
    mapping: TrackedFrame,
    upstream: TrackedFrame,
    ledger_id: str = "ledger_id",
    activity_id: str = "activity_uuid_product_uuid",
    co2: str = "input_co2_footprint",
    isic: str = "input_isic_code",
    sector: str = "input_sector",
    unit: str = "input_unit",
    null_band: str | None = None,
) -> TrackedFrame:
    """Average relative footprint rank of the inputs of each ledger entry, with lineage.

    Here a rank is relative to the highest rank of its group in all six benchmarks.
    """
    groups = benchmarks(isic, sector, unit, INPUT_PREFIX)
    narrow = upstream.select(*dict.fromkeys([activity_id, co2, isic, sector, unit]))
    ledger = mapping.select(ledger_id, activity_id)
    # Ranks do without lineage: every input is in all six benchmarks, so a ledger entry has the same sources in each.
    # Inputs are shuffled once each to be ranked, once each to meet the ledger, and repeated per benchmark after that.
    inputs, runs = range_ranks(narrow.data, list(groups.values()), co2)
    ranked = per_set(ledger.data.join(inputs, activity_id), runs, list(groups.values()))
    share = F.col("dense_rank") / F.col("distinct_count")
    scored = ledger.with_df(
        ranked.select(ledger_id, _label(groups, "_set").alias("benchmark_group"), co2, share.alias("profile_ranking"))
    )
    averages = scored.group_by(
        [ledger_id, "benchmark_group"],
        F.avg("profile_ranking").alias("average_input_profile_rank"),
        F.avg(co2).alias(f"average_{co2}"),
        members=ledger.join(narrow.select(activity_id), on=activity_id, how="inner"),
        each={"benchmark_group": list(groups)},
    )
    band = risk_band(F.col("average_input_profile_rank"), RANK_BANDS, null_band)
    return averages.with_columns(risk_category=band)


# -- reduction targets --------------------------------------------------------------------------


def reductions(
    df: DataFrame,
    names: Mapping[str, str],
    sector: str | None = None,
    subsector: str | None = None,
) -> DataFrame:
    """Reduction of each target year against the first year of its pathway, rounded to 2 digits.

    The first value per pathway is one aggregation; only rows of the target years are joined to it.
    """
    subsector = subsector or find_column(df, "_subsector")
    sector = sector or find_column(df.drop(subsector), "_sector")
    keys = ["scenario", "region", sector, subsector]
    first = first_value_by(df, keys, "year", "value", "first_value")
    targets = df.where(F.col("year").isin(*TARGET_YEARS))
    share = (F.lit(1) - F.col("value") / F.col("first_value")).cast("double")
    renamed = F.col("scenario")
    if names:
        renamed = F.coalesce(F.create_map(*_pairs(_followed(names)))[F.col("scenario")], renamed)
    return (
        null_safe_join(targets, first, keys)
        .withColumn("reductions", F.round(share, 2))
        .withColumn("scenario", renamed)
    )


def _followed(names: Mapping[str, str]) -> dict[str, str]:
    """Renames are applied one after the other, so a new name may be renamed again."""
    result = {}
    for start in names:
        name = start
        for old, new in names.items():
            name = new if name == old else name
        result[start] = name
    return result


def _pairs(names: Mapping[str, str]) -> list[Column]:
    return [F.lit(text) for pair in names.items() for text in pair]


def scenario_columns(df: DataFrame, scenario_type: str | None = None) -> DataFrame:
    """Replace the scenario prefix of the column names by ``scenario`` and add it as a column."""
    if scenario_type is None:
        prefixes = {c.split("_")[0] for c in df.columns if "sector" in c}
        if len(prefixes) != 1:
            raise ValueError(f"Expected one scenario prefix, found {sorted(prefixes)}")
        scenario_type = prefixes.pop()
    head = f"{scenario_type}_"
    names = {c: f"scenario_{c.removeprefix(head)}" for c in df.columns if c.startswith(head)}
    return (
        df.withColumnsRenamed(names)
        .withColumn("scenario_type", F.lit(scenario_type))
        .withColumnsRenamed({"scenario": "scenario_name"})
        .drop("first_value")
    )


def combine_targets(
    first: TrackedFrame, second: TrackedFrame, ids: Sequence[str] = TARGET_ID_COLUMNS
) -> TrackedFrame:
    """Union of two target sets; their own id columns keep rows apart and are then dropped."""

    def aligned(frame: TrackedFrame) -> TrackedFrame:
        return frame.rename({c: "_target_id" for c in frame.values if c in ids})

    combined = aligned(first).union(aligned(second))
    field = {f.name: f.dataType for f in combined.df.schema.fields}.get("reductions")
    if field is None:
        raise ValueError("`reductions` column not found in the combined targets")
    if not isinstance(field, T.DoubleType):
        raise ValueError("`reductions` column in the combined targets is not a double")
    return combined.drop("_target_id")


def sector_profile(df: DataFrame, prefix: str = "", null_band: str | None = None) -> DataFrame:
    """Risk band of each reduction target; years without bands are dropped.

    ``prefix='input_'`` gives the upstream form.
    """
    year, target = F.col(f"{prefix}year"), F.col(f"{prefix}reductions")
    band = F.lit(None).cast("string")
    for value, limits in REDUCTION_BANDS.items():
        band = F.when(year == value, risk_band(target, limits, null_band)).otherwise(band)
    label = F.concat_ws("_", f"{prefix}scenario_type", f"{prefix}scenario_name", year)
    names = {f"{prefix}reductions": "profile_ranking"}
    if not prefix:
        names["reference_product_name"] = "product_name"
    return (
        df.where(year.isin(*REDUCTION_BANDS))
        .withColumns({"risk_category": band, "benchmark_group": F.lower(label)})
        .withColumnsRenamed(names)
    )


def transition_risk(df: DataFrame) -> DataFrame:
    """Mean of the emission and the sector rank, limited to [0, 1]; null if either is missing."""
    emission, sector = F.col("average_profile_ranking"), F.col("profile_ranking")
    known = emission.isNotNull() & sector.isNotNull()
    label = F.concat_ws("_", "scenario_year", "benchmark_group")
    return df.withColumns(
        {
            "transition_risk_score": F.when(known, clamp_unit((emission + sector) / 2)),
            "benchmark_group": F.when(known, label),
        }
    )
