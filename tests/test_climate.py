import math

import pytest
from pyspark.sql import functions as F

from layerloom.functions import text
from layerloom.functions.bands import RANK_BANDS, clamp_unit, risk_band
from layerloom.operators import ranking
from layerloom.operators.lineage import seed
from layerloom.operators.relations import first_per_group, first_value_by, keep_lowest
from layerloom.operators.tracked import TrackedFrame
from layerloom.plans import climate
from tests.conftest import rows


def values(spark, data, schema="v string"):
    return spark.createDataFrame([(d,) for d in data], schema)


def column(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def test_structured_postcode(spark):
    df = values(spark, ["1234ab", "1234 AB", "1234", "ab", "", None])
    expected = ["1234 AB", "1234 AB", "1234 ", " AB", " ", None]
    assert column(df, text.structure_postcode(F.col("v"))) == expected


def test_postcode_from_address(spark):
    data = [("1234", "ab town"), ("town", "town"), ("kruiningen", "kruiningen"), (None, "x"), ("5678cd", "5678cd")]
    df = spark.createDataFrame(data, "p string, c string")
    found = column(df, text.postcode_from_address(F.col("p"), F.col("c")))
    assert found == ["1234 AB", " WN", "", "", "5678 CD"]


def test_preferred_name_and_codes(spark):
    df = spark.createDataFrame([("Shop", "Shop BV"), ("Shop", None)], "d string, s string")
    assert column(df, text.preferred_name(F.col("d"), F.col("s"))) == ["shop bv", "shop"]
    codes = values(spark, ["'12'", "1234", "12345", None]).toDF("isic_code")
    assert column(climate.clean_codes(codes), F.col("isic_code")) == ["0012", "1234", "12345", None]
    with pytest.raises(ValueError, match="isic_code"):
        climate.clean_codes(values(spark, ["x"]))


def test_bands(spark):
    df = values(spark, [0.0, 1 / 3, 0.5, 2 / 3, 0.9, None], "v double")
    assert column(df, risk_band(F.col("v"), RANK_BANDS)) == ["low", "low", "medium", "medium", "high", None]
    assert column(df, risk_band(F.col("v"), RANK_BANDS, "high"))[-1] == "high"
    assert column(values(spark, [-1.0, 0.5, 2.0, None], "v double"), clamp_unit(F.col("v"))) == [0.0, 0.5, 1.0, None]


@pytest.mark.parametrize("buckets", [1, 3, 50])
def test_distributed_dense_rank_equals_window(spark, buckets):
    data = [(g, v) for g in ("a", "b", None) for v in (5.0, 1.0, 1.0, None, float("nan"), -2.0, 7.5, 7.5, float("inf"), -0.0, 0.0)]
    df = spark.createDataFrame(data + [("a", 1.0)] * 40, "g string, v double")
    ranked = ranking.with_dense_rank(df, ["g"], "v", buckets)

    def key(row):
        return tuple("nan" if isinstance(c, float) and math.isnan(c) else str(c + 0.0 if isinstance(c, float) else c) for c in row)

    found = {key((r.g, r.v)): (r.dense_rank, r.distinct_count, r.row_count) for r in ranked.collect()}
    order = [None, -2.0, 0.0, 1.0, 5.0, 7.5, float("inf"), float("nan")]
    for group, n in (("a", 51), ("b", 11), (None, 11)):
        for position, value in enumerate(order, start=1):
            assert found[key((group, value))] == (position, len(order), n)
    assert ranked.count() == df.count()


def test_rank_over_the_whole_table(spark):
    df = values(spark, [3, 1, 1, None], "v int")
    assert rows(ranking.with_dense_rank(df, [], "v"), "v", "dense_rank") == [(1, 2), (1, 2), (3, 3), (None, 1)]
    none = df.where("v > 99")
    assert ranking.with_dense_rank(none, [], "v").count() == 0


def test_group_helpers(spark):
    df = spark.createDataFrame([("a", 2, 1), ("a", 1, 2), ("a", 1, 3), (None, 5, 4), ("b", None, 5), ("b", 1, 6)], "k string, v int, n int")
    assert rows(keep_lowest(df, ["k"], "v"), "n") == [(2,), (3,), (4,), (5,)]
    assert rows(first_per_group(df, ["k"], ["n"]), "n") == [(1,), (4,), (5,)]
    assert rows(first_value_by(df, ["k"], "n", "v", "first")) == [("a", 2), ("b", None), (None, 5)]


def test_keep_lowest_has_no_window(spark):
    df = spark.createDataFrame([("a", 2)], "k string, v int")
    assert "Window" not in keep_lowest(df, ["k"], "v")._jdf.queryExecution().executedPlan().toString()


LEDGER = "ledger_id string, ecoinvent_geography string, isic_code string, cpc_code string, activity_type string, priority int"
ACTIVITY = (
    "activity_uuid_product_uuid string, geography string, isic_4digit string, cpc_code string, activity_type string, "
    "reference_product_name string, activity_name string"
)


def test_match_ledger(spark):
    ledger = spark.createDataFrame(
        [("L1", "NL", "0111", "c", "market", 2), ("L1", "EU", "0111", "c", "market", 1), ("L2", "XX", "0111", "c", "market", 1)],
        LEDGER,
    )
    activities = spark.createDataFrame(
        [("A1", "NL", "0111", "c", "market", "p", "n"), ("A2", "EU", "0111", "c", "market", "p", "n"), ("A3", "EU", "0111", "c", "market", "p", "n")],
        ACTIVITY,
    )
    found = climate.match_ledger(ledger, activities)
    assert rows(found, "ledger_id", "activity_uuid_product_uuid") == [("L1", "A2"), ("L1", "A3")]
    assert set(found.columns) == {
        "activity_uuid_product_uuid", "isic_4digit", "reference_product_name", "activity_name", "ledger_id",
        "ecoinvent_geography", "isic_code", "cpc_code", "activity_type", "priority",
    }


def test_activities_of_one_kind_are_judged_as_one(spark, monkeypatch):
    """What is looked through for the best priority grows with the ledger, not with ledger times equal activities."""
    judged = []
    monkeypatch.setattr(climate, "keep_lowest", lambda df, *a: judged.append(df.count()) or keep_lowest(df, *a))
    ledger = spark.createDataFrame(
        [(f"L{i % 10}", "EU", "0111", c, "market", p) for i, (c, p) in enumerate([("c", 1), ("c", 1), ("d", 2), ("c", None)] * 10)],
        LEDGER,
    )
    activities = spark.createDataFrame(
        [(f"A{i}", "EU", "0111", c, "market", None if c == "d" else "p", "n") for i in range(30) for c in "cd"], ACTIVITY
    )
    found = climate.match_ledger(ledger, activities)
    assert judged == [40]
    best = {c: [r.priority for r in found.where(F.col("cpc_code") == c).collect()] for c in "cd"}
    low = [(r.ledger_id, r.priority) for r in ledger.where("cpc_code = 'c'").collect()]
    nulls = {i for i, p in low if p is None}
    assert len(best["c"]) == 30 * sum(p is None or i not in nulls for i, p in low)
    assert len(best["d"]) == 30 * 10 and set(best["d"]) == {2}
    assert found.where("reference_product_name is null").count() == 30 * 10


def test_emission_profile(spark):
    emissions = spark.createDataFrame(
        [("A1", "one", 10.0, "i", "s", "kg"), ("A2", "two", 20.0, "i", "s", "m3"), ("A3", "three", 20.0, "j", None, "kg")],
        "activity_uuid_product_uuid string, reference_product_name string, co2_footprint double, isic_code string, sector string, unit string",
    )
    mapping = spark.createDataFrame(
        [("L1", "A1"), ("L1", "A2"), ("L2", "A3"), ("L3", "A9")], "ledger_id string, activity_uuid_product_uuid string"
    )
    profile = climate.emission_profile(mapping, emissions)
    found = {(r.ledger_id, r.benchmark_group): r for r in profile.collect()}
    assert set(found) == {
        (l, b)
        for l in ("L1", "L2")
        for b in ("all", "isic_4digit", "sector", "unit", "unit_isic_4digit", "unit_sector")
    }
    whole = found[("L1", "all")]
    assert whole.average_profile_ranking == pytest.approx((1 / 2 + 2 / 2) / 2)
    assert (whole.average_co2_footprint, whole.activity_uuid_product_uuid, whole.product_name) == (15.0, "A1", "one")
    assert whole.risk_category == "high"
    assert found[("L1", "unit")].average_profile_ranking == pytest.approx((1 / 2 + 1) / 2)
    assert found[("L2", "sector")].average_profile_ranking == 1.0
    labels = climate.benchmarks("input_isic_code", "input_sector", "input_unit", "input_")
    assert list(labels) == [
        "all", "input_isic_4digit", "input_sector", "input_unit", "input_unit_isic_4digit", "input_unit_sector",
    ]


def test_upstream_profile(spark):
    upstream = TrackedFrame(
        seed(
            spark.createDataFrame(
                [("u1", "A1", 10.0, "i", "s", "kg"), ("u2", "A1", 30.0, "i", "s", "kg"), ("u3", "A2", 30.0, "i", None, "kg")],
                "RecordID string, activity_uuid_product_uuid string, input_co2_footprint double, input_isic_code string, input_sector string, input_unit string",
            ),
            "upstream_raw",
        )
    )
    mapping = TrackedFrame(
        seed(
            spark.createDataFrame(
                [("m1", "L1", "A1"), ("m2", "L9", "A9")], "RecordID string, ledger_id string, activity_uuid_product_uuid string"
            ),
            "mapping_raw",
        )
    )
    profile = climate.upstream_profile(mapping, upstream)
    found = {r.benchmark_group: r for r in profile.df.collect()}
    assert len(found) == 6 and {r.ledger_id for r in found.values()} == {"L1"}
    assert found["all"].average_input_profile_rank == pytest.approx(0.75)
    assert found["all"].average_input_co2_footprint == 20.0
    assert profile.values == [
        "ledger_id", "benchmark_group", "average_input_profile_rank", "average_input_co2_footprint", "risk_category",
    ]
    sources = profile.where("benchmark_group = 'all'").sources("ledger_id")
    assert rows(sources, "source_RecordID") == [("m1",), ("u1",), ("u2",)]


PATHWAY = [("s1", "r", "a", "b", y, v) for y, v in ((2030, 75.0), (2020, 100.0), (2050, 20.0), (2040, 50.0))]


def pathway(spark, data=PATHWAY):
    return spark.createDataFrame(data, "scenario string, region string, ipr_sector string, ipr_subsector string, year int, value double")


def test_reductions(spark):
    found = climate.reductions(pathway(spark), {"s1": "s2", "s2": "short"})
    assert rows(found, "scenario", "year", "reductions") == [("short", 2030, 0.25), ("short", 2050, 0.8)]
    with pytest.raises(ValueError):
        climate.reductions(pathway(spark).drop("ipr_subsector"), {})


def test_scenario_columns(spark):
    shaped = climate.scenario_columns(climate.reductions(pathway(spark), {}))
    assert set(shaped.columns) == {
        "scenario_name", "region", "scenario_sector", "scenario_subsector", "year", "value", "reductions", "scenario_type",
    }
    assert shaped.first().scenario_type == "ipr"
    with pytest.raises(ValueError, match="prefix"):
        climate.scenario_columns(pathway(spark).withColumn("weo_sector", F.lit(1)))
    explicit = climate.scenario_columns(pathway(spark).withColumn("weo_sector", F.lit(1)), "ipr")
    assert "weo_sector" in explicit.columns


def test_combine_targets(spark):
    def targets(source, identity, data, kind="double"):
        return TrackedFrame(seed(spark.createDataFrame(data, f"RecordID string, {identity} string, reductions {kind}"), source)).drop("RecordID")

    one = targets("ipr_raw", "scenario_targets_ipr_id", [("1", "x", 0.5)])
    two = targets("weo_raw", "scenario_targets_weo_id", [("2", "x", 0.5), ("3", "y", 0.5)])
    combined = climate.combine_targets(one, two)
    assert combined.values == ["reductions"]
    assert rows(combined.data) == [(0.5,), (0.5,)]
    whole = targets("ipr_raw", "scenario_targets_ipr_id", [("1", "x", 1)], "int")
    with pytest.raises(ValueError, match="not a double"):
        climate.combine_targets(whole, whole)
    with pytest.raises(ValueError, match="not found"):
        climate.combine_targets(one.drop("reductions"), one.drop("reductions"))


def test_sector_profile(spark):
    data = [("ipr", "Net Zero", y, r) for y in (2030, 2050, 2040) for r in (0.1, 0.3, 0.7, None)]
    df = spark.createDataFrame(data, "scenario_type string, scenario_name string, year int, reductions double")
    profile = climate.sector_profile(df.withColumn("reference_product_name", F.lit("p")))
    assert rows(profile, "year", "profile_ranking", "risk_category")[:4] == [
        (2030, 0.1, "low"),
        (2030, 0.3, "medium"),
        (2030, 0.7, "high"),
        (2030, None, None),
    ]
    assert rows(profile.where("year = 2050"), "risk_category") == [("high",), ("low",), ("medium",), (None,)]
    assert profile.first().benchmark_group == "ipr_net zero_2030" and "product_name" in profile.columns
    upstream = climate.sector_profile(df.toDF(*[f"input_{c}" for c in df.columns]), "input_")
    assert rows(upstream, "risk_category") == rows(profile, "risk_category")


def test_transition_risk(spark):
    df = spark.createDataFrame(
        [(0.5, 0.7, 2030, "all"), (None, 0.7, 2030, "all"), (2.0, 0.7, 2030, "all"), (-2.0, 0.7, 2030, "all")],
        "average_profile_ranking double, profile_ranking double, scenario_year int, benchmark_group string",
    )
    found = climate.transition_risk(df).select("transition_risk_score", "benchmark_group").collect()
    assert [r[0] for r in found] == [pytest.approx(0.6), None, 1.0, 0.0]
    assert [r[1] for r in found] == ["2030_all", None, "2030_all", "2030_all"]


def test_assertions(spark):
    df = spark.createDataFrame([("1", "s", "t", "p"), (None, None, None, "q")], "isic_code string, sector string, subsector string, product_name string")
    climate.assert_sectors_present(df)
    climate.assert_product_names(df)
    for name in ("sector", "subsector"):
        with pytest.raises(ValueError, match="sector"):
            climate.assert_sectors_present(df.withColumn(name, F.lit(None).cast("string")))
    with pytest.raises(ValueError, match="product_name"):
        climate.assert_product_names(df.withColumn("product_name", F.lit(None)))


GEOGRAPHY = "input_activity_uuid_product_uuid string, input_geography string, input_product_name string, input_priority int, row_num int"


@pytest.mark.parametrize(
    ("extra", "message"),
    [
        (("A", "DE", "p", 16, 2), "several geographies"),
        (("B", None, "q", None, 2), "several rows without a priority"),
        (("A", "DE", "p", 16, 3), None),
        (("A", "NL", "p", 16, 2), None),
        (("A", "DE", "p", 15, 2), None),
        (("B", None, "p", None, 2), None),
    ],
)
def test_one_geography(spark, extra, message):
    df = spark.createDataFrame([("A", "NL", "p", 16, 1), ("B", None, "p", None, 1), extra], GEOGRAPHY)
    for product in ("input_activity_uuid_product_uuid", "input_ledger_id"):
        named = df.withColumnRenamed("input_activity_uuid_product_uuid", product)
        if message is None:
            climate.assert_one_geography(named, product)
        else:
            with pytest.raises(ValueError, match=message):
                climate.assert_one_geography(named, product)


def test_emission_columns(spark):
    df = spark.createDataFrame([(1.0, "s", "kg", "i"), (None, "s", "kg", "i"), (1.0, None, "kg", "i"), (1.0, "s", "kg", None)], "co2_footprint double, sector string, unit string, isic_code string")
    climate.check_emission_columns(df)
    assert climate.complete_emissions(df).count() == 1
    with pytest.raises(ValueError, match="empty"):
        climate.check_emission_columns(df.where("false"))
    with pytest.raises(ValueError):
        climate.check_emission_columns(df.drop("unit"))
