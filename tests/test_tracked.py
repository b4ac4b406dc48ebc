import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerloom.constants import LINEAGE
from layerloom.operators import lineage
from layerloom.operators.tracked import TrackedFrame
from tests.conftest import rows


def frame(spark, source, data, schema):
    return TrackedFrame(lineage.seed(spark.createDataFrame(data, schema), source))


@pytest.fixture
def left(spark):
    data = [("l1", 1, "a"), ("l2", 2, "b"), ("l3", 2, "c"), ("l4", None, "d")]
    return frame(spark, "left_raw", data, "RecordID string, k int, v string").drop("RecordID")


@pytest.fixture
def right(spark):
    data = [("r1", 1, "x"), ("r2", 2, "y"), ("r3", 3, "z"), ("r4", None, "n")]
    return frame(spark, "right_raw", data, "RecordID string, k int, w string").drop("RecordID")


def edges(tracked, *keep):
    return rows(tracked.sources(*keep), *keep, "source_RecordID")


def test_seed(spark):
    seeded = frame(spark, "test_df", [("123",), ("456",)], "RecordID string")
    assert [tuple(r[LINEAGE][0]) for r in seeded.df.orderBy("RecordID").collect()] == [
        ("test_df", "123"),
        ("test_df", "456"),
    ]


def test_rename(space):
    table = space.read("test_transaction_fact_table_landingzone")
    renamed = table.rename({"transaction_id": "transaction_id_new"})
    assert renamed.df.columns == ["transaction_id_new", "amount", "product_fk"]
    assert table.df.columns[0] == "transaction_id"
    with pytest.raises(ValueError):
        table.rename({"transaction_id_invalid": "transaction_id_new"})


def test_column_operators_keep_lineage(left):
    assert left.select("v").df.columns == ["v", LINEAGE]
    assert left.select("v", LINEAGE).df.columns == ["v", LINEAGE]
    assert left.select(F.upper("v").alias("u")).values == ["u"]
    assert left.drop("v").values == ["k"]
    assert left.cast(["k"], T.StringType()).df.schema["k"].dataType == T.StringType()
    with pytest.raises(ValueError):
        left.drop(LINEAGE)


def test_landing_frames_have_no_lineage(space):
    table = space.read("test_transaction_fact_table_landingzone")
    assert table.select("amount").df.columns == ["amount"]
    assert table.group_by(["product_fk"], F.sum("amount").alias("s")).df.columns == ["product_fk", "s"]


def test_unpivot(left):
    long = left.with_columns(a=F.lit(1), b=F.lit(2)).unpivot(["v"], ["a", "b"], "name", "value")
    assert rows(long.data)[:2] == [("a", "a", 1), ("a", "b", 2)]
    assert edges(long, "v", "name")[:2] == [("a", "a", "l1"), ("a", "b", "l1")]


@pytest.mark.parametrize(
    ("how", "expected"),
    [
        ("inner", {(1, "a", "x"), (2, "b", "y"), (2, "c", "y")}),
        ("left", {(1, "a", "x"), (2, "b", "y"), (2, "c", "y"), (None, "d", None)}),
        ("right", {(1, "a", "x"), (2, "b", "y"), (2, "c", "y"), (3, None, "z"), (None, None, "n")}),
        (
            "full",
            {(1, "a", "x"), (2, "b", "y"), (2, "c", "y"), (3, None, "z"), (None, "d", None), (None, None, "n")},
        ),
    ],
)
def test_join_on(left, right, how, expected):
    joined = left.join(right, on="k", how=how)
    assert set(rows(joined.data, "k", "v", "w")) == expected
    found = {(r.v, r.w): {e.source_RecordID for e in r[LINEAGE]} for r in joined.df.collect()}
    assert found[("a", "x")] == {"l1", "r1"}
    for only_left in {k for k in found if k[1] is None}:
        assert found[only_left] == {"l4"}


def test_join_with_other_names(left, right):
    other = right.rename({"k": "key"})
    assert left.join(other, left_on="k", right_on="key", how="left").values == ["k", "v", "w"]
    assert left.join(other, left_on=["k"], right_on=["key"], how="right").values == ["v", "key", "w"]
    assert left.join(other, left_on="k", right_on="key", how="outer").values == ["k", "v", "key", "w"]
    by_expression = left.join(other, left_on=F.col("k") + 1, right_on=F.col("key"), how="inner")
    assert rows(by_expression.data, "v", "w") == [("a", "y"), ("b", "z"), ("c", "z")]


def test_semi_and_anti(left, right):
    assert edges(left.join(right, on="k", how="semi"), "v") == [("a", "l1"), ("b", "l2"), ("c", "l3")]
    assert edges(left.join(right, on="k", how="anti"), "v") == [("d", "l4")]


def test_join_errors(left, right):
    with pytest.raises(ValueError, match="type of join"):
        left.join(right, on="k")
    with pytest.raises(ValueError, match="left_on"):
        left.join(right, how="left")
    with pytest.raises(ValueError, match="columns"):
        left.join(left.rename({"k": "key"}), left_on="k", right_on="key", how="inner")


def test_same_source_on_both_sides_is_listed_once(left):
    other = left.rename({"v": "w"})
    assert edges(left.join(other, on="k", how="inner").where("v = 'a'"), "v") == [("a", "l1")]


def test_tracked_with_untracked(left, spark):
    plain = TrackedFrame(spark.createDataFrame([(1, "x"), (9, "y")], "k int, w string"))
    assert edges(left.join(plain, on="k", how="full"), "v", "w") == [
        ("a", "x", "l1"),
        ("b", None, "l2"),
        ("c", None, "l3"),
        ("d", None, "l4"),
    ]


def test_group_by_keeps_null_groups(left):
    grouped = left.group_by(["k"], F.count(F.lit(1)).alias("n"), F.max("v").alias("m"))
    assert rows(grouped.data) == [(1, 1, "a"), (2, 2, "c"), (None, 1, "d")]
    assert edges(grouped, "k") == [(1, "l1"), (2, "l2"), (2, "l3"), (None, "l4")]


def test_group_by_is_one_aggregation(spark, tmp_path, left):
    left.data.write.parquet(str(tmp_path / "t"))
    stored = TrackedFrame(lineage.seed(spark.read.parquet(str(tmp_path / "t")).withColumn("RecordID", F.col("v")), "s"))
    plan = stored.group_by(["k"], F.count(F.lit(1)).alias("n")).df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan and "collect_list" not in plan


def test_average(left):
    average = left.with_columns(n=F.lit(2)).average(["k"], "n", "mean")
    assert rows(average.data) == [(1, 2.0), (2, 2.0), (None, 2.0)]
    assert left.average([], "k").data.first()[0] == pytest.approx(5 / 3)


def test_distinct_merges_sources(left):
    distinct = left.select("k").distinct()
    assert rows(distinct.data) == [(1,), (2,), (None,)]
    assert edges(distinct, "k") == [(1, "l1"), (2, "l2"), (2, "l3"), (None, "l4")]


def test_rows_without_sources_survive_grouping(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int").withColumn(LINEAGE, lineage.no_sources())
    tracked = TrackedFrame(df).distinct()
    assert rows(tracked.data) == [(1,), (2,)]
    assert edges(tracked, "k") == []


def test_union(left, right):
    other = right.rename({"w": "v"})
    both = left.select("k").union(other.select("k"))
    assert rows(both.data) == [(1,), (2,), (3,), (None,)]
    assert edges(both, "k") == [
        (1, "l1"),
        (1, "r1"),
        (2, "l2"),
        (2, "l3"),
        (2, "r2"),
        (3, "r3"),
        (None, "l4"),
        (None, "r4"),
    ]
    assert rows(left.union(other.select("v", "k")).data, "v")[:2] == [("a",), ("b",)]
    with pytest.raises(ValueError, match="Columns differ"):
        left.union(right)
    assert left.values == ["k", "v"]


def test_lineage_through_several_groupings(left, right):
    per_key = left.group_by(["k"], F.count(F.lit(1)).alias("n"))
    joined = per_key.join(right, on="k", how="inner")
    assert edges(joined, "k") == [(1, "l1"), (1, "r1"), (2, "l2"), (2, "l3"), (2, "r2")]
    everything = joined.group_by(["n"], F.count(F.lit(1)).alias("m"))
    assert edges(everything, "n") == [(1, "l1"), (1, "r1"), (2, "l2"), (2, "l3"), (2, "r2")]
    united = everything.select("n").union(per_key.select("n"))
    assert edges(united, "n") == [(1, "l1"), (1, "l4"), (1, "r1"), (2, "l2"), (2, "l3"), (2, "r2")]


def test_join_after_grouping_repeats_rows_but_not_edges(left, right):
    per_value = right.group_by(["k"], F.max("w").alias("w"))
    wide = left.select("k").join(per_value, on="k", how="inner")
    assert edges(wide, "k") == [(1, "l1"), (1, "r1"), (2, "l2"), (2, "l3"), (2, "r2")]
    again = per_value.join(left.select("k"), on="k", how="semi")
    assert edges(again, "k") == [(1, "r1"), (2, "r2")]


def test_changed_group_keys_do_not_repeat_edges(left):
    grouped = left.with_columns(h=F.lit(1)).group_by(["k", "v"], F.count(F.lit(1)).alias("n"))
    once = [(None, "l4"), (1, "l1"), (2, "l2"), (2, "l3")]
    everything = sorted(e for _, e in once)
    long = grouped.with_columns(a=F.lit(1), b=F.lit(2)).unpivot(["k", "v"], ["a", "b"], "name", "value")
    assert len(edges(long, "k", "v")) == 4
    assert edges(grouped.with_columns(k=F.lit(1), v=F.lit("x")), "k", "v") == [(1, "x", e) for e in everything]
    assert edges(grouped.rename({"k": "o"}).rename({"n": "k"}), "k", "v") == sorted(
        (1, v, e) for v, e in zip("abcd", everything)
    )
    assert len(edges(grouped.select(F.lit(1).alias("k"), F.lit(1).alias("v")), "k", "v")) == 4
    assert len(edges(grouped.cast(["k"], "string"), "k", "v")) == 4


EDGES = [
    ("a", "1", "b", "10"),
    ("a", "2", "b", "10"),
    ("b", "10", "c", "100"),
    ("b", "11", "c", "100"),
    ("x", "1", "y", "1"),
]


def trace_edges(spark):
    schema = "source_table_name string, source_RecordID string, target_table_name string, target_RecordID string"
    return spark.createDataFrame(EDGES, schema)


def test_trace(spark):
    starts = spark.createDataFrame([("c", "100"), ("b", "10")], "table_name string, RecordID string")
    found = lineage.trace(trace_edges(spark), starts)
    assert rows(found) == [
        (0, "b", "10", None, None),
        (0, "c", "100", None, None),
        (1, "a", "1", "b", "10"),
        (1, "a", "2", "b", "10"),
        (1, "b", "10", "c", "100"),
        (1, "b", "11", "c", "100"),
        (2, "a", "1", "b", "10"),
        (2, "a", "2", "b", "10"),
    ]
    own = lineage.trace(trace_edges(spark), starts, per_start=True)
    assert rows(own.where("start_RecordID = '10'"), "depth", "RecordID") == [(0, "10"), (1, "1"), (1, "2")]


def test_trace_of_a_cycle_raises(spark):
    loop = trace_edges(spark).unionByName(
        spark.createDataFrame([("c", "100", "a", "1")], trace_edges(spark).schema)
    )
    starts = spark.createDataFrame([("a", "1")], "table_name string, RecordID string")
    with pytest.raises(ValueError, match="cycle"):
        lineage.trace(loop, starts)


def test_trace_of_a_long_chain_ends(spark):
    chain = [("a", str(i), "a", str(i + 1)) for i in range(102)]
    edges = spark.createDataFrame(chain, trace_edges(spark).schema)
    starts = spark.createDataFrame([("a", "102")], "table_name string, RecordID string")
    assert lineage.trace(edges, starts).count() == 103


def test_small_groups_count_sources_with_their_aggregates(spark):
    def seeded(source, data, schema):
        rows_of = lineage.seed(spark.createDataFrame(data, schema), source).drop("RecordID")
        return TrackedFrame(rows_of, origin=lineage.Sources(once=frozenset({source})))

    flown = [("f1", "a", 1), ("f1", "a", 1), ("f2", "a", 5), ("f3", "b", 2), (None, "c", 4), ("f5", None, 7), ("f6", "d", 3)]
    flights = seeded("flights_raw", flown, "RecordID string, k string, v int")
    places = [("p1", "a", "A"), ("p2", "a", "A"), ("p3", "b", "A"), ("p4", "d", None)]
    airports = seeded("airports_raw", places, "RecordID string, place string, name string")
    joined = flights.join(airports, left_on="k", right_on="place", how="left")
    tables = {"n_flights": "flights_raw", "n_airports": "airports_raw"}

    def grouped(frame, small):
        return frame.group_by(["name"], F.count(F.lit(1)).alias("n"), F.max("v").alias("top"), small=small).rename({"name": "title"})

    counted = grouped(joined, True).counted(["title"], tables)
    assert rows(counted, "title", "n", "top", "n_flights", "n_airports") == [("A", 7, 5, 3, 3), (None, 3, 7, 2, 1)]
    plan = counted._jdf.queryExecution().executedPlan().toString()
    # Two shuffles for the join, if it is not a broadcast, and one that aggregates and numbers share.
    assert plan.count("Exchange hashpartitioning(name") == 1 and "Exchange hashpartitioning(title" not in plan
    # A row without any source: its group is left out, as where sources are looked up.
    lost = seeded("flights_raw", [(None, "x", 1), ("f1", "y", 1)], "RecordID string, name string, v int")
    assert rows(grouped(lost, True).counted(["title"], {"n_flights": "flights_raw"}), "title", "n_flights") == [("y", 1)]
    # Where a row may hold several entries of a table, or rows are not just the groups, sources are looked up.
    twice = joined.join(airports.rename({"place": "other", "name": "second"}), left_on="k", right_on="other", how="left")
    assert grouped(twice, True).counted(["title"], tables) is None
    assert grouped(joined, False).counted(["title"], tables) is None
    assert grouped(joined, True).where("n > 1").counted(["title"], tables) is None
    assert grouped(joined, True).counted(["title"], {"n_flights": "flights_raw"}) is None


def test_edges_of_small_groups_are_those_of_any_group(spark):
    def seeded(source, data, schema):
        rows_of = lineage.seed(spark.createDataFrame(data, schema), source).drop("RecordID")
        return TrackedFrame(rows_of, origin=lineage.Sources(once=frozenset({source})))

    long = "0123456789abcdef" * 4
    flights = seeded(
        "flights_raw", [("f1", "a"), ("f1", "a"), (long, "a"), (None, "b"), ("f4", "b"), ("f5", None), (None, "c")], "RecordID string, k string"
    )
    airports = seeded("airports_raw", [(long.upper(), "a"), ("p2", "a"), ("p3", "b")], "RecordID string, place string")
    joined = flights.join(airports, left_on="k", right_on="place", how="left")

    def found(small):
        grouped = joined.group_by(["k"], F.count(F.lit(1)).alias("n"), small=small)
        day = F.lit("2024-05-01").cast("date")
        stored = grouped.df.select(F.coalesce("k", F.lit("-")).alias("RecordID"), LINEAGE, day.alias("from_date"), F.lit("2099-12-31").cast("date").alias("to_date"))
        return lineage.open_edges(stored, grouped.origin, "t")

    wanted = ("source_RecordID", "source_table_name", "target_RecordID")
    assert rows(found(True), *wanted) == rows(found(False), *wanted)
    assert found(True).count() == 7
    # Rows meet their group as rows: entries are not shuffled ahead of it to find the distinct ones.
    optimized = found(True)._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("Aggregate") == 1 + 1  # the groups themselves, and the distinct entries


def test_held_frames_read_what_their_groups_were_computed_from(spark):
    origin_rows = frame(spark, "raw", [("r1", "a"), ("r2", "b")], "RecordID string, k string").drop("RecordID")
    grouped = origin_rows.group_by(["k"], F.count(F.lit(1)).alias("n"))
    with lineage.held(grouped.df, origin=grouped.origin):
        cached = grouped.df._jdf.queryExecution().withCachedData().toString()
        assert cached.count("InMemoryRelation") == 2
