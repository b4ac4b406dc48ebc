import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from layerloom.functions.hashing import row_hash
from layerloom.operators.history import add_record_id, first_history, merge_history
from tests.conftest import OPEN, rows

START, TODAY = dt.date(2023, 1, 1), dt.date(2024, 5, 1)
STORED = "col1 string, col2 string, RecordID string, from_date date, to_date date"


def stored(spark, values="abc", to_date=OPEN):
    data = [(v, str(i), f"id{v}", START, to_date) for i, v in enumerate(values)]
    return spark.createDataFrame(data, STORED)


def incoming(spark, data):
    return spark.createDataFrame(data, "col1 string, col2 string, RecordID string")


@pytest.mark.parametrize(
    ("values", "expected"),
    [
        ("abc", {"a": (START, OPEN), "b": (START, OPEN), "c": (START, OPEN)}),
        ("abcd", {"a": (START, OPEN), "b": (START, OPEN), "c": (START, OPEN), "d": (TODAY, OPEN)}),
        ("ab", {"a": (START, OPEN), "b": (START, OPEN), "c": (START, TODAY)}),
        ("abd", {"a": (START, OPEN), "b": (START, OPEN), "c": (START, TODAY), "d": (TODAY, OPEN)}),
        ("", {"a": (START, TODAY), "b": (START, TODAY), "c": (START, TODAY)}),
    ],
    ids=["no change", "added", "deleted", "dropped and added", "empty incoming"],
)
def test_merge(spark, values, expected):
    order = "abcd"
    new = incoming(spark, [(v, str(order.index(v)), "x") for v in values])
    merged = merge_history(new, stored(spark), TODAY)
    assert merged.columns == ["col1", "col2", "from_date", "to_date"]
    assert {r.col1: (r.from_date, r.to_date) for r in merged.collect()} == expected


def test_closed_rows_pass_through_and_may_return(spark):
    closed = stored(spark, "a", to_date=dt.date(2023, 6, 1))
    merged = merge_history(incoming(spark, [("a", "0", "x")]), closed, TODAY)
    assert rows(merged, "from_date", "to_date") == [(START, dt.date(2023, 6, 1)), (TODAY, OPEN)]


def test_default_date_is_today(spark):
    merged = merge_history(incoming(spark, [("a", "0", "x")]), stored(spark, ""))
    assert merged.where(F.col("from_date") == F.current_date()).count() == 1


def test_nulls_are_values(spark):
    new = incoming(spark, [("a", None, "x")])
    old = spark.createDataFrame([("a", None, "x", START, OPEN), (None, "a", "y", START, OPEN)], STORED)
    merged = merge_history(new, old, TODAY)
    assert rows(merged, "col1", "col2", "to_date") == [("a", None, OPEN), (None, "a", TODAY)]


def test_merge_is_one_full_join(spark, tmp_path):
    stored(spark).write.parquet(str(tmp_path / "t"))
    old = spark.read.parquet(str(tmp_path / "t"))
    plan = merge_history(incoming(spark, [("a", "0", "x")]), old, TODAY)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Join") == 1 and "FullOuter" in text


def test_first_write_needs_no_join(spark, space):
    new = incoming(spark, [("a", "0", "x")])
    from layerloom.sources.readers import empty

    plan = merge_history(new, empty(spark, stored(spark).schema), TODAY)
    assert "Join" not in plan._jdf.queryExecution().optimizedPlan().toString()
    assert rows(plan) == [("a", "0", TODAY, OPEN)]


ROWS = st.lists(
    st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from(["1", "2", None])), unique=True, max_size=6
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(first=ROWS, second=ROWS)
def test_merge_properties(spark, first, second):
    schema = "col1 string, col2 string"
    one, two = spark.createDataFrame(first, schema), spark.createDataFrame(second, schema)
    nothing = spark.createDataFrame([], "col1 string, col2 string, from_date date, to_date date")
    base = spark.createDataFrame(merge_history(one, nothing, START).collect(), nothing.schema)
    merged = spark.createDataFrame(merge_history(two, base, TODAY).collect(), nothing.schema)
    current = merged.where(F.col("to_date") == F.lit(OPEN))
    assert rows(current, "col1", "col2") == rows(two)
    versions = {r[:3] for r in rows(base)}
    assert versions <= {r[:3] for r in rows(merged)}
    assert rows(merge_history(two, merged, dt.date(2024, 6, 1))) == rows(merged)


def test_row_hash_modes(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a", "b", None)], "x string, y string, z string")
    safe = [r[0] for r in df.select(row_hash(df, ["x", "y", "z"])).collect()]
    concat = [r[0] for r in df.select(row_hash(df, ["x", "y", "z"], "concat")).collect()]
    assert safe[0] != safe[1] == safe[2] and len(safe[0]) == 64
    assert concat[0] == concat[1]
    with pytest.raises(ValueError):
        row_hash(df, ["x"], "other")


def test_zero_signs_hash_alike(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,)], "x double")
    assert df.select(row_hash(df, ["x"])).distinct().count() == 1


def test_record_id(spark):
    df = stored(spark).withColumn("part", F.lit("p"))
    identified = add_record_id(df, "part")
    assert identified.columns == ["col1", "col2", "from_date", "to_date", "RecordID", "part"]
    closed = add_record_id(df.withColumn("to_date", F.lit(TODAY)), "part")
    reopened = add_record_id(df.withColumn("from_date", F.lit(TODAY)), "part")
    ids = {r.RecordID for r in identified.collect()}
    assert ids == {r.RecordID for r in closed.collect()}
    assert not ids & {r.RecordID for r in reopened.collect()}


def test_wide_rows_are_hashed_by_compiled_code(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.unset(name)
    wide = spark.range(3).select(*[(F.col("id") + i).alias(f"c{i}") for i in range(40)])
    nothing = wide.withColumns({"from_date": F.current_date(), "to_date": F.current_date()}).where("false")
    first = add_record_id(merge_history(wide, nothing, TODAY)).orderBy("c0").collect()
    assert int(spark.conf.get(name)) == 8000
    spark.conf.set(name, "65535")  # what a user set stays, and gives the same rows
    assert add_record_id(merge_history(wide, nothing, TODAY)).orderBy("c0").collect() == first
    assert spark.conf.get(name) == "65535"
    spark.conf.unset(name)


def test_first_states_are_those_merged_into_nothing(spark):
    incoming = spark.createDataFrame([("a", 1), ("b", None)], "k string, v int")
    stored = incoming.where("false").withColumns({"from_date": F.lit(None).cast("date"), "to_date": F.lit(None).cast("date")})
    day = dt.date(2024, 5, 1)
    first = first_history(incoming, day)
    merged = merge_history(incoming, stored, day)
    assert first.columns == merged.columns and rows(first) == rows(merged)
    assert "Exchange" not in first._jdf.queryExecution().executedPlan().toString()
