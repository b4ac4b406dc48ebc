import pytest
from pyspark.sql import functions as F

from layerloom.operators import quality
from tests.conftest import OPEN, rows

METRICS = ["check_id", "column_name", "check_name", "total_count", "valid_count"]
GROUPS = [("a",), ("a",), ("b",), ("b",), ("b",)]


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def counts(df, check):
    return tuple(quality.measure(df, check).first())


def test_within_list(spark):
    df = frame(spark, [(c,) for c in "abcde"], "col1 string")
    check = {"check": "values within list", "columns": ["col1"], "value_list": ["a", "b", "c"]}
    assert counts(df, check) == (5, 3)
    assert counts(df, {**check, "check": "values in list"}) == (5, 3)


def test_filled(spark):
    data = [("a", 1, 1.0), ("b", 2, float("nan")), (None, 3, None), ("NA", None, 2.0), ("nan", 5, 3.0)]
    df = frame(spark, data, "col1 string, col2 long, col3 double")
    result = quality.filled_values(df.withColumn("RecordID", F.lit("x")))
    text = "Check if values are filled"
    assert rows(result, *METRICS) == [
        ("dq_1", "col1", text, 5, 2),
        ("dq_1", "col2", text, 5, 4),
        ("dq_1", "col3", text, 5, 3),
    ]
    assert result.columns == list(quality.METRIC_COLUMNS)
    assert result.where("signalling_id IS NOT NULL").count() == 0


def test_in_range(spark):
    df = frame(spark, [(i,) for i in (1, 2, 3, 4, 5, None)], "col1 int")
    check = {"check": "values in range", "columns": ["col1"], "range_start": 2, "range_end": 4}
    assert counts(df, check) == (6, 3)


def test_unique(spark):
    df = frame(spark, [(i,) for i in (1, 2, 2, 4, 5)], "col1 int")
    assert counts(df, {"check": "values are unique", "columns": ["col1"]}) == (5, 4)
    pairs = frame(spark, [(1, None), (1, None), (1, 2)], "a int, b int")
    assert counts(pairs, {"check": "values are unique", "columns": ["a", "b"]}) == (3, 2)


def test_format(spark):
    df = frame(spark, [(c,) for c in ("abc", "def", "ghi", "123", "456")], "col1 string")
    check = {"check": "values have format", "columns": ["col1"], "format": r"^[a-z]+$"}
    assert counts(df, check) == (5, 3)


@pytest.mark.parametrize(
    ("text", "pattern", "found"),
    [
        ("é23", r"^[\w]{3}$", True),
        ("abc\n", r"^[\w]{3}$", False),
        ("xxA1xx", r"[A-Z0-9]{2}", True),
        ("a$", r"^a\$", True),
        ("a$", r"\$$", True),
    ],
)
def test_format_is_a_unicode_search(spark, text, pattern, found):
    df = frame(spark, [(text,)], "col1 string")
    assert df.select(quality.has_format(F.col("col1"), pattern)).first()[0] is found


def test_consistent(spark):
    df = frame(spark, [(i, c) for i, c in enumerate("abcde")], "col1 long, join_col string")
    check = {"check": "values are consistent", "columns": ["col1"], "compare_table": df, "join_columns": ["join_col"]}
    assert counts(df, check) == (5, 5)


def test_consistent_multiplies_repeated_keys_and_skips_nulls(spark):
    left = frame(spark, [(1, "a"), (1, "a"), (2, "a"), (None, "b"), (3, None)], "v int, k string")
    right = frame(spark, [(1, "a"), (1, "a"), (1, "a"), (None, "b"), (3, None)], "v int, k string")
    assert tuple(quality.consistent_rows(left, "v", right, ["k"]).first()) == (5, 6)


def test_expected_count(spark):
    df = frame(spark, [(k, i) for i, (k,) in enumerate(GROUPS)], "col1 string, RecordID int")
    check = {"check": "values occur as expected", "columns": ["col1"], "expected_count": 2}
    assert counts(df, check) == (5, 2)
    nulls = frame(spark, [(None, 1), (None, 2), ("a", 1), ("a", None)], "col1 string, RecordID int")
    assert counts(nulls, check) == (4, 0)


def test_distinct_count(spark):
    check = {
        "check": "distinct values occur as expected",
        "columns": ["col1"],
        "expected_count": 2,
        "distinct_columns": ["col2"],
    }
    for values in ((1, 2, 3, 4, 5), (1, 2, 3, None, 5)):
        data = [(k, v) for (k,), v in zip(GROUPS, values)]
        assert counts(frame(spark, data, "col1 string, col2 int"), check) == (5, 2)
    tuples = frame(spark, [("a", 1, 1), ("a", 1, 2), ("b", 1, 1), ("b", 1, 1)], "col1 string, col2 int, col3 int")
    assert counts(tuples, {**check, "distinct_columns": ["col2", "col3"]}) == (4, 2)


def test_sums(spark):
    data = [(k, v) for (k,), v in zip(GROUPS, (0.5, 0.5, 0.3, 0.3, 0.4))]
    check = {"check": "values sum to 1", "columns": ["col1"], "sum_column": "value"}
    assert counts(frame(spark, data, "col1 string, value double"), check) == (5, 5)
    assert counts(frame(spark, [("a", None), (None, 1.0)], "col1 string, value double"), check) == (2, 0)


TRACE = [
    ("table1", "a", "target_table", 1),
    ("table1", "b", "target_table", 1),
    ("table2", "d", "target_table", 2),
    ("table2", "e", "target_table", 2),
    ("table2", "f", "target_table", 2),
    ("table3", "g", "target_table", 1),
]
TRACE_SCHEMA = "source_table_name string, source_RecordID string, target_table_name string, target_RecordID long"


def history(spark, template, **options):
    df = frame(spark, [(i,) for i in range(1, 6)], "RecordID long")
    trace = frame(spark, TRACE, TRACE_SCHEMA)
    return tuple(quality.expected_history(df, trace, template, **options).first())


def test_expected_history(spark):
    per_record = [
        {"target_RecordID": 1, "source_table_name": "table1", "amount_records": 2},
        {"target_RecordID": 2, "source_table_name": "table2", "amount_records": 3},
        {"target_RecordID": 1, "source_table_name": "table3", "amount_records": 1},
    ]
    assert history(spark, per_record) == (5, 5)
    assert history(spark, per_record[1:]) == (5, 4)


def test_expected_history_for_all_records(spark):
    template = {"source_table_name": ["table1", "table3"], "amount_records": [2, 1]}
    assert history(spark, template) == (5, 4)
    assert history(spark, template, strict=True) == (5, 1)
    with pytest.raises(ValueError):
        history(spark, [{"target_RecordID": 1, "source_table_name": "t", "amount_records": 1}], strict=True)


GATES = {
    "values in range": ({"range_start": 1, "range_end": 5}, [1, 2, 3, 4, 5], [1, 2, 3, 4, 6]),
    "values are unique": ({}, [1, 2, 3, 4, 5], [1, 2, 2, 4, 5]),
    "values have format": ({"format": r"^[a-z]+$"}, ["abc", "def"], ["abc", "123"]),
}


@pytest.mark.parametrize("name", GATES)
def test_blocking(spark, name):
    options, good, bad = GATES[name]
    check = {"check": name, "columns": ["col1"], **options}
    kind = "string" if isinstance(good[0], str) else "int"

    def with_dates(values):
        return frame(spark, [(v, OPEN) for v in values], f"col1 {kind}, to_date date")

    quality.check_blocking(with_dates(good), [check])
    with pytest.raises(ValueError, match=f"Blocking issue violation detected: {name}"):
        quality.check_blocking(with_dates(bad), [check])
    closed = with_dates(bad).withColumn("to_date", F.lit("2024-01-01").cast("date"))
    quality.check_blocking(closed, [check])


def test_blocking_reports_the_first_violation(spark):
    df = frame(spark, [(9, OPEN), (9, OPEN)], "col1 int, to_date date")
    unique = {"check": "values are unique", "columns": ["col1"]}
    in_range = {"check": "values in range", "columns": ["col1"], "range_start": 1, "range_end": 5}
    with pytest.raises(ValueError, match="values are unique"):
        quality.check_blocking(df, [unique, in_range])
    with pytest.raises(ValueError, match="values in range"):
        quality.check_blocking(df, [in_range, unique])
    with pytest.raises(ValueError, match="Not a blocking check"):
        quality.check_blocking(df, [{"check": "values sum to 1", "columns": ["col1"]}])


FILLED = "Check if values are filled"
SIGNALS = [
    (
        {"check": "values within list", "columns": ["col1"], "value_list": ["a", "b", "c"]},
        ("dq_2", "col1", 'values within list of: "a","b","c"', 5, 5),
    ),
    (
        {"check": "values in range", "columns": ["col3"], "range_start": 2, "range_end": 4},
        ("dq_3", "col3", "values between 2 and 4", 5, 3),
    ),
    (
        {"check": "values are unique", "columns": ["col1", "col2"]},
        ("dq_4", "col1,col2", "unique values in column `col1,col2`", 5, 5),
    ),
    (
        {"check": "values have format", "columns": ["col1"], "format": r"^[a-z]+$"},
        ("dq_5", "col1", "values have format ^[a-z]+$", 5, 5),
    ),
    (
        {"check": "values occur as expected", "columns": ["col1"], "expected_count": 2},
        ("dq_7", "col1", "values occur 2 times", 5, 2),
    ),
    (
        {"check": "values sum to 1", "columns": ["col1"], "sum_column": "value"},
        ("dq_8", "col1", 'values in column "value" sum to 1', 5, 5),
    ),
    (
        {
            "check": "distinct values occur as expected",
            "columns": ["col1"],
            "expected_count": 2,
            "distinct_columns": ["col2"],
        },
        ("dq_9", "col1", "2 distinct values occur in column col2", 5, 2),
    ),
]


def signal_frame(spark):
    data = [
        (k, c, i, v, str(i))
        for (k,), c, i, v in zip(GROUPS, (1, 2, 3, None, 5), range(1, 6), (0.5, 0.5, 0.3, 0.3, 0.4))
    ]
    return frame(spark, data, "col1 string, col2 int, col3 int, value double, RecordID string")


@pytest.mark.parametrize(("check", "expected"), SIGNALS, ids=[e[0] for _, e in SIGNALS])
def test_signalling(spark, check, expected):
    result = quality.signalling_metrics(signal_frame(spark), [check])
    filled = [("dq_1", c, FILLED, 5, 4 if c == "col2" else 5) for c in ("col1", "col2", "col3", "value")]
    assert rows(result, *METRICS) == sorted([*filled, expected])


def test_all_signals_together_and_unknown_check(spark):
    result = quality.signalling_metrics(signal_frame(spark), [c for c, _ in SIGNALS])
    assert {e for _, e in SIGNALS} <= set(rows(result, *METRICS))
    with pytest.raises(ValueError, match="Unknown check"):
        quality.signalling_metrics(signal_frame(spark), [{"check": "values rhyme", "columns": ["col1"]}])


def test_row_checks_share_one_scan(spark, tmp_path):
    signal_frame(spark).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    checks = [c for c, _ in SIGNALS if c["check"] in quality.ROW_CHECKS]
    plan = quality.signalling_metrics(df, checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_list_texts_are_whole():
    check = {"check": "values within list", "columns": ["c"], "value_list": ["x" * 60, "y" * 60]}
    assert quality.describe(check) == f'values within list of: "{"x" * 60}","{"y" * 60}"'


def test_checks_with_one_text_get_labels_of_their_own():
    same = {"check": "values are consistent", "columns": ["c"], "join_columns": ["k"]}
    first, second = quality.labels([same | {"compare_table": "a"}, same | {"compare_table": "b"}])
    assert first == quality.describe(same)
    assert second.startswith(f"{first} [") and second != first
    with pytest.raises(ValueError, match="twice"):
        quality.labels([same, same, same])


STORED = "signalling_id long, check_id string, column_name string, check_name string, total_count long, valid_count long, table_name string"


@pytest.mark.parametrize(("second", "expected"), [("col2", [1, 2]), ("col3", [1, 3])])
def test_metric_ids(spark, second, expected):
    def metric(number, column):
        return (number, "dq_1", column, FILLED, 5, 4, "some_table")

    known = frame(spark, [metric(1, "col1"), metric(2, "col2"), metric(2, "col2")], STORED)
    new = frame(spark, [metric(None, "col1"), metric(None, second)], STORED)
    result = quality.assign_signalling_ids(new, known)
    assert rows(result, "column_name", "signalling_id") == list(zip(("col1", second), expected))
    assert result.columns == [*quality.METRIC_COLUMNS, "table_name"]


def test_first_metric_ids(spark):
    none = frame(spark, [], STORED)
    new = frame(
        spark,
        [(None, "dq_2", "a", "x", 1, 1, "t"), (None, "dq_1", "b", "x", 1, 1, "t"), (None, "dq_1", "a", "x", 1, 1, "t")],
        STORED,
    )
    result = quality.assign_signalling_ids(new, none)
    assert rows(result, "signalling_id", "check_id", "column_name") == [
        (1, "dq_1", "a"),
        (2, "dq_1", "b"),
        (3, "dq_2", "a"),
    ]
