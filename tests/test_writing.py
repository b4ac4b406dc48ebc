import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from layerloom import TableDef
from layerloom.catalog import struct_of, with_history
from layerloom.constants import LINEAGE, LINEAGE_TYPE
from layerloom.operators import lineage, writing
from layerloom.session import cut_finely
from layerloom.sources import storage
from tests.conftest import OPEN, rows

DAY1, DAY2, DAY3 = dt.date(2024, 5, 1), dt.date(2024, 5, 2), dt.date(2024, 5, 3)
ITEM = struct_of("string code\nlong size")


def table(name, columns=ITEM, **options):
    topic, layer = name.rsplit("_", 1)
    return TableDef(name, f"{layer}_layer", layer, topic, "parquet", with_history(columns), **options)


@pytest.fixture
def items(space):
    space.catalog.register(
        table(
            "items_raw",
            quality_checks=(
                {"check": "values in range", "columns": ["size"], "range_start": 0, "range_end": 100},
            ),
        ),
        table(
            "items_datamodel",
            signalling_checks=({"check": "values are unique", "columns": ["code"]},),
        ),
        table("sizes_enriched", struct_of("long size\nlong n")),
    )
    return space


def put(space, name, data, partition=""):
    df = space.spark.createDataFrame(data, "code string, size long")
    return space.frame(name, df, partition).write()


def state(space, name):
    return rows(space.read(name, history="complete").data, "code", "size", "from_date", "to_date")


def test_history_over_three_days(items):
    put(items.on(DAY1), "items_raw", [("a", 1), ("b", 2)])
    put(items.on(DAY2), "items_raw", [("a", 1), ("b", 3)])
    expected = [("a", 1, DAY1, OPEN), ("b", 2, DAY1, DAY2), ("b", 3, DAY2, OPEN)]
    assert state(items, "items_raw") == expected
    put(items.on(DAY3), "items_raw", [("a", 1), ("b", 3)])
    assert state(items, "items_raw") == expected
    assert rows(items.read("items_raw").data, "code", "size") == [("a", 1), ("b", 3)]
    put(items.on(DAY3), "items_raw", [("b", 2)])
    assert ("b", 2, DAY3, OPEN) in state(items, "items_raw")
    ids = [r.RecordID for r in items.read("items_raw", history="complete").df.collect()]
    assert len(set(ids)) == len(ids) == 4


def test_same_day_rerun_changes_nothing(items):
    for _ in range(2):
        put(items.on(DAY1), "items_raw", [("a", 1)])
    assert state(items, "items_raw") == [("a", 1, DAY1, OPEN)]


def test_same_day_reopening_keeps_both_versions(items):
    day = items.on(DAY1)
    put(day, "items_raw", [("a", 1)])
    put(day, "items_raw", [("b", 1)])
    put(day, "items_raw", [("a", 1), ("b", 1)])
    assert state(items, "items_raw") == [("a", 1, DAY1, DAY1), ("a", 1, DAY1, OPEN), ("b", 1, DAY1, OPEN)]


def test_empty_input_closes_all(items):
    put(items.on(DAY1), "items_raw", [("a", 1)])
    put(items.on(DAY2), "items_raw", [])
    assert state(items, "items_raw") == [("a", 1, DAY1, DAY2)]


def lineage_of(space, name):
    return rows(writing.stored_edges(space, name), "source_table_name", "source_RecordID", "target_RecordID")


def test_violated_gate_leaves_everything_untouched(items):
    put(items.on(DAY1), "items_raw", [("a", 1)])
    before = state(items, "items_raw"), rows(items.read("monitoring_values", "items_raw").df)
    with pytest.raises(ValueError, match="Blocking issue violation detected: values in range"):
        put(items.on(DAY2), "items_raw", [("a", 1000)])
    assert (state(items, "items_raw"), rows(items.read("monitoring_values", "items_raw").df)) == before
    assert [p.name for p in _folder(items, "items_raw").parent.iterdir()] == ["items"]


def test_violated_gate_writes_no_edges(items):
    put(items.on(DAY1), "items_raw", [("a", 1), ("b", 200 - 190)])
    items.catalog.register(
        table("strict_datamodel", quality_checks=({"check": "values are unique", "columns": ["size"]},))
    )
    twice = items.read("items_raw").with_columns(size=F.lit(1).cast("long"))
    with pytest.raises(ValueError, match="values are unique"):
        items.frame("strict_datamodel", twice.select("code", "size")).write()
    assert lineage_of(items, "strict_datamodel") == []
    assert items.read("strict_datamodel").df.count() == 0


def _folder(space, name):
    from pathlib import Path

    return Path(space.path(space.catalog.find(name)))


def test_duplicate_rows_are_rejected(items):
    with pytest.raises(ValueError, match="Not all rows"):
        put(items.on(DAY1), "items_raw", [("a", 1), ("a", 1)])
    assert items.read("items_raw").df.count() == 0


def test_wrong_structure_is_rejected(items):
    df = items.spark.createDataFrame([(1, "a")], "size long, code string")
    with pytest.raises(ValueError, match="does not match its definition"):
        items.frame("items_raw", df).write()
    df = items.spark.createDataFrame([("a", 1)], "code string, size int")
    with pytest.raises(ValueError, match="size int"):
        items.frame("items_raw", df).write()


def test_validate_on_any_frame(items):
    stored = put(items.on(DAY1), "items_raw", [("a", 1)])
    definition = items.catalog.find("items_raw")
    writing.validate(stored.data, definition)
    with pytest.raises(ValueError):
        writing.validate(stored.data.drop("size"), definition)
    with pytest.raises(ValueError, match="Not all rows"):
        writing.validate(stored.data.union(stored.data), definition)


def test_compare_does_not_store(items):
    put(items.on(DAY1), "items_raw", [("a", 1)])
    frame = items.frame("items_raw", items.spark.createDataFrame([("b", 1)], "code string, size long"))
    compared = frame.compare(DAY2)
    assert rows(compared) == [("a", 1, DAY1, DAY2), ("b", 1, DAY2, OPEN)]
    assert state(items, "items_raw") == [("a", 1, DAY1, OPEN)]


def test_edges_trace_and_metrics(items):
    day = items.on(DAY1)
    put(day, "items_raw", [("a", 1), ("b", 1), ("c", 2)])
    day.frame("items_datamodel", day.read("items_raw")).write()
    model = day.read("items_datamodel")
    sizes = model.group_by(["size"], F.count(F.lit(1)).alias("n"))
    day.frame("sizes_enriched", sizes).write()

    raw_ids = {r.code: r.RecordID for r in day.read("items_raw").df.collect()}
    model_ids = {r.code: r.RecordID for r in model.df.collect()}
    size_ids = {r["size"]: r.RecordID for r in day.read("sizes_enriched").df.collect()}
    assert lineage_of(day, "items_datamodel") == sorted(("items_raw", raw_ids[c], model_ids[c]) for c in "abc")
    assert lineage_of(day, "sizes_enriched") == sorted(
        ("items_datamodel", model_ids[c], size_ids[s]) for c, s in (("a", 1), ("b", 1), ("c", 2))
    )
    assert "_lineage" not in day.spark.read.parquet(day.path(model.table)).columns

    starts = day.spark.createDataFrame([("sizes_enriched", size_ids[1])], "table_name string, RecordID string")
    history = writing.record_history(day, starts)
    assert rows(history, "depth", "table_name") == [
        (0, "sizes_enriched"),
        (1, "items_datamodel"),
        (1, "items_datamodel"),
        (2, "items_raw"),
        (2, "items_raw"),
    ]

    metrics = day.read("monitoring_values", "items_datamodel").df
    assert rows(metrics, "signalling_id", "check_id", "column_name", "total_count", "valid_count") == [
        (1, "dq_1", "code", 3, 3),
        (2, "dq_1", "size", 3, 3),
        (3, "dq_4", "code", 3, 3),
    ]


def test_rerun_adds_no_edges_and_new_rows_add_theirs(items):
    for day, data in ((DAY1, [("a", 1)]), (DAY1, [("a", 1)]), (DAY2, [("a", 1), ("b", 2)])):
        space = items.on(day)
        put(space, "items_raw", data)
        space.frame("items_datamodel", space.read("items_raw")).write()
    assert len(lineage_of(items, "items_datamodel")) == 2


def test_interrupted_edges_are_completed_by_a_rerun(items, monkeypatch):
    day = items.on(DAY1)
    put(day, "items_raw", [("a", 1)])

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(writing, "publish_edges", broken)
        with pytest.raises(OSError):
            day.frame("items_datamodel", day.read("items_raw")).write()
    assert lineage_of(day, "items_datamodel") == []
    day.frame("items_datamodel", day.read("items_raw")).write()
    assert len(lineage_of(day, "items_datamodel")) == 1
    assert len(state(day, "items_datamodel")) == 1


def test_metrics_keep_ids_and_history(items):
    put(items.on(DAY1), "items_raw", [("a", 1)])
    put(items.on(DAY2), "items_raw", [("a", 1), (None, 2)])
    metrics = items.read("monitoring_values", "items_raw", history="complete").df
    assert rows(metrics.where("column_name = 'code'"), "signalling_id", "total_count", "valid_count", "to_date") == [
        (1, 1, 1, DAY2),
        (1, 2, 1, OPEN),
    ]


def test_partitions_do_not_touch_each_other(items):
    items.catalog.register(table("parts_raw", partition_column="country"))
    put(items.on(DAY1), "parts_raw", [("a", 1)], "nl")
    put(items.on(DAY1), "parts_raw", [("b", 2)], "de")
    put(items.on(DAY2), "parts_raw", [("a", 5)], "nl")
    complete = items.read("parts_raw", "all", history="complete").data
    assert rows(complete, "code", "size", "to_date", "country") == [
        ("a", 1, DAY2, "nl"),
        ("a", 5, OPEN, "nl"),
        ("b", 2, OPEN, "de"),
    ]
    with pytest.raises(ValueError, match="partition"):
        put(items, "parts_raw", [("a", 1)])
    with pytest.raises(ValueError, match="One partition"):
        put(items, "parts_raw", [("a", 1)], "all")


def test_unbound_frames_cannot_be_written(items):
    from layerloom import TrackedFrame

    with pytest.raises(ValueError, match="workspace"):
        TrackedFrame(items.spark.range(1)).write()


def test_processing_date_defaults_to_today(items):
    from dataclasses import replace

    put(replace(items, processing_date=None), "items_raw", [("a", 1)])
    assert state(items, "items_raw")[0][2] == items.spark.sql("SELECT current_date()").first()[0]


def test_no_staging_folder_remains(items):
    put(items.on(DAY1), "items_raw", [("a", 1)])
    items.frame("items_datamodel", items.read("items_raw")).write()
    for name in ("items_raw", "items_datamodel", "record_tracing"):
        assert not [p for p in _folder(items, name).parent.iterdir() if p.name.startswith(".")]
    assert storage.exists(items.spark, items.path(items.catalog.find("record_tracing"), "items_datamodel"))


def test_filters_reach_the_files(items):
    day = items.on(DAY1)
    put(day, "items_raw", [("a", 1)])
    day.frame("items_datamodel", day.read("items_raw")).write()

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    narrow = plan(day.read("items_raw").select("code").df)
    assert "EqualTo(to_date,2099-12-31)" in narrow and "size" not in narrow.split("ReadSchema")[1]
    files = writing.stored_edges(day, "items_datamodel").inputFiles()
    assert files and all("target_table_name=items_datamodel" in f for f in files)


def test_edges_of_joined_rows_need_no_shuffle_and_keep_each_source_once(spark):
    rows = spark.createDataFrame(
        [("r1", DAY1, OPEN, [("a", "1"), ("b", "1"), ("a", "1")]), ("r2", DAY1, OPEN, []), ("r3", DAY1, DAY2, [("a", "2")])],
        f"RecordID string, from_date date, to_date date, `{LINEAGE}` {LINEAGE_TYPE}",
    )
    edges = lineage.open_edges(rows, lineage.Sources(), "t")
    assert "Exchange" not in edges._jdf.queryExecution().executedPlan().toString()
    found = sorted((r.source_table_name, r.source_RecordID, r.target_RecordID) for r in edges.collect())
    assert found == [("a", "1", "r1"), ("b", "1", "r1")]


def test_record_ids_are_stored_in_little_more_than_their_bytes(items):
    """Hexadecimal digits hold four bits each: rows and edges must not take eight."""
    cut_finely(items.spark)
    n, day = 4000, items.on(DAY1)
    put(day, "items_raw", [(f"c{i}", i % 100) for i in range(n)])
    day.frame("items_datamodel", day.read("items_raw")).write()
    edges = writing.stored_edges(items, "items_datamodel")
    assert edges.count() == n
    for df, ids in ((day.read("items_raw").df, 1), (edges, 2)):
        stored = sum(os.path.getsize(f.split("file://")[-1]) for f in df.inputFiles())
        assert stored < 50 * ids * n, (ids, stored, len(df.inputFiles()))
