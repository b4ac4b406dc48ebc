"""How often things are read, shuffled and written."""

from __future__ import annotations

import datetime as dt
import re
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from layerloom import TableDef, TrackedFrame
from layerloom.catalog import struct_of, with_history
from layerloom.functions.hashing import row_hash
from layerloom.operators import lineage, quality, ranking, writing
from layerloom.operators.history import merge_history
from layerloom.session import PIECES, SHUFFLE_PIECES, SHUFFLE_TASK_SIZE, TASK_SIZE
from layerloom.sources import storage
from tests.conftest import rows

DAY1, DAY2 = dt.date(2024, 5, 1), dt.date(2024, 5, 2)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def sales(spark, tmp_path):
    """Sales joined with products, both read from files."""
    data = [(f"s{i}", i % 5, i % 3, i) for i in range(60)]
    spark.createDataFrame(data, "RecordID string, p int, c int, n int").write.parquet(str(tmp_path / "sales"))
    products = [(f"p{i}", i, f"kind {i % 2}") for i in range(5)]
    spark.createDataFrame(products, "RecordID string, p int, kind string").write.parquet(str(tmp_path / "products"))
    read = lambda name: TrackedFrame(lineage.seed(spark.read.parquet(str(tmp_path / name)), f"{name}_raw"))
    return read("sales").drop("RecordID").join(read("products").drop("RecordID"), on="p", how="inner")


def test_sources_of_groups_need_neither_groups_nor_links(sales):
    grouped = sales.group_by(["kind", "c"], F.sum("n").alias("n"))
    found = grouped.sources("kind", "c")
    assert plan(found).count("FileScan") == 2
    assert "sum(" not in plan(found) and "(group)" not in plan(found)
    expected = {(f"kind {i % 5 % 2}", i % 3, "sales_raw", f"s{i}") for i in range(60)}
    expected |= {(f"kind {p % 2}", c, "products_raw", f"p{p}") for p in range(5) for c in range(3)}
    assert set(map(tuple, found.collect())) == expected
    renamed = grouped.rename({"kind": "k", "c": "kind"}).select("k", "kind", "n")
    assert {(k, c, *rest) for k, c, *rest in map(tuple, renamed.sources("k", "kind").collect())} == expected
    some = grouped.where("c = 1")
    assert {tuple(r) for r in some.sources("kind", "c").collect()} == {e for e in expected if e[1] == 1}


def test_keys_that_do_not_decide_the_sources_are_spread(sales, spark):
    repeated = sales.data.withColumn("which", F.explode(F.array(F.lit("a"), F.lit("b"))))
    grouped = TrackedFrame(repeated).group_by(
        ["kind", "which"], F.count(F.lit(1)).alias("n"), members=sales, each={"which": ["a", "b"]}
    )
    assert "Aggregate" in plan(grouped.data)
    found = {tuple(r) for r in grouped.sources("kind", "which").collect()}
    once = {tuple(r) for r in sales.group_by(["kind"]).sources("kind").collect()}
    assert found == {(k, w, *rest) for k, *rest in once for w in "ab"}
    linked = grouped.with_columns(RecordID=F.concat_ws("-", "kind", "which")).sources()
    assert {tuple(r) for r in linked.collect()} == {(f"{k}-{w}", *rest) for k, w, *rest in found}


def test_aggregates_and_members_share_one_evaluation(sales, spark):
    grouped = sales.group_by(["kind"], F.sum("n").alias("n"))
    again = grouped.with_columns(one=F.lit(1)).group_by(["one"], F.sum("n").alias("n"))
    with lineage.held(origin=again.origin):
        for df in (grouped.data, grouped.sources("kind"), again.data, again.sources("one")):
            assert "FileScan" not in plan(df).split("InMemoryRelation")[0]
        inside = rows(again.sources("one"))
    assert "InMemoryTableScan" not in plan(grouped.data)
    assert inside == rows(again.sources("one")) and len(inside) == 65


def test_unions_of_unions_are_one_distinct(sales):
    left = sales.select("c")
    both = left.union(sales.where("n > 5").select("c")).union(left)
    assert plan(both.data).count("HashAggregate") == 2  # a partial and a final one
    assert rows(both.data) == [(0,), (1,), (2,)]
    assert both.sources("c").count() == left.distinct().sources("c").count() == 75


def test_record_ids_of_any_form_survive(spark):
    ids = ["a" * 64, "A" * 64, "f" * 63, "", "é", "\x01" + "a" * 32, "0123456789abcdef" * 4]
    frame = TrackedFrame(lineage.seed(spark.createDataFrame([(i,) for i in ids], "RecordID string"), "t"))
    assert sorted(r.source_RecordID for r in frame.sources().collect()) == sorted(ids)


def test_lineage_maps_are_read(spark):
    data = [(1, {"a": ["1", "2", "2", None], "b": ["1"]}), (2, {"a": None}), (3, None), (4, {})]
    frame = TrackedFrame.from_lineage_map(spark.createDataFrame(data, "k int, m map<string,array<string>>"), "m")
    assert frame.values == ["k"]
    assert {tuple(r) for r in frame.sources("k").collect()} == {(1, "a", "1"), (1, "a", "2"), (1, "b", "1")}


def test_order_and_head_keep_lineage(sales):
    grouped = sales.group_by(["c"], F.sum("n").alias("n"))
    assert [r.c for r in grouped.order_by(F.desc("c")).data.collect()] == [2, 1, 0]
    top = grouped.head(1, F.desc("n"))
    assert rows(top.data) == [(2, sum(range(2, 60, 3)))]
    assert {r.source_RecordID for r in top.sources("c").where("source_table_name = 'sales_raw'").collect()} == {
        f"s{i}" for i in range(2, 60, 3)
    }
    with pytest.raises(ValueError, match="order"):
        grouped.head(3)


# -- ranks ----------------------------------------------------------------------------------------


def test_ranks_of_one_frequent_value_in_many_ranges(spark):
    data = [(i % 2, 7.0 if i % 10 else float(i % 90)) for i in range(3000)] + [(None, None), (0, None), (1, float("nan"))]
    df = spark.createDataFrame(data, "g int, v double").repartition(6)
    window = Window.partitionBy("g")
    expected = df.select(
        "g", "v", F.dense_rank().over(window.orderBy("v")).cast("bigint").alias("r"), F.count(F.lit(1)).over(window).alias("m")
    )
    ranked = ranking.with_dense_rank(df, ["g"], "v", 9)
    found = ranked.select("g", "v", F.col("dense_rank").alias("r"), F.col("row_count").alias("m"))
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()
    assert rows(ranked.groupBy("g").agg(F.max("dense_rank"), F.max("distinct_count"), F.min("distinct_count"))) == [
        (0, 11, 11, 11), (1, 2, 2, 2), (None, 1, 1, 1),
    ]


def test_ranking_shuffles_rows_once_and_reads_nothing_ahead(spark, tmp_path):
    spark.range(500).selectExpr("id % 3 AS g", "id AS v").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    spark.sparkContext.setJobGroup("ranks", "planning")
    ranked = ranking.with_dense_rank(df, [], "v")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("ranks") == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(ranked)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert "ReusedExchange" in text and "SortMergeJoin" not in text and text.count("FileScan") == 1
    assert rows(ranked, "v", "dense_rank") == [(i, i + 1) for i in range(500)]


def test_null_groups_are_told_apart_by_their_place(spark):
    df = spark.createDataFrame([(None, "a", 1), ("a", None, 1), (None, None, 1), ("a", "a", 1)], "x string, y string, v int")
    ranked = ranking.with_dense_rank(df, ["x", "y"], "v", 1)
    assert rows(ranked, "dense_rank", "distinct_count", "row_count") == [(1, 1, 1)] * 4


@pytest.mark.parametrize("batch", ["3", "10000"])
def test_ranks_in_several_groupings_from_one_shuffle(spark, batch):
    data = [(i, i % 2, str(i % 7), 7.0 if i % 3 else float(i % 50)) for i in range(600)]
    data += [(600, None, None, None), (601, 0, "1", None), (602, 1, None, float("nan")), (603, 1, "1", -0.0), (604, 1, "1", 0.0)]
    df = spark.createDataFrame(data, "id int, g int, h string, v double").repartition(6)
    sets = [[], ["g"], ["h"], ["g", "h"]]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        found = ranking.per_set(*ranking.range_ranks(df, sets, "v", 9), sets)
        found = found.select("id", "_set", "dense_rank", "distinct_count", "row_count")
        text = plan(found)
        found = found.localCheckpoint()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    by = F.col("_set")
    for i, columns in enumerate(sets):
        window = Window.partitionBy(*columns)
        ranked = df.withColumn("r", F.dense_rank().over(window.orderBy("v")).cast("bigint"))
        expected = ranked.select(
            "id", F.lit(i).cast("tinyint"), "r", F.max("r").over(window), F.count(F.lit(1)).over(window)
        )
        own = found.where(by == i)
        assert own.count() == 605 and own.exceptAll(expected).isEmpty()
    # Rows are repeated per grouping only after their shuffle.
    assert "rangepartitioning" in text and "Generate" not in text.split("rangepartitioning")[-1]
    none = df.where("id < 0")
    assert ranking.per_set(*ranking.range_ranks(none, sets, "v", 9), sets).count() == 0


# -- writing --------------------------------------------------------------------------------------


@pytest.fixture
def items(space):
    columns = with_history(struct_of("string code\nlong size"))
    gate = {"check": "values in range", "columns": ["size"], "range_start": 0, "range_end": 100}
    unique = {"check": "values are unique", "columns": ["code"]}
    for name, checks, order in (("items_raw", (gate,), ()), ("items_datamodel", (), ()), ("both_raw", (unique, gate), ()), ("sorted_raw", (), ("size",))):
        topic, layer = name.split("_")
        space.catalog.register(
            TableDef(name, f"{layer}_layer", layer, topic, "parquet", columns, "", checks, sorted_by=order)
        )
    return space


def put(space, name, data):
    return space.frame(name, space.spark.createDataFrame(data, "code string, size long")).write()


def test_row_gates_and_fill_grades_are_counted_by_the_write(items, monkeypatch):
    def unread(*_):
        raise AssertionError("the rows were read again")

    monkeypatch.setattr(quality, "blocking_counts", unread)
    monkeypatch.setattr(quality, "_row_metrics", unread)
    monkeypatch.setattr(writing, "check_distinct_rows", unread)
    with pytest.raises(ValueError, match="values in range"):
        put(items.on(DAY1), "items_raw", [("a", 1), ("b", None)])
    put(items.on(DAY1), "items_raw", [("a", 1), (None, 2), ("NA", 3)])
    metrics = items.read("monitoring_values", "items_raw").df
    assert rows(metrics, "column_name", "total_count", "valid_count") == [("code", 3, 1), ("size", 3, 3)]


def test_the_first_violated_gate_is_named(items):
    with pytest.raises(ValueError, match="values are unique"):
        put(items.on(DAY1), "both_raw", [("a", 1), ("a", 1000)])
    with pytest.raises(ValueError, match="values in range"):
        put(items.on(DAY1), "both_raw", [("a", 1), ("b", 1000)])


def test_rows_are_written_once(items, monkeypatch):
    put(items.on(DAY1), "items_raw", [("a", 1), ("b", 2)])
    staged = []
    stage = writing._stage
    monkeypatch.setattr(writing, "_stage", lambda df, path: (staged.append(path), stage(df, path)))
    monkeypatch.setattr(writing, "publish_metrics", lambda *_: None)
    items.on(DAY1).frame("items_datamodel", items.read("items_raw")).write()
    assert len(staged) == 1
    folder = Path(items.path(items.catalog.find("items_datamodel")))
    assert not (folder / "_edges").exists()
    assert "_lineage" not in items.spark.read.parquet(str(folder)).columns


def test_edges_are_compared_with_those_of_the_days_of_their_targets(items, monkeypatch):
    read = []
    stored = writing.stored_edges

    def watched(space, target, days=None):
        edges = stored(space, target, days)
        if days is not None and target == "items_datamodel":
            pruned = re.findall(r"PartitionFilters: \[[^\]]*target_from", plan(edges))
            read.append((sorted(days), edges.count(), len(pruned)))
        return edges

    monkeypatch.setattr(writing, "stored_edges", watched)
    for day, data in ((DAY1, [("a", 1)]), (DAY2, [("b", 1)]), (DAY2, [("b", 1), ("c", 1)])):
        put(items.on(day), "items_raw", data)
        items.on(day).frame("items_datamodel", items.on(day).read("items_raw")).write()
    # The first write finds no edge table; later ones read the folder of the day alone.
    assert read == [([DAY1], 0, 0), ([DAY2], 0, 1), ([DAY2], 1, 1)]
    assert stored(items, "items_datamodel").count() == 3


def test_an_edge_move_that_was_cut_off_goes_on(items, monkeypatch):
    day = items.on(DAY1)
    put(day, "items_raw", [(c, 1) for c in "abcdef"])
    moved, rename = [], storage.rename

    def once(spark, source, target):
        if "target_from" in source:
            if moved:
                raise OSError("lost")
            moved.append(source)
        rename(spark, source, target)

    frame = day.frame("items_datamodel", day.read("items_raw"))
    items.spark.conf.set("spark.sql.adaptive.enabled", "false")  # several files of edges
    try:
        with monkeypatch.context() as patch:
            patch.setattr(storage, "rename", once)
            with pytest.raises(OSError):
                frame.write()
    finally:
        items.spark.conf.unset("spark.sql.adaptive.enabled")
    assert 0 < writing.stored_edges(day, "items_datamodel").count() < 6
    frame.write()
    assert writing.stored_edges(day, "items_datamodel").count() == 6


def test_sorted_tables_have_files_of_different_ranges(items):
    put(items.on(DAY1), "sorted_raw", [(str(i), i * 7919 % 1000) for i in range(1000)])
    folder = Path(items.path(items.catalog.find("sorted_raw")))
    limits = []
    for file in folder.glob("*.parquet"):
        metadata = pq.ParquetFile(file).metadata
        at = metadata.schema.to_arrow_schema().names.index("size")
        if metadata.num_row_groups:
            statistics = metadata.row_group(0).column(at).statistics
            limits.append((statistics.min, statistics.max))
    limits.sort()
    assert all(a[1] < b[0] for a, b in zip(limits, limits[1:], strict=False))
    assert items.read("sorted_raw").df.count() == 1000


def test_a_merge_sorts_nothing_ahead_of_its_shuffle(spark):
    incoming = spark.createDataFrame([("a", 1), ("b", 2)], "code string, size long")
    stored = spark.createDataFrame([("a", 1, DAY1, dt.date(2099, 12, 31))], "code string, size long, from_date date, to_date date")
    text = plan(merge_history(incoming, stored, DAY2))
    assert "SortAggregate" not in text
    assert rows(merge_history(incoming, stored, DAY2), "code", "from_date") == [("a", DAY1), ("b", DAY2)]


def test_nested_values_hash_by_their_content(spark):
    def hashed(value: str) -> str:
        df = spark.sql(f"SELECT {value} AS v")
        return df.select(row_hash(df, ["v"])).first()[0]

    different = [
        "array('a, b')", "array('a', 'b')", "array('ab', '')", "array('a', 'b', null)", "array()", "cast(null AS array<string>)",
    ]
    assert len({hashed(v) for v in different}) == len(different)
    assert hashed("map('x', 1, 'y', 2)") == hashed("map('y', 2, 'x', 1)") != hashed("map('x', 2, 'y', 1)")
    assert hashed("struct('a' AS x, null AS y)") != hashed("struct(null AS x, 'a' AS y)")
    assert hashed("struct(null AS x)") != hashed("cast(null AS struct<x: string>)")
    assert hashed("array(-0.0D)") == hashed("array(0.0D)")
    assert hashed("X'0102'") != hashed("X'0103'")


# -- traces ---------------------------------------------------------------------------------------


EDGE = "source_table_name string, source_RecordID string, target_table_name string, target_RecordID string"


@pytest.mark.parametrize("per_start", [False, True])
def test_jumps_find_what_steps_find(spark, monkeypatch, per_start):
    # Ways of several lengths between the same records, and tables that nothing leads to.
    pairs = {(i * 7 % 5 + j, i + j) for i in range(3, 30) for j in range(2) if i * 7 % 5 + j < i + j}
    data = [(f"t{a % 3}", str(a), f"t{b % 3}", str(b)) for a, b in sorted(pairs)] + [("x", "1", "y", "2")]
    edges = spark.createDataFrame(data, EDGE)
    starts = spark.createDataFrame([("t1", "28"), ("t2", "29"), ("t0", "0")], "table_name string, RecordID string")
    monkeypatch.setattr(lineage, "PLAIN_STEPS", 1000)
    expected = rows(lineage.trace(edges, starts, per_start))
    monkeypatch.setattr(lineage, "PLAIN_STEPS", 1)
    assert rows(lineage.trace(edges, starts, per_start)) == expected
    assert len({r.depth for r in lineage.trace(edges, starts).select("depth").collect()}) > 2


def test_a_chain_of_a_thousand_steps_takes_few_rounds(spark, monkeypatch):
    chain = [("a", str(i), "a", str(i + 1)) for i in range(1000)]
    edges = spark.createDataFrame(chain, EDGE)
    starts = spark.createDataFrame([("a", "1000")], "table_name string, RecordID string")
    deleted, delete = [], storage.delete
    monkeypatch.setattr(storage, "delete", lambda spark, path: (deleted.append(path), delete(spark, path)))
    found = lineage.trace(edges, starts)
    assert rows(found, "depth", "RecordID") == [(i, str(1000 - i)) for i in range(1001)]
    assert len(deleted) == 11 and not any(storage.exists(spark, path) for path in deleted)
    loop = edges.unionByName(spark.createDataFrame([("a", "1000", "a", "0")], EDGE))
    with pytest.raises(ValueError, match="cycle"):
        lineage.trace(loop, starts)


@pytest.fixture
def own_number(spark):
    """The session as it is before anything cut its shuffles, with few shuffle partitions."""
    before = spark.conf.get(PIECES, None)
    spark.conf.unset(PIECES)
    yield spark
    spark.conf.set(PIECES, before) if before else spark.conf.unset(PIECES)


def _cuts(df, capsys) -> set[int]:
    df.explain()
    return {int(n) for n in re.findall(r"hashpartitioning\(.*?, (\d+)\)", capsys.readouterr().out)}


def test_edges_of_groups_are_shuffled_in_small_pieces(sales, own_number, capsys):
    grouped = sales.group_by(["kind"], F.count(F.lit(1)).alias("rows"))
    assert _cuts(grouped.sources("kind"), capsys) == {SHUFFLE_PIECES}
    own_number.conf.set(PIECES, "7")
    assert _cuts(sales.group_by(["kind"], F.max("n")).sources("kind"), capsys) == {7}


def test_steps_of_a_trace_are_shuffled_in_small_pieces(own_number):
    edges = own_number.createDataFrame(
        [("s1", "a", "t1", "b"), ("s1", "a", "t1", "b"), ("s2", "a", "t1", "b")], list(lineage.EDGE_COLUMNS)
    )
    starts = own_number.createDataFrame([("b", "t1"), ("b", "t1")], "table_name string, RecordID string")
    assert lineage.trace(edges, starts).count() == 3
    assert own_number.conf.get(PIECES) == str(SHUFFLE_PIECES)


def test_sources_of_the_history_check_are_counted_in_small_pieces(own_number, capsys):
    trace = own_number.createDataFrame([("t1", "a", "s1")], "target_RecordID string, source_table_name string, source_RecordID string")
    records = own_number.createDataFrame([("t1",)], "RecordID string")
    found = quality.expected_history(records, trace, [{"source_table_name": "a", "amount_records": 1}])
    assert found.first().valid_count == 1
    assert own_number.conf.get(PIECES) == str(SHUFFLE_PIECES)


def test_tasks_of_groupings_read_little_of_a_shuffle(sales, own_number):
    before = own_number.conf.getAll.get(TASK_SIZE)
    try:
        own_number.conf.unset(TASK_SIZE)
        grouped = sales.group_by(["kind"], F.max("n"))
        assert own_number.conf.get(TASK_SIZE) == SHUFFLE_TASK_SIZE
        own_number.conf.set(TASK_SIZE, "5MB")
        assert grouped.average(["kind"], "max(n)").df.count() == 2
        assert own_number.conf.get(TASK_SIZE) == "5MB"
    finally:
        own_number.conf.set(TASK_SIZE, before) if before else own_number.conf.unset(TASK_SIZE)
