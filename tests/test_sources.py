import datetime as dt

import pytest

from layerloom import TableDef
from layerloom.catalog import struct_of
from layerloom.constants import LINEAGE
from layerloom.functions.naming import clean_column_names, find_column
from layerloom.sources import readers, storage
from tests.conftest import OPEN, csv_table, rows


def test_read_csv(space):
    frame = space.read("test_transaction_fact_table_landingzone")
    assert frame.table.layer == "landingzone_layer"
    assert (frame.history, frame.partition, space.env) == ("recent", "", "testing")
    assert rows(frame.df) == [(1, 5, 1), (2, 10, 1), (3, 20, 2), (4, 1, 3), (5, -1, 3)]
    assert LINEAGE not in frame.df.columns


def test_default_environment(spark, tmp_path):
    from layerloom import Workspace

    assert Workspace(spark, str(tmp_path)).env == "develop"


def test_paths(space):
    table = TableDef(
        "t_raw", "raw_layer", "my_container", "my_location", "parquet", struct_of("long a"), "my_partition"
    )
    base = f"{space.root}/testing/my_container/my_location"
    assert space.path(table) == base
    assert space.path(table, "2023-01-01") == f"{base}/my_partition=2023-01-01"


def test_bad_value_in_csv_raises(space, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("a,b\n1,x\nnot a number,y\n")
    df = readers.read_csv(space.spark, str(path), struct_of("long a\nstring b"))
    with pytest.raises(Exception, match="(?i)malformed"):
        df.collect()


def test_wrong_header_raises(space, tmp_path):
    path = tmp_path / "head.csv"
    path.write_text("a,c\n1,x\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_csv(space.spark, str(path), struct_of("long a\nstring b")).collect()


@pytest.mark.parametrize(
    ("dialect", "text"),
    [
        ("csv", 'a,b\n1,"x, ""y""\nz"\n2,w\n'),
        ("csv_pipe_sep", 'a|b\n1|"x, ""y""\nz"\n2|w\n'),
        ("multiline", 'a;b\n1;~x, "y"\nz~\n2;w\n'),
    ],
)
def test_csv_dialects(space, tmp_path, dialect, text):
    path = tmp_path / "d.csv"
    path.write_text(text)
    df = readers.read_csv(space.spark, str(path), struct_of("long a\nstring b"), dialect, multiline=True)
    assert rows(df) == [(1, 'x, "y"\nz'), (2, "w")]


def test_plain_csv_splits_and_rejects_line_breaks(space, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text('a,b\n1,"x\nz"\n')
    df = readers.read_csv(space.spark, str(path), struct_of("long a\nstring b"))
    with pytest.raises(Exception, match="(?i)malformed"):
        df.collect()


def test_null_tokens_only_in_landing_text(spark, space):
    df = spark.createDataFrame([("NA", "nan", 1), ("x", "NAN", 2)], "a string, b string, c int")
    assert rows(readers.null_tokens(df)) == [("x", "NAN", 2), (None, None, 1)]
    folder = f"{space.root}/testing/landingzone"
    with open(f"{folder}/codes.csv", "w") as file:
        file.write("a,b\nNA,1\nnan,2\nok,3\n")
    space.catalog.register(csv_table("codes", "string a\nlong b"))
    assert rows(space.read("test_codes_landingzone").df) == [("ok", 3), (None, 1), (None, 2)]


def test_missing_table_is_empty_and_typed(space):
    frame = space.read("airports_raw")
    assert frame.data.schema.names == space.catalog.find("airports_raw").columns.names
    assert frame.data.count() == 0
    edges = space.read("record_tracing", partition="x").df
    assert edges.columns[-1] == "target_table_name"


def test_partitioned_table_needs_a_partition(space):
    with pytest.raises(ValueError, match="partition"):
        space.read("monitoring_values")


def test_unknown_format_and_history_raise(space):
    space.catalog.register(csv_table("odd", "long a", file_format="delta"))
    with pytest.raises(ValueError, match="Unsupported file format"):
        space.read("test_odd_landingzone")
    with pytest.raises(ValueError, match="history mode"):
        space.read("airports_raw", history="all")


def test_history_modes(spark):
    df = spark.createDataFrame([(1, OPEN), (2, dt.date(2024, 1, 1))], "a int, to_date date")
    assert rows(readers.keep_history(df, "recent"), "a") == [(1,)]
    assert rows(readers.keep_history(df, "complete"), "a") == [(1,), (2,)]


def test_partition_read(space):
    path = space.path(space.catalog.find("record_tracing"))
    data = [("s", "t", "r", "one"), ("s", "t", "r", "two")]
    columns = "source_RecordID string, source_table_name string, target_RecordID string, target_table_name string"
    df = space.spark.createDataFrame(data, columns)
    df.write.partitionBy("target_table_name").parquet(path)
    assert rows(space.read("record_tracing", "one").df) == [("s", "t", "r", "one")]
    assert space.read("record_tracing", "all").df.count() == 2
    assert space.read("record_tracing", "three").df.count() == 0


def test_clean_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["col-1", "col(2)", "col 3"])
    assert clean_column_names(df).columns == ["col_1", "col2", "col_3"]
    clash = spark.createDataFrame([(1, 2)], ["a b", "a-b"])
    with pytest.raises(ValueError, match="collide"):
        clean_column_names(clash)


def test_find_column(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["unit", "base_unit", "co2"])
    assert find_column(df, "unit") == "unit"
    assert find_column(df, "^base") == "base_unit"
    for pattern in ("missing", "t"):
        with pytest.raises(ValueError):
            find_column(df, pattern)


def test_swap_keeps_the_old_copy_until_the_new_one_is_in_place(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(3).write.parquet(path)
    staged = storage.staging_path(path)
    spark.range(5).write.parquet(staged)
    storage.swap_in(spark, staged, path)
    assert spark.read.parquet(path).count() == 5
    assert not storage.exists(spark, staged)
    assert not storage.exists(spark, storage.sibling(path, "previous"))


def test_interrupted_swap_is_recovered(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(3).write.parquet(storage.sibling(path, "previous"))
    storage.recover(spark, path)
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(Exception):
        storage.swap_in(spark, str(tmp_path / "nothing"), path)
    assert spark.read.parquet(path).count() == 3


def test_a_reader_between_two_renames_moves_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    storage.rename(spark, path, storage.sibling(path, "previous"))
    assert storage.readable(spark, path) == storage.sibling(path, "previous")
    assert not storage.exists(spark, path)
    spark.range(5).write.parquet(str(tmp_path / "new"))
    storage.rename(spark, str(tmp_path / "new"), path)
    assert spark.read.parquet(storage.readable(spark, path)).count() == 5


def test_a_rename_onto_a_folder_is_refused(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "a"))
    spark.range(1).write.parquet(str(tmp_path / "b"))
    with pytest.raises(OSError, match="exists"):
        storage.rename(spark, str(tmp_path / "a"), str(tmp_path / "b"))
    assert storage.exists(spark, str(tmp_path / "a"))
