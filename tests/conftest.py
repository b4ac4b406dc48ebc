from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from layerloom import TableCatalog, TableDef, Workspace  # noqa: E402
from layerloom.catalog import struct_of  # noqa: E402

OPEN = dt.date(2099, 12, 31)


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


def csv_table(topic: str, columns: str, **options) -> TableDef:
    return TableDef(
        f"test_{topic}_landingzone",
        "landingzone_layer",
        "landingzone",
        f"{topic}.csv",
        options.pop("file_format", "csv"),
        struct_of(columns),
        **options,
    )


@pytest.fixture
def catalog() -> TableCatalog:
    return TableCatalog.default().register(
        csv_table("product_dimension_table", "long pk_column\nstring value_string\nlong value_int"),
        csv_table("transaction_fact_table", "long transaction_id amount product_fk"),
    )


@pytest.fixture
def space(spark, catalog, tmp_path) -> Workspace:
    landing = tmp_path / "testing" / "landingzone"
    landing.mkdir(parents=True)
    (landing / "product_dimension_table.csv").write_text(
        "pk_column,value_string,value_int\n1,test_1,1\n2,test_2,1\n3,test_3,100\n"
    )
    (landing / "transaction_fact_table.csv").write_text(
        "transaction_id,amount,product_fk\n1,5,1\n2,10,1\n3,20,2\n4,1,3\n5,-1,3\n"
    )
    return Workspace(
        spark, str(tmp_path), env="testing", catalog=catalog, processing_date=dt.date(2024, 5, 1)
    )


def rows(df, *columns: str) -> list[tuple]:
    """Rows as sorted tuples."""
    selected = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in selected.collect()), key=lambda r: [(v is None, v) for v in r])
