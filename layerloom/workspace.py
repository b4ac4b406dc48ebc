"""Where tables live, which definitions are known and which day is being processed."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from layerloom.catalog import TableCatalog, TableDef
from layerloom.operators import lineage
from layerloom.operators.tracked import TrackedFrame
from layerloom.sources import readers, storage


@dataclass(frozen=True)
class Workspace:
    spark: SparkSession
    root: str
    env: str = "develop"
    catalog: TableCatalog = field(default_factory=TableCatalog.default)
    processing_date: dt.date | None = None

    def path(self, table: TableDef, partition: str = "") -> str:
        base = storage.join(self.root, self.env, table.container, table.location)
        return readers.partition_path(base, table, partition) if partition else base

    def on(self, day: dt.date) -> Workspace:
        """The same workspace processing another day."""
        return replace(self, processing_date=day)

    def today(self) -> dt.date:
        """The processing date, fixed once per write so that all its jobs agree."""
        return self.processing_date or self.spark.sql("SELECT current_date()").first()[0]

    def read(self, name: str, partition: str = "", history: str = "recent") -> TrackedFrame:
        """Open a stored table; raw and later layers start a lineage of their own rows."""
        table = self.catalog.find(name)
        df = readers.read_table(self.spark, table, self.path(table), partition, history)
        origin = lineage.Sources()
        if table.keeps_lineage:
            df = lineage.seed(df, table.source_name)
            origin = lineage.Sources(once=frozenset({table.source_name}))
        return TrackedFrame(df, table, self, partition, history, origin)

    def frame(
        self, name: str, source: DataFrame | TrackedFrame, partition: str = ""
    ) -> TrackedFrame:
        """Rows that are to become the table ``name``; a tracked source keeps its lineage."""
        table = self.catalog.find(name)
        if isinstance(source, TrackedFrame):
            return TrackedFrame(source.df, table, self, partition, origin=source.origin)
        return TrackedFrame(source, table, self, partition)
