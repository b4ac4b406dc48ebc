"""Table definitions and the registry that looks them up by layer and name."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import types as T

from layerloom.constants import LAYERS


@dataclass(frozen=True)
class TableDef:
    """Declared shape, place and gates of one table."""

    name: str
    layer: str
    container: str
    location: str
    file_format: str
    columns: T.StructType
    partition_column: str = ""
    quality_checks: tuple[dict, ...] = ()
    signalling_checks: tuple[dict, ...] = ()
    # Quoted line breaks need whole-file tasks. None: only the dialect made for them has any.
    multiline: bool | None = None
    # Rows are stored in ranges of these columns, so that filters on them skip files by their statistics.
    sorted_by: tuple[str, ...] = ()

    @property
    def source_name(self) -> str:
        """Name under which rows of this table appear in lineage."""
        return f"{self.location}_{self.container}"

    @property
    def stored_columns(self) -> T.StructType:
        """Declared columns followed by the partition column, as they are read back."""
        if not self.partition_column:
            return self.columns
        return T.StructType(
            [*self.columns.fields, T.StructField(self.partition_column, T.StringType())]
        )

    @property
    def keeps_lineage(self) -> bool:
        return self.container not in ("landingzone", "monitoring")


@dataclass
class TableCatalog:
    """All known tables. ``TableCatalog.default()`` holds the shipped definitions."""

    tables: dict[str, TableDef] = field(default_factory=dict)

    @classmethod
    def default(cls) -> TableCatalog:
        from layerloom.catalog.tables import shipped_tables

        return cls().register(*shipped_tables())

    def register(self, *definitions: TableDef) -> TableCatalog:
        for definition in definitions:
            if definition.layer not in LAYERS:
                raise ValueError(f"Layer {definition.layer} does not exist.")
            self.tables[definition.name] = definition
        return self

    def layer(self, layer: str) -> dict[str, TableDef]:
        """Every definition of one layer."""
        if layer not in LAYERS:
            raise ValueError(f"Layer {layer} does not exist.")
        return {n: d for n, d in self.tables.items() if d.layer == layer}

    def definition(self, layer: str, name: str) -> TableDef:
        """One definition; the two monitoring tables are found under any layer."""
        known = self.tables.get(name)
        if known is not None and known.layer == "monitoring_layer":
            return known
        found = self.layer(layer).get(name)
        if found is None:
            raise ValueError(f"Table {name} does not exist in {layer}.")
        return found

    def find(self, name: str) -> TableDef:
        """Look a table up by the layer its name ends in."""
        return self.definition(f"{name.split('_')[-1]}_layer", name)


def struct_of(text: str) -> T.StructType:
    """Build a StructType from lines of ``type NAME NAME ...``."""
    kinds: dict[str, T.DataType] = {
        "string": T.StringType(),
        "long": T.LongType(),
        "double": T.DoubleType(),
        "decimal": T.DecimalType(25, 10),
        "boolean": T.BooleanType(),
        "date": T.DateType(),
        "timestamp": T.TimestampNTZType(),
    }
    fields: list[T.StructField] = []
    for line in text.strip().splitlines():
        kind, *names = line.split()
        fields += [T.StructField(n, kinds[kind]) for n in names]
    return T.StructType(fields)


def with_history(columns: T.StructType, extra: Iterable[T.StructField] = ()) -> T.StructType:
    """Append extra columns and the validity/record-id columns to landing columns."""
    tail = struct_of("date from_date to_date\nstring RecordID")
    return T.StructType([*columns.fields, *extra, *tail.fields])
