"""Layered, auditable tables on Spark: history, record ids, lineage and quality gates."""

from layerloom.catalog import TableCatalog, TableDef
from layerloom.operators.tracked import TrackedFrame
from layerloom.workspace import Workspace

__all__ = ["TableCatalog", "TableDef", "TrackedFrame", "Workspace"]
