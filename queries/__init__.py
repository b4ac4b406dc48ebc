"""Queries over the driver tables, each next to the SQL that must give the same rows."""

from __future__ import annotations

from queries import climate, columns, flights, history, lineage, quality, sources, stored

_MODULES = (lineage, columns, history, quality, flights, climate, sources, stored)

QUERIES = {name: run for module in _MODULES for name, (run, _) in module.QUERIES.items()}
ORACLE_SQL = {
    name: sql for module in _MODULES for name, (_, sql) in module.QUERIES.items() if sql is not None
}
