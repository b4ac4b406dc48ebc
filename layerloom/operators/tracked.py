"""A DataFrame together with its table definition and the lineage of its rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerloom.catalog import TableDef
from layerloom.constants import LINEAGE, RECORD_ID
from layerloom.operators import lineage
from layerloom.operators.relations import same_schema

if TYPE_CHECKING:
    from layerloom.workspace import Workspace

JOIN_KINDS = {
    "inner": "inner",
    "left": "left",
    "right": "right",
    "full": "full",
    "outer": "full",
    "semi": "left_semi",
    "anti": "left_anti",
}
Key = str | Column


@dataclass(frozen=True)
class TrackedFrame:
    """Every operator returns a new frame; nothing runs before an action or ``write``."""

    df: DataFrame
    table: TableDef | None = None
    workspace: Workspace | None = None
    partition: str = ""
    history: str = "recent"
    origin: lineage.Sources = lineage.Sources()

    # -- access -------------------------------------------------------------------------------

    @property
    def name(self) -> str:
        return self.table.name if self.table else ""

    @property
    def is_tracked(self) -> bool:
        return LINEAGE in self.df.columns

    @property
    def values(self) -> list[str]:
        """All columns but the lineage."""
        return [c for c in self.df.columns if c != LINEAGE]

    @property
    def data(self) -> DataFrame:
        """The rows without their lineage column."""
        return self.df.drop(LINEAGE)

    def with_df(self, df: DataFrame) -> TrackedFrame:
        """The same table around other rows that carry the lineage of these rows."""
        return replace(self, df=df, origin=replace(self.origin, grouped_by=None, columns=None, once=None))

    def _keeping_keys(self, df: DataFrame, changed: Iterable[str] = (), fewer: bool = False) -> TrackedFrame:
        """The same rows, or fewer; group keys still identify them unless one of them was changed."""
        grouped_by = self.origin.grouped_by
        if grouped_by is None or {now for now, _ in grouped_by} & set(changed):
            once = None if LINEAGE in changed else self.origin.once
            return replace(self, df=df, origin=replace(self.origin, grouped_by=None, columns=None, once=once))
        complete = self.origin.complete and not fewer
        return replace(self, df=df, origin=replace(self.origin, complete=complete, columns=None))

    def with_columns(self, **columns: Column) -> TrackedFrame:
        return self._keeping_keys(self.df.withColumns(columns), columns)

    def where(self, condition: Column | str) -> TrackedFrame:
        return self._keeping_keys(self.df.where(condition), fewer=True)

    @classmethod
    def from_lineage_map(cls, df: DataFrame, column: str) -> TrackedFrame:
        """Rows whose sources a map column holds: source tables to arrays of record ids."""
        return cls(df.withColumn(LINEAGE, lineage.from_map(F.col(column))).drop(column))

    # -- columns ------------------------------------------------------------------------------

    def select(self, *columns: Key) -> TrackedFrame:
        """The given columns, and always the lineage."""
        kept = [c for c in columns if isinstance(c, Column) or c != LINEAGE]
        chosen = self.df.select(*kept, *([LINEAGE] if self.is_tracked else []))
        if any(isinstance(c, Column) for c in kept):
            return replace(self, df=chosen, origin=replace(self.origin, grouped_by=None, columns=None))
        return self._keeping_keys(chosen)

    def drop(self, *columns: str) -> TrackedFrame:
        if LINEAGE in columns:
            raise ValueError("The lineage column cannot be dropped")
        return self._keeping_keys(self.df.drop(*columns))

    def rename(self, names: Mapping[str, str]) -> TrackedFrame:
        for name in names:
            if name not in self.df.columns:
                raise ValueError(f"There is no column {name} to rename")
        return replace(self, df=self.df.withColumnsRenamed(dict(names)), origin=self.origin.renamed(names))

    def cast(self, columns: Sequence[str], data_type: T.DataType | str) -> TrackedFrame:
        converted = self.df.withColumns({c: F.col(c).cast(data_type) for c in columns})
        return self._keeping_keys(converted, columns)

    def unpivot(
        self, ids: Sequence[str], values: Sequence[str], variable: str, value: str
    ) -> TrackedFrame:
        """Wide to long; each long row keeps the lineage of its wide row."""
        kept = [*ids, *([LINEAGE] if self.is_tracked else [])]
        return self.with_df(self.df.unpivot(kept, list(values), variable, value))

    # -- joins --------------------------------------------------------------------------------

    def join(
        self,
        other: TrackedFrame,
        on: str | Sequence[str] | None = None,
        how: str | None = None,
        left_on: Key | Sequence[Key] | None = None,
        right_on: Key | Sequence[Key] | None = None,
    ) -> TrackedFrame:
        """Equi-join; the lineage of both sides is united.

        With ``on`` one key column remains. With ``left_on``/``right_on`` inner and left joins drop
        the right key, right joins the left key, and full joins keep both. The strategy (broadcast,
        skew splitting) is left to the planner, which knows the sizes.
        """
        if how not in JOIN_KINDS:
            raise ValueError(f"Unknown type of join; known are {sorted(JOIN_KINDS)}")
        kind = JOIN_KINDS[how]
        if on is not None:
            left_keys = right_keys = _listed(on)
        elif left_on is not None and right_on is not None:
            left_keys, right_keys = _listed(left_on), _listed(right_on)
        else:
            raise ValueError("Give either on, or left_on and right_on")
        if len(left_keys) != len(right_keys):
            raise ValueError("left_on and right_on differ in length")

        left, right = self.df.alias("l"), other.df.alias("r")
        condition = reduce(
            Column.__and__,
            [_side(a, "l") == _side(b, "r") for a, b in zip(left_keys, right_keys, strict=True)],
        )
        joined = left.join(right, condition, kind)
        if kind in ("left_semi", "left_anti"):
            return self._keeping_keys(joined.select("l.*"), fewer=True)

        left_out, right_out = self.values, other.values
        shared: list[Column] = []
        if on is not None:
            shared = [_shared_key(key, kind) for key in left_keys]
            left_out = [c for c in left_out if c not in left_keys]
            right_out = [c for c in right_out if c not in right_keys]
        elif kind in ("inner", "left"):
            right_out = [c for c in right_out if c not in _names(right_keys)]
        elif kind == "right":
            left_out = [c for c in left_out if c not in _names(left_keys)]
        collisions = sorted(set(left_out) & set(right_out))
        if collisions:
            raise ValueError(f"Both sides have columns {collisions}: rename them first")

        columns = [
            *shared,
            *[F.col(f"l.`{c}`") for c in left_out],
            *[F.col(f"r.`{c}`") for c in right_out],
        ]
        if self.is_tracked and other.is_tracked:
            columns.append(lineage.merged(F.col(f"l.{LINEAGE}"), F.col(f"r.{LINEAGE}")).alias(LINEAGE))
        elif self.is_tracked or other.is_tracked:
            side = "l" if self.is_tracked else "r"
            columns.append(F.coalesce(F.col(f"{side}.{LINEAGE}"), lineage.no_sources()).alias(LINEAGE))
        return replace(
            self, df=joined.select(*columns), origin=self.origin.joined(other.origin)
        )

    # -- order --------------------------------------------------------------------------------

    def order_by(self, *columns: Key) -> TrackedFrame:
        """The same rows in order, with their lineage; Spark sorts by range partitions."""
        return self._keeping_keys(self.df.orderBy(*columns))

    def head(self, n: int, *columns: Key) -> TrackedFrame:
        """The first ``n`` rows in order of the columns, with their lineage.

        Each task sends its first ``n`` rows only. Ties are cut at ``n``: give columns that decide.
        """
        if not columns:
            raise ValueError("Give the columns that order the rows")
        return self._keeping_keys(self.df.orderBy(*columns).limit(n), fewer=True)

    # -- grouping -----------------------------------------------------------------------------

    def group_by(
        self,
        columns: Sequence[str],
        *aggregates: Column,
        members: TrackedFrame | None = None,
        each: Mapping[str, Sequence[str]] | None = None,
        small: bool = False,
    ) -> TrackedFrame:
        """Any aggregate expressions per group, in one aggregation; null keys form groups.

        Sources are looked up in ``members`` where it is given: rows with the same lineage that were cheaper
        to compute, such as these rows before a derived column was joined to them. They may lack keys on
        which the sources of a group do not depend; these rows need no lineage then. ``each`` names the values of
        such keys, if all of them occur next to each group. ``small`` says that no group has more rows than one task
        may sort; sources can then be counted along with the aggregates (``counted``).

        Aggregates and sources are computed from the same rows, so select the columns they need first.
        """
        keys = list(columns)
        grouped = (
            self.df.groupBy(*keys).agg(*aggregates) if aggregates else self.df.select(*keys).distinct()
        )
        rows = members or self
        if not rows.is_tracked:
            return self.with_df(grouped)
        own = aggregates if small and members is None else None
        linked, origin = lineage.link_groups(rows.df, grouped, keys, rows.origin, each, own)
        return replace(self, df=linked, origin=origin)

    def average(self, columns: Sequence[str], value: str, output: str | None = None) -> TrackedFrame:
        return self.group_by(columns, F.avg(value).alias(output or f"avg({value})"))

    def distinct(self) -> TrackedFrame:
        """Distinct by values; a kept row has the sources of all rows it stands for."""
        return self._with_copies().group_by(self.values)

    def _with_copies(self) -> TrackedFrame:
        """The rows this frame is the distinct form of, if it is one: a second distinct needs no first."""
        names = dict(self.origin.grouped_by or ())
        if not names or not self.origin.complete or set(names) != set(self.values):
            return self
        link = self.origin.groups[0]
        rows = link.rows.select(*[F.col(f"`{names[c]}`").alias(c) for c in self.values], LINEAGE)
        return replace(self, df=rows, origin=link.sources)

    def union(self, other: TrackedFrame) -> TrackedFrame:
        """Union by name, distinct by values; same column names and types are required."""
        same_schema(self.data, other.data)
        first, second = self._with_copies(), other._with_copies()
        left, right = first.df, second.df
        if self.is_tracked != other.is_tracked:
            left = left if self.is_tracked else left.withColumn(LINEAGE, lineage.no_sources())
            right = right if other.is_tracked else right.withColumn(LINEAGE, lineage.no_sources())
        both = replace(self, df=left.unionByName(right), origin=first.origin.joined(second.origin))
        return both.distinct()

    # -- lineage ------------------------------------------------------------------------------

    def sources(self, *keep: str) -> DataFrame:
        """Source table and record id of every row, next to the columns that identify it."""
        keep = keep or (RECORD_ID,)
        grouped_by = self.origin.grouped_by
        unique = grouped_by is not None and {now for now, _ in grouped_by} <= set(keep)
        return lineage.row_sources(self.df, self.origin, keep, unique)

    def counted(self, keys: Sequence[str], tables: Mapping[str, str]) -> DataFrame | None:
        """The rows of small groups (``group_by``) next to the number of sources behind each of them, from one shuffle.

        ``tables`` names source tables by the columns of their numbers. None where the rows are not just such groups.
        """
        grouped_by = self.origin.grouped_by
        if grouped_by is None or {now for now, _ in grouped_by} != set(keys):
            return None
        return lineage.counted_groups(self.origin, tables)

    # -- storage ------------------------------------------------------------------------------

    def compare(self, processing_date: dt.date | None = None) -> DataFrame:
        """These rows merged into the stored history of their table."""
        from layerloom.operators.writing import compare_with_stored

        return compare_with_stored(self, processing_date)

    def write(self) -> TrackedFrame:
        """Store these rows as the new state of their table; see ``operators.writing``."""
        from layerloom.operators.writing import write_table

        return write_table(self)


def _listed(keys: Key | Sequence[Key]) -> list[Key]:
    return [keys] if isinstance(keys, (str, Column)) else list(keys)


def _side(key: Key, side: str) -> Column:
    return F.col(f"{side}.`{key}`") if isinstance(key, str) else key


def _shared_key(key: str, kind: str) -> Column:
    left, right = F.col(f"l.`{key}`"), F.col(f"r.`{key}`")
    if kind == "full":
        return F.coalesce(left, right).alias(key)
    return right if kind == "right" else left


def _names(keys: Sequence[Key]) -> set[str]:
    return {k for k in keys if isinstance(k, str)}
