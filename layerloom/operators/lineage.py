"""Record-level lineage.

While rows keep their identity (select, filter, join) each row carries its sources in one small array
column: one entry per joined source. Grouping would collect every source id of a group into a single
row, which no task can hold for a hot group. A grouped row therefore carries one *link* entry, the
key of its group, and the rows that were grouped stay a DataFrame of their own. Links are turned into
plain (source, target) edges by an inner join when edges are asked for; Spark can split a hot group
over many tasks there. While all groups are there and only their keys are asked for, no link is
needed: the grouped rows hold keys and sources themselves.

Aggregates and members are computed from one DataFrame, ``GroupLink.rows``. Whoever needs both holds it
for as long (``held``): it is then evaluated once, and both read the result.

In shuffles a group is 16 bytes and a record id that is a SHA-256 in hexadecimal digits 33 bytes.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from layerloom.constants import FROM_DATE, LINEAGE, LINEAGE_TYPE, OPEN_END, RECORD_ID, TO_DATE
from layerloom.functions.hashing import row_text
from layerloom.operators.relations import union_all
from layerloom.session import cut_finely
from layerloom.sources import storage

SOURCE_TABLE = "source_table_name"
SOURCE_ID = "source_RecordID"
TARGET_TABLE = "target_table_name"
TARGET_ID = "target_RecordID"
EDGE_COLUMNS = (SOURCE_ID, SOURCE_TABLE, TARGET_ID, TARGET_TABLE)
#: The day a target row appeared: stored edges of a table are kept apart by it.
TARGET_DAY = "target_from"

LINK = "(group)"
#: Steps of a trace that are walked one by one; deeper ones are covered by jumps of 1, 2, 4, ... steps.
PLAIN_STEPS = 8
_tokens = itertools.count(1)


@dataclass(frozen=True)
class GroupLink:
    """Which sources went into the groups of one grouping."""

    token: str
    keys: tuple[str, ...]
    rows: DataFrame  # what was grouped, with its lineage
    sources: Sources  # what that lineage may hold
    # Further keys, of which each of these groups has all of the values.
    each: tuple[tuple[str, tuple[str, ...]], ...] = ()
    # What was computed per group, if a group is known to have no more rows than one task may sort.
    aggregates: tuple[Column, ...] | None = field(default=None, compare=False)

    @property
    def is_small(self) -> bool:
        """Whether rows can be brought together by group, and hold one plain source of a table at most."""
        return self.aggregates is not None and not self.sources.groups and self.sources.once is not None

    @property
    def members(self) -> DataFrame:
        """_group, source_table_name, _id: the sources of each group."""
        return _entries_of(self.rows, self.sources, [_group_key(self.rows, self.keys, self.token).alias("_group")])


@dataclass(frozen=True)
class Sources:
    """What the lineage column of a frame may hold, known without looking at rows."""

    groups: tuple[GroupLink, ...] = ()
    direct: bool = True
    # Every row holds exactly one link and differs from all other rows in the group keys. Pairs of a
    # key's name now and in the grouping.
    grouped_by: tuple[tuple[str, str], ...] | None = None
    # No group of that grouping is missing.
    complete: bool = False
    # The columns of that grouping, while the rows are nothing else: pairs of names now and then.
    columns: tuple[tuple[str, str], ...] | None = None
    # Source tables of which a row holds one entry at most, and no others; None where that is not known.
    once: frozenset[str] | None = None

    def joined(self, other: Sources) -> Sources:
        groups = tuple(dict.fromkeys([*self.groups, *other.groups]))
        known = self.once is not None and other.once is not None and not self.once & other.once
        return Sources(groups, self.direct or other.direct, once=self.once | other.once if known else None)

    def renamed(self, names: Mapping[str, str]) -> Sources:
        """The same after columns got other names."""
        if self.grouped_by is None:
            return self
        kept = {now for now, _ in self.grouped_by if now not in names}
        if kept & set(names.values()):
            return replace(self, grouped_by=None, columns=None)
        current = lambda pairs: pairs and tuple((names.get(now, now), then) for now, then in pairs)
        return replace(self, grouped_by=current(self.grouped_by), columns=current(self.columns))


def entry(source: Column, record_id: Column) -> Column:
    return F.array(
        F.struct(source.alias(SOURCE_TABLE), record_id.cast("string").alias(SOURCE_ID))
    ).cast(LINEAGE_TYPE)


def no_sources() -> Column:
    return F.array().cast(LINEAGE_TYPE)


def seed(df: DataFrame, source: str) -> DataFrame:
    """Each row becomes its own source."""
    return df.withColumn(LINEAGE, entry(F.lit(source), F.col(RECORD_ID)))


def from_map(sources: Column) -> Column:
    """Entries from a map of source tables to arrays of record ids; null maps and null ids give none."""
    ids = lambda table, found: F.transform(
        F.filter(F.coalesce(found, F.array().cast("array<string>")), lambda i: i.isNotNull()),
        lambda i: F.struct(table.alias(SOURCE_TABLE), i.alias(SOURCE_ID)),
    )
    entries = F.flatten(F.transform(F.map_entries(sources), lambda e: ids(e["key"], e["value"])))
    return F.array_distinct(F.coalesce(entries.cast(LINEAGE_TYPE), no_sources()))


def merged(left: Column, right: Column) -> Column:
    """Union of two lineages; the unmatched side of an outer join counts as empty."""
    return F.array_union(F.coalesce(left, no_sources()), F.coalesce(right, no_sources()))


def _group_name(df: DataFrame, keys: Sequence[str], token: str) -> Column:
    """128 bits in hexadecimal digits that name a group among the groups of all groupings."""
    return F.md5(F.concat(F.lit(token), row_text(df.schema, keys) if keys else F.lit("")))


def _group_key(df: DataFrame, keys: Sequence[str], token: str) -> Column:
    return F.unhex(_group_name(df, keys, token))


def packed(record_id: Column) -> Column:
    """A record id in bytes, half as many for a SHA-256; the first byte says which."""
    plain = F.concat(F.lit(b"\0"), F.encode(record_id, "UTF-8"))
    hashed = (F.length(record_id) == 64) & record_id.rlike("^[0-9a-f]{64}$")
    return F.when(hashed, F.concat(F.lit(b"\1"), F.unhex(record_id))).otherwise(plain)


def unpacked(packed: Column) -> Column:
    kind, rest = F.substring(packed, 1, 1), packed.substr(F.lit(2), F.length(packed))
    return F.when(kind == F.lit(b"\1"), F.lower(F.hex(rest))).otherwise(F.decode(rest, "UTF-8"))


def link_groups(
    df: DataFrame,
    grouped: DataFrame,
    keys: Sequence[str],
    sources: Sources,
    each: Mapping[str, Sequence[str]] | None = None,
    aggregates: Sequence[Column] | None = None,
) -> tuple[DataFrame, Sources]:
    """Give the grouped rows their link entry and describe the members of the groups."""
    cut_finely(df.sparkSession)
    token = f"{next(_tokens)}:"
    known = tuple(k for k in keys if k in df.columns)
    spread = tuple((k, tuple(values)) for k, values in (each or {}).items())
    link = GroupLink(token, known, df, sources, spread, None if aggregates is None else tuple(aggregates))
    linked = grouped.withColumn(LINEAGE, entry(F.lit(LINK), _group_name(grouped, known, token)))
    columns = tuple((c, c) for c in grouped.columns)
    return linked, Sources((link,), False, tuple((k, k) for k in keys), complete=True, columns=columns)


def _only_id(table: str) -> Column:
    """The record id of a row's first entry of a source table."""
    return F.get(F.filter(LINEAGE, lambda e: e[SOURCE_TABLE] == table), F.lit(0))[SOURCE_ID]


def counted_groups(sources: Sources, tables: Mapping[str, str]) -> DataFrame | None:
    """The rows of a grouping next to the number of sources from each table, if one shuffle can give both.

    ``tables`` names all source tables by the columns of their numbers. The rows of a group are brought together once;
    a task sorts them by the ids of each table and aggregates what it counted with the rest. It holds none of a group's ids
    at a time, but a group is not split: groupings declare that theirs are small.
    """
    link = sources.groups[0] if sources.complete and sources.columns else None
    if link is None or not link.is_small or link.sources.once != frozenset(tables.values()):
        return None
    group = Window.partitionBy(*link.keys)
    rows = link.rows.select(
        *[c for c in link.rows.columns if c != LINEAGE],
        *[packed(_only_id(table)).alias(f"_id_{n}") for n, table in tables.items()],
    ).repartition(*link.keys)
    for n in tables:
        rows = rows.withColumn(f"_nth_{n}", F.dense_rank().over(group.orderBy(F.asc_nulls_last(f"_id_{n}"))))
    numbers = [
        F.coalesce(F.max(F.when(F.col(f"_id_{n}").isNotNull(), F.col(f"_nth_{n}"))).cast("bigint"), F.lit(0)).alias(n)
        for n in tables
    ]
    counted = rows.groupBy(*link.keys).agg(*link.aggregates, *numbers)
    # A group without any source is not listed, as where its sources are looked up.
    return counted.where(" OR ".join(f"`{n}` > 0" for n in tables)).select(
        *[F.col(f"`{then}`").alias(now) for now, then in sources.columns], *tables
    )


def _entries_of(
    df: DataFrame, sources: Sources, keep: Sequence[Column | str], unique: bool = False
) -> DataFrame:
    """One row per (row of ``df``, source): the kept columns, source table and packed source id."""
    # Where the kept columns identify a row, only its own entries can be equal, and no shuffle has to find that out.
    alone = unique and not sources.groups
    held = F.array_distinct(LINEAGE) if alone else F.col(LINEAGE)
    # The outer form of explode keeps the optimizer from computing the entries a second time.
    entries = df.select(*keep, F.explode_outer(held).alias("_e"))
    kept = entries.columns[:-1]
    name, record_id = F.col(f"_e.{SOURCE_TABLE}"), F.col(f"_e.{SOURCE_ID}")
    found = record_id.isNotNull()
    if not sources.groups:
        direct = entries.where(found).select(*kept, name, packed(record_id).alias("_id"))
        return direct if alone else direct.distinct()
    if sources.grouped_by is not None and unique and sources.groups[0].is_small:
        return _entries_of_small(entries.where(name == LINK), kept, sources.groups[0])
    members = union_all([g.members for g in sources.groups]).withColumnRenamed("_group", "_of")
    links = entries.where(name == LINK).select(*kept, F.unhex(record_id).alias("_link"))
    if sources.grouped_by is None:
        links = links.distinct()
    resolved = links.join(members, F.col("_link") == F.col("_of")).select(*kept, SOURCE_TABLE, "_id")
    if sources.grouped_by is not None and unique:
        return resolved
    if sources.direct:
        direct = entries.where((name != LINK) & found).select(*kept, name, packed(record_id).alias("_id"))
        resolved = resolved.unionByName(direct)
    return resolved.distinct()


def _entries_of_small(links: DataFrame, kept: Sequence[str], link: GroupLink) -> DataFrame:
    """The same for groups whose rows a task may hold: rows, not entries, meet the groups, and distinct ones are found there."""
    tables = sorted(link.sources.once)
    rows = link.rows.select(
        _group_key(link.rows, link.keys, link.token).alias("_of"),
        *[packed(_only_id(table)).alias(f"_own{i}") for i, table in enumerate(tables)],
    )
    groups = links.select(*kept, F.unhex(F.col(f"_e.{SOURCE_ID}")).alias("_link"))
    own = [F.struct(F.lit(t).alias(SOURCE_TABLE), F.col(f"_own{i}").alias("_id")) for i, t in enumerate(tables)]
    met = groups.join(rows, F.col("_link") == F.col("_of")).select("_link", *kept, F.inline(F.array(*own)))
    return met.where(F.col("_id").isNotNull()).distinct().drop("_link")


def row_sources(
    df: DataFrame, sources: Sources, keep: Sequence[Column | str], unique: bool = False
) -> DataFrame:
    """One row per (row of ``df``, source): the kept columns, source table and source id.

    ``unique`` says that the kept columns identify a row, which saves the last shuffle after a
    grouping, and the only one where nothing was grouped. Members hold plain sources only, so one join resolves all links.
    """
    names = dict(sources.grouped_by or ())
    link = sources.groups[0] if sources.complete and names else None
    spread = dict(link.each) if link else {}
    if link and all(isinstance(c, str) and (names.get(c) in link.keys or names.get(c) in spread) for c in keep):
        # The rows that were grouped know the keys of their group: neither groups nor links are computed.
        own = [F.col(names[c]).alias(c) for c in keep if names[c] in link.keys]
        entries = _entries_of(link.rows, link.sources, own)
        for c in keep:
            if names[c] in spread:
                entries = entries.withColumn(c, F.explode(F.array(*[F.lit(v) for v in spread[names[c]]])))
    else:
        entries = _entries_of(df, sources, keep, unique)
    kept = [c for c in entries.columns if c not in (SOURCE_TABLE, "_id")]
    return entries.select(*kept, SOURCE_TABLE, unpacked(F.col("_id")).alias(SOURCE_ID))


@contextmanager
def held(*frames: DataFrame, origin: Sources | None = None) -> Iterator[None]:
    """Evaluate frames, and what the groupings of ``origin`` were computed from, once while this lasts.

    The rows stand on the disks of executors; those of a lost executor are computed again.
    """
    # What others are computed from comes first: a plan is bound to what is held when it is held itself.
    wanted = [*(link.rows for link in reversed(_all_groups(origin or Sources()))), *frames]
    new = [f for f in wanted if f.storageLevel == StorageLevel.NONE]
    for frame in new:
        frame.persist(StorageLevel.DISK_ONLY)
    try:
        yield
    finally:
        for frame in new:
            frame.unpersist()


def _all_groups(origin: Sources) -> list[GroupLink]:
    """Groupings and those they were computed from."""
    found = [*origin.groups]
    for link in origin.groups:
        found += _all_groups(link.sources)
    return list({link.token: link for link in found}.values())


def open_edges(df: DataFrame, sources: Sources, target: str) -> DataFrame:
    """Edges of the open rows of a table that is about to be stored, with the day each target appeared."""
    rows = df.where(F.col(TO_DATE) == F.lit(OPEN_END).cast("date"))
    keep = [packed(F.col(RECORD_ID)).alias(TARGET_ID), F.col(FROM_DATE).alias(TARGET_DAY)]
    edges = row_sources(rows, replace(sources, complete=False), keep, unique=True)
    return edges.select(
        SOURCE_ID, SOURCE_TABLE, unpacked(F.col(TARGET_ID)).alias(TARGET_ID), F.lit(target).alias(TARGET_TABLE), TARGET_DAY
    )


def _edge_key() -> Column:
    return F.unhex(F.md5(F.concat_ws("|", SOURCE_ID, TARGET_ID, SOURCE_TABLE, TARGET_TABLE)))


def new_edges(edges: DataFrame, stored: DataFrame) -> DataFrame:
    """Edges that are not stored yet; 16 bytes of each stored edge are compared."""
    known = stored.select(_edge_key().alias("_edge"))
    return edges.withColumn("_edge", _edge_key()).join(known, "_edge", "left_anti").drop("_edge")


def trace(edges: DataFrame, starts: DataFrame, per_start: bool = False) -> DataFrame:
    """Follow records back to their sources, any depth; a cycle of edges is an error.

    ``starts`` has ``table_name`` and ``RecordID``. The result holds every reached record once per
    depth and parent: ``depth, table_name, RecordID, parent_table_name, parent_RecordID``. It grows
    with the reached edges, not with starts times sources; ``per_start=True`` adds
    ``start_table_name, start_RecordID`` and repeats shared sources for each start.

    Each step joins the whole frontier with the edges. Its result is checkpointed: the loop has to
    know which tables it reached, and a lost executor must not cause all earlier steps to run again.
    Only edges into those tables are read, which are single partitions of a stored edge table. After
    ``PLAIN_STEPS`` steps the rest is covered by jumps, in as many rounds as the depth has binary digits.
    """
    spark = starts.sparkSession
    shared_folder(spark)
    cut_finely(spark)
    start = ["start_table_name", "start_RecordID"] if per_start else []
    origin = [F.col("table_name").alias(start[0]), F.col(RECORD_ID).alias(start[1])] if start else []
    frontier = starts.select(
        *origin,
        F.lit(0).alias("depth"),
        "table_name",
        RECORD_ID,
        F.lit(None).cast("string").alias("parent_table_name"),
        F.lit(None).cast("string").alias("parent_RecordID"),
    ).distinct()
    frontier = frontier.checkpoint()
    reached = frontier
    tables, depth = _table_names(frontier), 0
    while tables:
        depth += 1
        # A way without a cycle has one record more than steps. Counted at 1, 2, 4, 8 ... steps.
        if depth > 1 and depth & (depth - 1) == 0:
            records = reached.select("table_name", RECORD_ID).distinct().count()
            if depth > records:
                raise ValueError(f"The lineage of these records has a cycle of at most {records} steps")
        nodes = frontier.select(*start, "table_name", RECORD_ID)
        if depth > 1:  # starts have no parents that could repeat them
            nodes = nodes.distinct()
        step = (
            nodes.join(
                edges.where(F.col(TARGET_TABLE).isin(tables)),
                (F.col("table_name") == F.col(TARGET_TABLE)) & (F.col(RECORD_ID) == F.col(TARGET_ID)),
            )
            .select(
                *start,
                F.lit(depth).alias("depth"),
                F.col(SOURCE_TABLE).alias("table_name"),
                F.col(SOURCE_ID).alias(RECORD_ID),
                F.col(TARGET_TABLE).alias("parent_table_name"),
                F.col(TARGET_ID).alias("parent_RecordID"),
            )
            .distinct()
        )
        frontier = step.checkpoint()
        tables = _table_names(frontier)
        reached = reached.unionByName(frontier)
        if tables and depth >= PLAIN_STEPS:
            return reached.unionByName(_deeper(edges, frontier, start))
    return reached


def _deeper(edges: DataFrame, frontier: DataFrame, start: Sequence[str]) -> DataFrame:
    """What is reached from the records of a frontier, in the form of ``trace``.

    With jumps of 2^k steps, records reached within 2^k - 1 steps give those within 2^(k+1) - 1, and two jumps make
    one of twice the length. Jumps are kept in files until the next ones are there.
    """
    spark = frontier.sparkSession
    folder = f"{shared_folder(spark)}/trace-{uuid.uuid4().hex}"

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    below = _tables_below(edges, _table_names(frontier))
    links = edges.where(F.col(TARGET_TABLE).isin(below))
    step = links.select(
        F.col(TARGET_TABLE).alias("_table"),
        packed(F.col(TARGET_ID)).alias("_id"),
        F.col(SOURCE_TABLE).alias("_to"),
        packed(F.col(SOURCE_ID)).alias("_to_id"),
    ).distinct()
    place = ["_table", "_id"]
    records = F.col("table_name").alias("_table"), packed(F.col(RECORD_ID)).alias("_id")
    jumps = kept(step, "jumps-1")
    reached = kept(frontier.select(*start, "depth", *records).distinct(), "reached-0")
    length = 1
    while True:
        ahead = reached.join(jumps, place).select(
            *start, (F.col("depth") + length).alias("depth"), F.col("_to").alias("_table"), F.col("_to_id").alias("_id")
        )
        ahead = kept(ahead.distinct(), f"reached-{length}")
        if ahead.isEmpty():
            break
        reached = reached.unionByName(ahead)
        # A way of this many steps without a cycle has one record more.
        found = reached.select(*place).distinct().count()
        if found <= length:
            raise ValueError(f"The lineage of these records has a cycle of at most {found} steps")
        second = jumps.select(*[F.col(c).alias(f"{c}2") for c in jumps.columns])
        meet = (F.col("_to") == F.col("_table2")) & (F.col("_to_id") == F.col("_id2"))
        doubled = jumps.join(second, meet).select(*place, F.col("_to2").alias("_to"), F.col("_to_id2").alias("_to_id"))
        jumps = kept(doubled.distinct(), f"jumps-{2 * length}")
        storage.delete(spark, f"{folder}/jumps-{length}")
        length *= 2
    storage.delete(spark, f"{folder}/jumps-{length}")
    return reached.join(step, place).select(
        *start,
        (F.col("depth") + 1).alias("depth"),
        F.col("_to").alias("table_name"),
        unpacked(F.col("_to_id")).alias(RECORD_ID),
        F.col("_table").alias("parent_table_name"),
        unpacked(F.col("_id")).alias("parent_RecordID"),
    )


def _tables_below(edges: DataFrame, tables: list[str]) -> list[str]:
    """The tables and all tables their records can come from; the catalog bounds the pairs."""
    pairs = [tuple(r) for r in edges.select(TARGET_TABLE, SOURCE_TABLE).distinct().collect()]
    found = set(tables)
    while more := {source for target, source in pairs if target in found} - found:
        found |= more
    return sorted(found)


def _table_names(records: DataFrame) -> list[str]:
    """The tables the records belong to; there are no more than the catalog holds."""
    return [row[0] for row in records.select("table_name").distinct().collect()]


def shared_folder(spark: SparkSession) -> str:
    """The folder driver and executors share for checkpoints and tables of one run.

    ``spark.checkpoint.dir`` names it; a folder given to the context counts as well.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or context.getConf().get("spark.checkpoint.dir")
    if not folder:
        raise ValueError("Set spark.checkpoint.dir to a folder that driver and executors share")
    return folder.rstrip("/")
