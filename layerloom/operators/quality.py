"""Data-quality checks: a blocking gate and signalling metrics.

A check is a dict with ``check`` (its name), ``columns`` and its parameters. Every check counts valid
rows and is measured as one row ``total_count, valid_count``. All checks that look at single rows share
one aggregation, or are counted by the job that writes the rows (``RowCounter``). Checks on groups first shrink each group to a count and then add the counts up, so
rows are never joined back and no group has to fit into a task.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from layerloom.constants import HISTORY_COLUMNS, LINEAGE, OPEN_END, RECORD_ID, TO_DATE
from layerloom.operators.lineage import SOURCE_TABLE, TARGET_ID, packed, unpacked
from layerloom.operators.relations import union_all
from layerloom.session import cut_finely

Check = Mapping[str, object]

# Check names, ids, texts, null tokens and the tolerance of sums.
FILLED_ID = "dq_1"
FILLED_TEXT = "Check if values are filled"
CHECK_IDS = {
    "values within list": "dq_2",
    "values in range": "dq_3",
    "values are unique": "dq_4",
    "values have format": "dq_5",
    "values are consistent": "dq_6",
    "values occur as expected": "dq_7",
    "values sum to 1": "dq_8",
    "distinct values occur as expected": "dq_9",
    "record has expected history": "dq_10",
}
CHECK_ALIASES = {"values in list": "values within list"}
BLOCKING_CHECKS = ("values in range", "values are unique", "values have format")
UNFILLED_TOKENS = ("NA", "nan")
SUM_LIMITS = (0.98, 1.02)
METRIC_COLUMNS = (
    "signalling_id",
    "check_id",
    "column_name",
    "check_name",
    "total_count",
    "valid_count",
)
METRIC_SCHEMA = (
    "signalling_id bigint, check_id string, column_name string, check_name string, total_count bigint, valid_count bigint"
)
METRIC_KEY = ("table_name", "column_name", "check_name", "check_id")


def check_name(check: Check) -> str:
    name = CHECK_ALIASES.get(check["check"], check["check"])
    if name not in CHECK_IDS:
        raise ValueError(f"Unknown check: {name}")
    return name


def describe(check: Check) -> str:
    """The text that names a measured check in the metrics."""
    name = check_name(check)
    if name == "values within list":
        return f'values within list of: "{_listed(check["value_list"])}"'
    if name == "values in range":
        return f"values between {check['range_start']} and {check['range_end']}"
    if name == "values are unique":
        return f"unique values in column `{','.join(check['columns'])}`"
    if name == "values have format":
        return f"values have format {check['format']}"
    if name == "values are consistent":
        return f"values are consistent on {','.join(check['join_columns'])}"
    if name == "values occur as expected":
        return f"values occur {check['expected_count']} times"
    if name == "values sum to 1":
        return f'values in column "{check["sum_column"]}" sum to 1'
    if name == "distinct values occur as expected":
        listed = _listed(check["distinct_columns"])
        return f"{check['expected_count']} distinct values occur in column {listed}"
    return "values have the expected record trace"


def _listed(values: Sequence[object]) -> str:
    return '","'.join(str(v) for v in values)


def labels(checks: Sequence[Check]) -> list[str]:
    """The text of each check, made different where checks on the same columns share one.

    The first check keeps the plain text; a later one gets a hash of all its parameters behind it.
    """
    found, seen = [], set()
    for check in checks:
        text = describe(check)
        key = CHECK_IDS[check_name(check)], ",".join(check["columns"])
        if (*key, text) in seen:
            parameters = json.dumps(check, sort_keys=True, default=str)
            text = f"{text} [{hashlib.sha256(parameters.encode()).hexdigest()[:16]}]"
        if (*key, text) in seen:
            raise ValueError(f"The same check is listed twice: {describe(check)}")
        seen.add((*key, text))
        found.append(text)
    return found


# -- checks on single rows ----------------------------------------------------------------------


def is_filled(df: DataFrame, column: str) -> Column:
    """Not null; texts are not a null token either, and floats not NaN."""
    value, kind = F.col(column), df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return value.isNotNull() & ~value.isin(*UNFILLED_TOKENS)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return value.isNotNull() & ~F.isnan(value)
    return value.isNotNull()


def has_format(column: Column, pattern: str) -> Column:
    """Regular-expression search with Unicode classes; a closing ``$`` means the very end."""
    if pattern.endswith("$") and not pattern.endswith("\\$"):
        pattern = pattern[:-1] + r"\z"
    return column.rlike("(?Ud)" + pattern)


ROW_CHECKS: dict[str, Callable[[Check], Column]] = {
    "values within list": lambda c: F.col(c["columns"][0]).isin(*c["value_list"]),
    "values in range": lambda c: F.col(c["columns"][0]).between(c["range_start"], c["range_end"]),
    "values have format": lambda c: has_format(F.col(c["columns"][0]), c["format"]),
}


# -- checks on groups ---------------------------------------------------------------------------


def _passing_rows(groups: DataFrame, keys: Sequence[str], passes: Column) -> DataFrame:
    """Add up the rows of passing groups; a group with a null key never passes."""
    usable = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    return groups.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_count"),
        F.coalesce(F.sum(F.when(usable & passes, F.col("_rows"))), F.lit(0)).alias("valid_count"),
    )


def unique_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct value tuples; null is a value."""
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows"))
    return groups.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_count"),
        F.count(F.lit(1)).alias("valid_count"),
    )


def rows_in_groups_of(df: DataFrame, columns: Sequence[str], expected: int) -> DataFrame:
    """Rows in groups that have the expected number of record ids."""
    groups = df.groupBy(*columns).agg(
        F.count(RECORD_ID).alias("_ids"), F.count(F.lit(1)).alias("_rows")
    )
    return _passing_rows(groups, columns, F.col("_ids") == expected)


def rows_in_groups_summing_to_one(df: DataFrame, columns: Sequence[str], value: str) -> DataFrame:
    groups = df.groupBy(*columns).agg(
        F.coalesce(F.sum(value), F.lit(0)).alias("_sum"), F.count(F.lit(1)).alias("_rows")
    )
    return _passing_rows(groups, columns, F.col("_sum").between(*SUM_LIMITS))


def rows_in_groups_with_distinct(
    df: DataFrame, columns: Sequence[str], distinct_columns: Sequence[str], expected: int
) -> DataFrame:
    """Rows in groups with the expected number of distinct tuples; null is a value."""
    keys = list(dict.fromkeys([*columns, *distinct_columns]))
    tuples = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    groups = tuples.groupBy(*columns).agg(
        F.count(F.lit(1)).alias("_tuples"), F.sum("_n").alias("_rows")
    )
    return _passing_rows(groups, columns, F.col("_tuples") == expected)


def consistent_rows(
    df: DataFrame, column: str, compare: DataFrame, join_columns: Sequence[str]
) -> DataFrame:
    """Pairs of rows of both tables that agree on the keys and on the value.

    Repeated keys multiply. Both sides are therefore reduced to counts per (keys, value) first, and
    the counts are multiplied instead of joining row with row.
    """
    keys = list(dict.fromkeys([*join_columns, column]))
    left = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_left"))
    right = compare.groupBy(*keys).agg(F.count(F.lit(1)).alias("_right"))
    valid = left.join(right, keys).agg(
        F.coalesce(F.sum(F.col("_left") * F.col("_right")), F.lit(0)).alias("v")
    )
    return df.agg(F.count(F.lit(1)).alias("total_count")).withColumn("valid_count", valid.scalar())


def trace_template(expected: object) -> list[dict]:
    """A template as rows, from a list of rows or a dict of columns."""
    if isinstance(expected, Mapping):
        names = list(expected)
        return [dict(zip(names, row, strict=True)) for row in zip(*expected.values(), strict=True)]
    return [dict(row) for row in expected]


def expected_history(
    df: DataFrame, trace: DataFrame, expected: object, strict: bool = False
) -> DataFrame:
    """Records whose sources match a template of (source table, number of records).

    A record is invalid when a source table contributes a number of records the template does not
    name. Records without any trace pass, unless ``strict`` asks for every template row to be met.
    Template rows may name one ``target_RecordID`` they are meant for.
    """
    cut_finely(df.sparkSession)
    template = trace_template(expected)
    counts = (
        trace.select(packed(F.col(TARGET_ID)).alias("_id"), SOURCE_TABLE)
        .join(df.select(packed(F.col(RECORD_ID)).alias("_id")), "_id")
        .groupBy("_id", SOURCE_TABLE)
        .agg(F.count(F.lit(1)).alias("amount_records"))
        .withColumn(TARGET_ID, unpacked(F.col("_id")))
    )
    matches = [
        reduce(Column.__and__, [F.col(name) == F.lit(value) for name, value in row.items()])
        for row in template
    ]
    known = F.coalesce(reduce(Column.__or__, matches, F.lit(False)), F.lit(False))
    total = df.agg(F.count(F.lit(1)).alias("total_count"))
    if not strict:
        invalid = counts.where(~known).agg(F.count_distinct(TARGET_ID).alias("v"))
        return total.withColumn("valid_count", F.col("total_count") - invalid.scalar())
    if any(TARGET_ID in row for row in template):
        raise ValueError("A strict template applies to every record and names no target_RecordID")
    complete = (
        counts.groupBy(TARGET_ID)
        .agg(F.count_if(known).alias("_met"), F.count(F.lit(1)).alias("_all"))
        .where((F.col("_met") == len(template)) & (F.col("_all") == len(template)))
        .agg(F.count(F.lit(1)).alias("v"))
    )
    return total.withColumn("valid_count", complete.scalar())


def measure_group_check(df: DataFrame, check: Check, trace: DataFrame | None = None) -> DataFrame:
    name, columns = check_name(check), check["columns"]
    if name == "values are unique":
        return unique_rows(df, columns)
    if name == "values are consistent":
        return consistent_rows(df, columns[0], check["compare_table"], check["join_columns"])
    if name == "values occur as expected":
        return rows_in_groups_of(df, columns, check["expected_count"])
    if name == "values sum to 1":
        return rows_in_groups_summing_to_one(df, columns, check["sum_column"])
    if name == "distinct values occur as expected":
        return rows_in_groups_with_distinct(
            df, columns, check["distinct_columns"], check["expected_count"]
        )
    table = check.get("record_trace_table", trace)
    if table is None:
        raise ValueError("The history check needs the record trace")
    return expected_history(df, table, check["expected_trace"], check.get("strict", False))


def measure(df: DataFrame, check: Check, trace: DataFrame | None = None) -> DataFrame:
    """One row ``total_count, valid_count`` for a single check."""
    name = check_name(check)
    if name not in ROW_CHECKS:
        return measure_group_check(df, check, trace)
    return df.agg(
        F.count(F.lit(1)).alias("total_count"), F.count_if(ROW_CHECKS[name](check)).alias("valid_count")
    )


# -- metrics ------------------------------------------------------------------------------------


def _metric(check_id: str, column: str, text: str, total: Column, valid: Column) -> list[Column]:
    return [
        F.lit(None).cast("long").alias("signalling_id"),
        F.lit(check_id).alias("check_id"),
        F.lit(column).alias("column_name"),
        F.lit(text).alias("check_name"),
        total.cast("long").alias("total_count"),
        valid.cast("long").alias("valid_count"),
    ]


def _row_metrics(df: DataFrame, measured: Sequence[tuple[str, str, str, Column]]) -> DataFrame:
    """Measure any number of row predicates in one pass over the data."""
    counts = [F.count_if(valid).alias(f"_v{i}") for i, (*_, valid) in enumerate(measured)]
    wide = df.agg(F.count(F.lit(1)).alias("_total"), *counts)
    rows = [
        F.struct(*_metric(check_id, column, text, F.col("_total"), F.col(f"_v{i}")))
        for i, (check_id, column, text, _) in enumerate(measured)
    ]
    return wide.select(F.inline(F.array(*rows)))


def _filled(df: DataFrame) -> list[tuple[str, str, str, Column]]:
    columns = [c for c in df.columns if c not in (*HISTORY_COLUMNS, LINEAGE)]
    return [(FILLED_ID, c, FILLED_TEXT, is_filled(df, c)) for c in columns]


def filled_values(df: DataFrame) -> DataFrame:
    """One metric per column: how many values are filled."""
    return _row_metrics(df, _filled(df))


def signalling_metrics(
    df: DataFrame,
    checks: Sequence[Check],
    trace: DataFrame | None = None,
    seen: RowCounts | None = None,
) -> DataFrame:
    """Fill grade of every column plus the configured checks, as metric rows without ids.

    What concerns single rows is taken from ``seen`` where these rows were counted already.
    """
    grouped = []
    for check, text in zip(checks, labels(checks), strict=True):
        if check_name(check) in ROW_CHECKS:
            continue
        counts = measure_group_check(df, check, trace)
        total, valid = F.col("total_count"), F.col("valid_count")
        identity = CHECK_IDS[check_name(check)], ",".join(check["columns"]), text
        grouped.append(counts.select(*_metric(*identity, total, valid)))
    if seen is not None:
        rows = [(None, *identity, seen.total, valid) for identity, valid in seen.metrics.items()]
        by_row = df.sparkSession.createDataFrame(rows, METRIC_SCHEMA)
    else:
        by_row = _row_metrics(df, _row_predicates(df, checks))
    return union_all([by_row, *grouped])


def _row_predicates(df: DataFrame, checks: Sequence[Check]) -> list[tuple[str, str, str, Column]]:
    """Fill grades and checks on single rows."""
    found = _filled(df)
    for check, text in zip(checks, labels(checks), strict=True):
        name = check_name(check)
        if name in ROW_CHECKS:
            found.append((CHECK_IDS[name], ",".join(check["columns"]), text, ROW_CHECKS[name](check)))
    return found


# -- counting while rows are written ----------------------------------------------------------------


@dataclass(frozen=True)
class RowCounts:
    """What was counted about single rows while they were written."""

    total: int  # open rows
    closed: int  # rows closed on the processing date
    metrics: dict[tuple[str, str, str], int]  # (check id, column, text): valid open rows
    violated: tuple[int, ...]  # positions of gate checks that some open row violates


class RowCounter:
    """Row checks, fill grades and gates of a table, counted by the job that writes its rows."""

    def __init__(
        self, df: DataFrame, gates: Sequence[Check], checks: Sequence[Check], closing_day: dt.date
    ):
        is_open = F.col(TO_DATE) == F.lit(OPEN_END).cast("date")
        predicates = _row_predicates(df, checks)
        self.identities = [identity for *identity, _ in predicates]
        self.gates = [i for i, c in enumerate(gates) if check_name(c) in ROW_CHECKS]
        fails = [~F.coalesce(ROW_CHECKS[check_name(gates[i])](gates[i]), F.lit(False)) for i in self.gates]
        self.counts = [
            F.count_if(is_open).alias("total"),
            F.count_if(F.col(TO_DATE) == F.lit(closing_day)).alias("closed"),
            *[F.count_if(is_open & valid).alias(f"v{i}") for i, (*_, valid) in enumerate(predicates)],
            *[F.count_if(is_open & failed).alias(f"g{i}") for i, failed in zip(self.gates, fails, strict=True)],
        ]
        self.observation = Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        """The same rows; counted when an action has read all of them."""
        return df.observe(self.observation, *self.counts)

    def result(self) -> RowCounts:
        seen = self.observation.get
        number = lambda name: seen.get(name) or 0
        metrics = {tuple(identity): number(f"v{i}") for i, identity in enumerate(self.identities)}
        violated = tuple(i for i in self.gates if number(f"g{i}"))
        return RowCounts(number("total"), number("closed"), metrics, violated)


def assign_signalling_ids(metrics: DataFrame, stored: DataFrame) -> DataFrame:
    """Keep the id a metric had before; new metrics continue after the highest id.

    Both tables hold one row per check (and version), so they are small whatever the data size.
    """
    known = stored.select(F.col("signalling_id").alias("_known_id"), *METRIC_KEY).distinct()
    highest = stored.agg(F.coalesce(F.max("signalling_id"), F.lit(0)).alias("v"))
    matched = metrics.join(known, list(METRIC_KEY), "left")
    is_new = F.col("_known_id").isNull()
    order = Window.partitionBy("table_name", is_new).orderBy("check_id", "column_name", "check_name")
    new_id = F.row_number().over(order) + highest.scalar()
    return matched.withColumn(
        "signalling_id", F.when(is_new, new_id).otherwise(F.col("_known_id")).cast("long")
    ).select(*METRIC_COLUMNS, "table_name")


# -- gate ---------------------------------------------------------------------------------------


def blocking_counts(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """``position, check, total_count, valid_count`` of each gate check on the open rows."""
    _require_blocking(checks)
    current = df.where(F.col(TO_DATE) == F.lit(OPEN_END).cast("date"))

    def labelled(position: int, check: Check, total: Column, valid: Column) -> list[Column]:
        return [
            F.lit(position).alias("position"),
            F.lit(check["check"]).alias("check"),
            total.cast("long").alias("total_count"),
            valid.cast("long").alias("valid_count"),
        ]

    frames = []
    by_row = [(i, c) for i, c in enumerate(checks) if check_name(c) in ROW_CHECKS]
    if by_row:
        wide = current.agg(
            F.count(F.lit(1)).alias("_total"),
            *[F.count_if(ROW_CHECKS[check_name(c)](c)).alias(f"_v{i}") for i, c in by_row],
        )
        rows = [F.struct(*labelled(i, c, F.col("_total"), F.col(f"_v{i}"))) for i, c in by_row]
        frames.append(wide.select(F.inline(F.array(*rows))))
    for i, check in enumerate(checks):
        if check_name(check) not in ROW_CHECKS:
            counts = measure_group_check(current, check)
            frames.append(
                counts.select(*labelled(i, check, F.col("total_count"), F.col("valid_count")))
            )
    return union_all(frames)


def _require_blocking(checks: Sequence[Check]) -> None:
    for check in checks:
        if check_name(check) not in BLOCKING_CHECKS:
            raise ValueError(f"Not a blocking check: {check['check']}")


def check_blocking(
    df: DataFrame, checks: Sequence[Check], seen: RowCounts | None = None
) -> None:
    """Raise for the first gate check that some open row violates.

    With ``seen`` only checks on groups read the rows, and only those ahead of a violated one.
    """
    _require_blocking(checks)
    first = min(seen.violated, default=None) if seen is not None else None
    unread = checks[:first] if seen is None else [c for c in checks[:first] if check_name(c) not in ROW_CHECKS]
    found = None
    if unread:
        violated = F.col("valid_count") != F.col("total_count")
        found = blocking_counts(df, unread).where(violated).orderBy("position").first()
    name = found["check"] if found is not None else None if first is None else checks[first]["check"]
    if name is not None:
        raise ValueError(f"Blocking issue violation detected: {name}")
