"""Column-name cleaning and lookup; no data is touched."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

# Characters that become a blank, are dropped, or collapse to an underscore.
TO_BLANK = r"[-\\/]"
TO_DROP = r"[()]"
BLANKS = r"\s+"


def clean_name(name: str) -> str:
    name = re.sub(TO_DROP, "", re.sub(TO_BLANK, " ", name))
    return re.sub(BLANKS, "_", name)


def clean_column_names(df: DataFrame) -> DataFrame:
    """Rename all columns at once; two columns must not end up with one name."""
    names = [clean_name(c) for c in df.columns]
    doubled = sorted({n for n in names if names.count(n) > 1})
    if doubled:
        raise ValueError(f"Cleaned column names collide: {doubled}")
    return df if names == df.columns else df.toDF(*names)


def find_column(df: DataFrame, pattern: str) -> str:
    """The one column whose name contains the pattern (an exact name wins)."""
    if pattern in df.columns:
        return pattern
    found = [c for c in df.columns if re.search(pattern, c)]
    if len(found) != 1:
        raise ValueError(f"Expected one column matching {pattern!r}, found {found}")
    return found[0]


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"Missing columns: {missing}")
