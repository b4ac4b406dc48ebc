"""Content hashes of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASH_MODES = ("safe", "concat")


def _text(value: Column, kind: T.DataType) -> Column:
    """The text of a value; two values of one type share a text only if they are equal.

    Elements of arrays are written in order, fields of structs in theirs, entries of maps sorted.
    """
    if isinstance(kind, T.ArrayType):
        inside = F.array_join(F.transform(value, lambda v: _sized(_text(v, kind.elementType))), "")
        return F.concat(F.lit("["), inside, F.lit("]"))
    if isinstance(kind, T.StructType):
        fields = [_sized(_text(value.getField(f.name), f.dataType)) for f in kind.fields]
        return F.when(value.isNotNull(), F.concat(F.lit("("), *fields, F.lit(")")))
    if isinstance(kind, T.MapType):
        entry = lambda e: F.concat(_sized(_text(e["key"], kind.keyType)), _sized(_text(e["value"], kind.valueType)))
        inside = F.array_join(F.array_sort(F.transform(F.map_entries(value), entry)), "")
        return F.concat(F.lit("{"), inside, F.lit("}"))
    if isinstance(kind, T.BinaryType):
        return F.hex(value)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        # Grouping treats -0.0 and 0.0 as one value, so their hashes must agree too.
        value = value + F.lit(0.0).cast(kind)
    return value.cast("string")


def _sized(text: Column) -> Column:
    return F.coalesce(F.concat(F.length(text), F.lit(":"), text), F.lit("-"))


def row_text(schema: T.StructType, columns: Sequence[str], mode: str = "safe") -> Column:
    """The text that is hashed.

    ``safe`` writes every value as ``length:value`` and a null as ``-``, also inside arrays, structs and
    maps, so two different rows never share a text. ``concat`` joins the non-null values with ``|``; there (a, null, b) and (a, b, null)
    share a text.
    """
    if mode not in HASH_MODES:
        raise ValueError(f"Unknown hash mode {mode}, use one of {HASH_MODES}")
    texts = [_text(F.col(f"`{c}`"), schema[c].dataType) for c in columns]
    if mode == "concat":
        return F.concat_ws("|", *texts)
    return F.concat(*[_sized(t) for t in texts])


def row_hash(df: DataFrame, columns: Sequence[str], mode: str = "safe") -> Column:
    """SHA-256 of the given columns of ``df`` as a hex string."""
    return F.sha2(row_text(df.schema, columns, mode), 256)


def row_key(df: DataFrame, columns: Sequence[str], mode: str = "safe") -> Column:
    """The same hash as 32 raw bytes: half the size of the hex form in a shuffle."""
    return F.unhex(row_hash(df, columns, mode))
