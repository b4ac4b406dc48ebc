"""Tool calls of conversations: linked to their results, ordered, validated and written canonically.

Calls and results meet in a join on conversation and identifier. A call may use the result of another by
``{"$ref": "<id>"}`` in its arguments; calls of one message are ordered so that none comes before one it
uses. Arguments are checked against the schema of the tool and written as JSON with sorted keys and no
white space.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CALLS = "struct<tool_calls: array<struct<id: string, name: string, arguments: string>>>"
RESULT = "struct<tool_call_id: string, content: string>"
SCHEMA = (
    "struct<properties: map<string, struct<type: string, enum: array<string>, minimum: double, "
    "maximum: double>>, required: array<string>, additionalProperties: boolean>"
)
REFERENCE = r'"\$ref"\s*:\s*"((?:[^"\\]|\\.)*)"'

#: Schema rows up to which they are broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 10_000


def _levels(calls: str) -> Column:
    """For each call of a message how many calls at least come before it; null inside a cycle."""
    places = F.sequence(F.lit(0), F.size(calls) - 1)
    used = F.transform(
        F.col(calls),
        lambda c: F.filter(
            places,
            lambda j: F.array_contains(
                F.regexp_extract_all(F.coalesce(c["arguments"], F.lit("")), F.lit(REFERENCE), F.lit(1)),
                F.get(F.col(calls), j)["id"],
            ),
        ),
    )

    def step(levels: Column, _: Column) -> Column:
        return F.transform(
            used,
            lambda js: F.coalesce(F.array_max(F.transform(js, lambda j: F.get(levels, j) + 1)), F.lit(0)),
        )

    start = F.array_repeat(F.lit(0), F.size(calls))
    # As many steps as calls: what still grows then lies on a cycle or behind one.
    grown = F.aggregate(places, start, step)
    capped = F.transform(grown, lambda n: F.when(n < F.size(calls), n))
    any_use = F.exists(used, lambda js: F.size(js) > 0)
    return F.when(any_use, capped).otherwise(start)


def _kind(value: Column) -> Column:
    """JSON type of a variant."""
    found = F.schema_of_variant(value)
    return (
        F.when(found == "STRING", "string")
        .when(found == "BOOLEAN", "boolean")
        .when(found == "BIGINT", "integer")
        .when(found == "VOID", "null")
        .when(found.startswith("OBJECT"), "object")
        .when(found.startswith("ARRAY"), "array")
        .otherwise("number")
    )


def _errors() -> Column:
    """What is wrong with ``args`` under the schema ``s``, sorted."""
    properties = F.coalesce(F.col("s.properties"), F.create_map().cast("map<string,struct<type:string,enum:array<string>,minimum:double,maximum:double>>"))
    required = F.coalesce(F.col("s.required"), F.array().cast("array<string>"))
    missing = F.transform(
        F.filter(required, lambda k: ~F.map_contains_key("kinds", k)),
        lambda k: F.concat(F.lit("missing:"), k),
    )
    keys = F.map_keys("kinds")
    unknown = F.transform(
        F.filter(keys, lambda k: (F.col("s.additionalProperties") == F.lit(False)) & ~F.map_contains_key(properties, k)),
        lambda k: F.concat(F.lit("unknown:"), k),
    )
    rule = lambda k: F.element_at(properties, k)
    kind = lambda k: F.element_at("kinds", k)
    value = lambda k: F.element_at("texts", k)
    is_reference = lambda k: (kind(k) == "object") & value(k).rlike(REFERENCE)
    checked = F.filter(keys, lambda k: F.map_contains_key(properties, k) & ~is_reference(k))
    wrong_kind = lambda k: (
        rule(k)["type"].isNotNull()
        & (kind(k) != rule(k)["type"])
        & ~((rule(k)["type"] == "number") & (kind(k) == "integer"))
    )
    number = lambda k: value(k).try_cast("double")
    outside = lambda k: F.coalesce(number(k) < rule(k)["minimum"], F.lit(False)) | F.coalesce(
        number(k) > rule(k)["maximum"], F.lit(False)
    )
    not_listed = lambda k: F.coalesce(~F.array_contains(rule(k)["enum"], value(k)), F.lit(False))
    labelled = lambda test, label: F.transform(
        F.filter(checked, lambda k: F.coalesce(test(k), F.lit(False))), lambda k: F.concat(F.lit(label), k)
    )
    wrong = F.concat(missing, unknown, labelled(wrong_kind, "type:"), labelled(outside, "range:"), labelled(not_listed, "enum:"))
    return (
        F.when(F.col("kinds").isNull(), F.array(F.lit("invalid_json")))
        .when(F.col("s").isNull(), F.array(F.lit("unknown_tool")))
        .otherwise(F.array_sort(wrong))
    )


def link_calls(messages: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call, and one per result whose call is missing (null name and arguments).

    ``messages``: conv_id, turn, role, text. An assistant's text ``{"tool_calls": [{"id", "name", "arguments"}]}``
    makes calls, a tool's text ``{"tool_call_id", "content"}`` a result; texts that are null, empty or
    anything else make neither. ``schemas``: name and schema, a JSON schema of an object with properties (type, enum,
    minimum, maximum), required and additionalProperties; of several for a name the greatest text holds.

    Columns: conv_id, turn, level, place, call_id, name, arguments, errors, n_calls_of_id, n_results, result_turn,
    result. (turn, level, place) is the order: level counts the calls of the message that come before, and is
    null in a cycle of references, which comes last. ``arguments`` is canonical JSON, null if it is no JSON
    object. ``errors`` is a comma-separated sorted list, empty if the call is valid. Of several results the one of
    the lowest turn counts, ties by text. A null conv_id or call_id links to nothing. Repeated rows make
    repeated calls; other columns are ignored, whatever their names. Empty tables give no rows.
    """
    rows = messages.select("conv_id", "turn", "role", "text")
    calls = (
        rows.where("role = 'assistant'")
        .select("conv_id", "turn", F.from_json("text", CALLS)["tool_calls"].alias("calls"))
        .where(F.size("calls") > 0)
        .withColumn("levels", _levels("calls"))
        .select("conv_id", "turn", "levels", F.posexplode("calls").alias("place", "c"))
        .select(
            "conv_id",
            "turn",
            F.get("levels", F.col("place")).alias("level"),
            "place",
            F.col("c.id").alias("call_id"),
            F.col("c.name").alias("name"),
            F.col("c.arguments").alias("raw"),
        )
    )
    results = (
        rows.where("role = 'tool'")
        .select("conv_id", "turn", F.from_json("text", RESULT).alias("r"))
        .where("conv_id IS NOT NULL AND r.tool_call_id IS NOT NULL")
        .groupBy("conv_id", F.col("r.tool_call_id").alias("call_id"))
        .agg(
            F.count(F.lit(1)).alias("n_results"),
            F.min(F.struct("turn", F.col("r.content").alias("result"))).alias("first"),
        )
    )
    counted = (
        calls.where("conv_id IS NOT NULL AND call_id IS NOT NULL")
        .groupBy("conv_id", "call_id")
        .agg(F.count(F.lit(1)).alias("n_calls_of_id"))
    )
    # One row per identifier, so that repeated calls and results never multiply.
    ids = counted.join(results, ["conv_id", "call_id"], "full")
    known = schemas.groupBy("name").agg(F.max("schema").alias("schema")).where("name IS NOT NULL")
    if known.count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    entries = F.from_json("raw", "map<string, variant>")
    validated = (
        calls.join(known, "name", "left")
        .withColumn("args", F.when(F.try_parse_json("raw").isNotNull() & F.col("raw").rlike(r"^\s*\{"), entries))
        .withColumn("kinds", F.transform_values("args", lambda k, v: _kind(v)))
        .withColumn("texts", F.transform_values("args", lambda k, v: F.coalesce(F.try_variant_get(v, "$", "string"), F.to_json(v))))
        .withColumn("s", F.from_json("schema", SCHEMA))
        .select(
            "conv_id",
            "turn",
            "level",
            "place",
            "call_id",
            "name",
            F.when(F.col("kinds").isNotNull(), F.to_json(F.try_parse_json("raw"))).alias("arguments"),
            F.array_join(_errors(), ",").alias("errors"),
        )
    )
    linked = validated.join(ids, ["conv_id", "call_id"], "left")
    orphans = ids.where("n_calls_of_id IS NULL")
    columns = [
        F.coalesce("n_calls_of_id", F.lit(0)).alias("n_calls_of_id"),
        F.coalesce("n_results", F.lit(0)).alias("n_results"),
        F.col("first.turn").alias("result_turn"),
        F.col("first.result").alias("result"),
    ]
    return linked.select(
        "conv_id", "turn", "level", "place", "call_id", "name", "arguments", "errors", *columns
    ).unionByName(orphans.select("conv_id", "call_id", *columns), allowMissingColumns=True)
